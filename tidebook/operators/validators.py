"""Validators of two samples, their pipeline, and acceptance rules.

A validator is a class with a name and a method that returns one row of metrics with a
boolean ``passed``. The pipeline runs validators over parsed inputs and gives one tidy
table: validator, passed, metrics (JSON), error. Results of an earlier run can be handed
in to go on from there.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.operators import ranges, sequence, stats

RESULT = "validator string, passed boolean, metrics string, error string"


class Validator(ABC):
    """One check of a sample against another; ``metrics`` returns one row with a column ``passed``."""

    name: str

    @abstractmethod
    def metrics(self, golden: DataFrame, other: DataFrame) -> DataFrame: ...

    def result(self, golden: DataFrame, other: DataFrame) -> DataFrame:
        m = self.metrics(golden, other)
        return m.select(F.lit(self.name).alias("validator"), "passed", F.to_json(F.struct(*[c for c in m.columns if c != "passed"])).alias("metrics"), F.lit(None).cast("string").alias("error"))


class Chronology(Validator):
    """No row is earlier than the one before it."""

    name = "chronology"

    def __init__(self, time: str = "capture_ns", order: str = "event_id", key: str = "symbol") -> None:
        self.args = (time, order, key)

    def metrics(self, golden: DataFrame, other: DataFrame) -> DataFrame:
        one = lambda df, n: sequence.chronology(df, *self.args).agg(F.coalesce(F.sum("out_of_order"), F.lit(0)).alias(n))
        return one(golden, "golden_out_of_order").join(one(other, "other_out_of_order")).withColumn("passed", (F.col("golden_out_of_order") == 0) & (F.col("other_out_of_order") == 0))


class SequenceGaps(Validator):
    """The share of updates with a gap stays below a ratio."""

    name = "sequence_gaps"

    def __init__(self, most: float = 1e-4, **columns: str) -> None:
        self.most, self.columns = most, columns

    def metrics(self, golden: DataFrame, other: DataFrame) -> DataFrame:
        def one(df: DataFrame, n: str) -> DataFrame:
            return sequence.range_gaps(df, **self.columns).agg(F.count("*").alias("g")).join(df.agg(F.count("*").alias("n"))).select(F.round(F.col("g") / F.greatest("n", F.lit(1)), 9).alias(n))

        return one(golden, "golden_ratio").join(one(other, "other_ratio")).withColumn("passed", (F.col("golden_ratio") <= self.most) & (F.col("other_ratio") <= self.most))


class SameDistribution(Validator):
    """Two-sample Kolmogorov-Smirnov on a column, passed above a p-value."""

    name = "ks"

    def __init__(self, column: str, alpha: float = 0.05) -> None:
        self.column, self.alpha = column, alpha

    def metrics(self, golden: DataFrame, other: DataFrame) -> DataFrame:
        both = golden.select(F.col(self.column).alias("v"), F.lit(True).alias("g")).unionByName(other.select(F.col(self.column).alias("v"), F.lit(False).alias("g")))
        return stats.ks_statistic(both, "v", "g").withColumn("passed", F.col("p_value_asymptotic") > self.alpha)


class BasicStatistics(Validator):
    """Mean, deviation and median agree within 1, 5 and 1 per cent."""

    name = "basic_statistics"

    def __init__(self, column: str) -> None:
        self.column = column

    def metrics(self, golden: DataFrame, other: DataFrame) -> DataFrame:
        return stats.compared(golden, other, self.column)


class PowerLawTail(Validator):
    """The tail exponents lie near 2.4."""

    name = "power_law"

    def __init__(self, column: str, xmin: float) -> None:
        self.column, self.xmin = column, xmin

    def metrics(self, golden: DataFrame, other: DataFrame) -> DataFrame:
        one = lambda df, n: stats.power_law(df, self.column, self.xmin).select(F.col("alpha").alias(f"{n}_alpha"), F.col("n_tail").alias(f"{n}_tail"), F.col("near_target").alias(n))
        j = one(golden, "golden").join(one(other, "other"))
        return j.select("golden_alpha", "golden_tail", "other_alpha", "other_tail", (F.col("golden") & F.col("other") & (F.col("golden_tail") >= 100) & (F.col("other_tail") >= 100)).alias("passed"))


def run(spark: SparkSession, validators: list[Validator], golden: DataFrame, other: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """Results of all validators, in their order; those in ``done`` are not run again, a failing one gives its error."""
    have = {r["validator"] for r in done.select("validator").collect()} if done is not None else set()
    parts = [done.select(*[c.split()[0] for c in RESULT.split(", ")])] if done is not None else []
    rows = []
    for v in validators:
        if v.name in have:
            continue
        try:
            rows += [tuple(r) for r in v.result(golden, other).collect()]  # one row
        except Exception as e:  # noqa: BLE001  a validator's failure is its result, at run time too
            rows.append((v.name, False, None, f"{type(e).__name__}: {e}"[:500]))
    return reduce(DataFrame.unionByName, [*parts, spark.createDataFrame(rows, RESULT)])


def regimes(updates: DataFrame, regime: str, most: float = 0.001, **columns: str) -> DataFrame:
    """Per regime: messages, gaps, their ratio, and GO or NO-GO."""
    gaps = sequence.range_gaps(updates, **columns).filter("kind = 'gap'").groupBy(regime).agg(F.count("*").alias("gaps"))
    out = updates.groupBy(regime).agg(F.count("*").alias("messages")).join(gaps, regime, "left").withColumn("gaps", F.coalesce("gaps", F.lit(0)))
    ratio = F.round(F.col("gaps") / F.col("messages"), 9)
    return out.withColumn("gap_ratio", ratio).withColumn("decision", F.when(ratio < most, "GO").otherwise("NO-GO"))


def spreads(levels: DataFrame, depths: list[int]) -> DataFrame:
    """Spread between the k-th best levels of a book (key columns symbol, snap_id), for each k."""
    from pyspark.sql import Window

    best = F.when(F.col("side") == "BID", -F.col("price")).otherwise(F.col("price"))
    r = levels.withColumn("k", F.row_number().over(Window.partitionBy("symbol", "snap_id", "side").orderBy(best))).filter(F.col("k").isin(depths))
    price = lambda s: F.max(F.when(F.col("side") == s, F.col("price")))
    return r.groupBy("symbol", "snap_id", "k").agg((price("ASK") - price("BID")).alias("spread"))


def impact(trades: DataFrame, bucket_ns: int) -> DataFrame:
    """Kyle's lambda and Amihud's ratio of each symbol, from price changes and signed volume in time buckets."""
    signed = F.when(F.col("side") == "BUY", F.col("quantity")).otherwise(-F.col("quantity"))
    b = trades.groupBy("symbol", F.expr(f"origin_time div {bucket_ns}").alias("b")).agg(F.sum(signed).alias("flow"), F.sum("quantity").alias("volume"), F.max_by("price", "event_id").alias("close"))
    b = ranges.lagged(b, {"_prev": "close"}, "b", "symbol").withColumn("change", F.col("close") - F.col("_prev")).filter("change is not null")
    return b.groupBy("symbol").agg(F.round(F.regr_slope("change", "flow"), 9).alias("kyle_lambda"), F.round(F.avg(F.abs("change") / F.col("volume")), 9).alias("amihud"), F.count("*").alias("buckets"))


def crossed(top: DataFrame) -> DataFrame:
    """Per symbol: states of a book, those crossed (bid at or above ask) and one-sided, and the crossed share."""
    cross = F.coalesce(F.col("best_bid") >= F.col("best_ask"), F.lit(False))
    g = top.groupBy("symbol").agg(F.count("*").alias("states"), F.count_if(cross).alias("crossed"), F.count_if(F.col("best_bid").isNull() | F.col("best_ask").isNull()).alias("one_sided"))
    return g.withColumn("crossed_rate", F.round(F.col("crossed") / F.col("states"), 9))


def bursts(events: DataFrame, bucket_ns: int, time: str = "origin_time") -> DataFrame:
    """Fano factor of each symbol: variance over mean of the number of events in its time buckets that have any."""
    b = events.groupBy("symbol", F.expr(f"`{time}` div {bucket_ns}").alias("b")).agg(F.count("*").alias("n"))
    return b.groupBy("symbol").agg(F.count("*").alias("buckets"), F.round(F.var_pop("n") / F.avg("n"), 9).alias("fano"))


def price_jumps(trades: DataFrame, bucket_ns: int, sigmas: float = 3.0) -> DataFrame:
    """Per symbol: changes of the closing price between time buckets, and those beyond so many deviations from their mean."""
    c = trades.groupBy("symbol", F.expr(f"origin_time div {bucket_ns}").alias("b")).agg(F.max_by("price", "event_id").alias("close"))
    c = ranges.lagged(c, {"_prev": "close"}, "b", "symbol").withColumn("d", F.col("close") - F.col("_prev")).filter("d is not null")
    of = c.groupBy("symbol").agg(F.avg("d").alias("m"), F.stddev_pop("d").alias("s"), F.count("*").alias("changes"))
    far = F.abs(F.col("d") - F.col("m")) > sigmas * F.col("s")
    return c.join(F.broadcast(of), "symbol").groupBy("symbol").agg(F.first("changes").alias("changes"), F.count_if(far).alias("jumps"), F.max(F.abs("d")).alias("largest"))


def storage(volumes: DataFrame, months: int, read_factor: float, write_factor: float) -> DataFrame:
    """Gigabytes read and written over some months, by symbol (symbol, gb_per_month)."""
    g = F.col("gb_per_month") * months
    return volumes.select("symbol", F.round(g * read_factor, 6).alias("read_gb"), F.round(g * write_factor, 6).alias("written_gb"))
