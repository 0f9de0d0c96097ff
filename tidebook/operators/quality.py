"""Data-quality measures: one aggregation each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.functions import scalars as S
from tidebook.operators import ranges

#: Spellings of an empty origin time.
ZEROS = ("0", "", "1970-01-01T00:00:00", "1970-01-01 00:00:00")


def _share(n: Column, total: Column) -> Column:
    return F.when(total > 0, F.round(n * 100.0 / total, 6)).otherwise(0.0)


def origin_time_quality(df: DataFrame, now: str, column: str = "origin_time") -> DataFrame:
    """Null, zero, future, negative and invalid text times, with their overlapping sum and the exclusive one.

    ``now`` is a parameter, so results do not change from day to day.
    """
    c = F.col(column)
    parsed = F.try_to_timestamp(c)
    null, zero, negative = c.isNull(), c.isin(*ZEROS), F.coalesce(c.startswith("-"), F.lit(False))
    invalid, future = c.isNotNull() & parsed.isNull(), F.coalesce(parsed > F.lit(now).cast("timestamp"), F.lit(False))
    zero = F.coalesce(zero, F.lit(False))
    tests = {"null": null, "zero": zero, "future": future, "negative": negative, "invalid": invalid}
    any_ = null | zero | future | negative | invalid
    g = df.agg(F.count("*").alias("total"), *[F.count_if(t).alias(f"{k}_count") for k, t in tests.items()], F.count_if(any_).alias("bad_rows"))
    total = sum((F.col(f"{k}_count") for k in list(tests)[1:]), F.col("null_count"))
    return g.withColumn("overlapping_count", total).withColumn("valid_percent", F.when(F.col("total") > 0, F.round((F.col("total") - F.col("bad_rows")) * 100.0 / F.col("total"), 6)).otherwise(0.0)).withColumn("reliable", F.col("valid_percent") >= 95.0)


def tier(bad_percent: Column) -> Column:
    """How far times can be relied on: up to 5 per cent bad, up to 10, or more."""
    return F.when(bad_percent <= 5, "reliable").when(bad_percent <= 10, "usable").otherwise("unreliable")


def time_tiers(df: DataFrame, by: str, bad: str) -> DataFrame:
    """Per group: rows, bad times (``bad`` is SQL), their share and its tier."""
    g = df.groupBy(by).agg(F.count("*").alias("rows"), F.count_if(F.coalesce(F.expr(bad), F.lit(True))).alias("bad"))
    return g.withColumn("bad_percent", _share(F.col("bad"), F.col("rows")).cast("double")).withColumn("tier", tier(F.col("bad_percent")))


def spike(summary: DataFrame, ratio: float = 0.001, largest: int = 1000) -> DataFrame:
    """A gap summary (``sequence.gap_summary``) with its verdict: GO below both thresholds, WARN beyond one, NO-GO beyond both."""
    over = (F.col("gap_ratio") > ratio).cast("int") + (F.col("largest") > largest).cast("int")
    return summary.withColumn("verdict", F.when(over == 0, "GO").when(over == 1, "WARN").otherwise("NO-GO"))


def captured_files(messages: DataFrame, file: str, order: str, most_disorder: float = 0.1, least: int = 1) -> DataFrame:
    """Per file of captured messages: messages, trades, hours, rate, rows earlier than the one before, and whether it is accepted."""
    c = ranges.lagged(messages, {"_prev": "capture_ns"}, order, file)
    span = F.max("capture_ns") - F.min("capture_ns")
    g = c.groupBy(file).agg(
        F.count("*").alias("messages"), F.count_if(F.col("stream").contains("@trade")).alias("trades"), F.round(span / 3.6e12, 6).alias("hours"), F.round(F.when(span > 0, F.count("*") / (span / 1e9)), 6).alias("per_second"),
        F.count_if(F.col("capture_ns") < F.col("_prev")).alias("out_of_order"),
    )
    return g.withColumn("accepted", (F.col("messages") >= least) & (F.col("out_of_order") <= F.col("messages") * most_disorder) & (F.col("trades") > 0))


def summed(parts: DataFrame) -> DataFrame:
    """Totals of several checks (rows, bad): rows, bad ones and the valid share over all."""
    return parts.agg(F.count("*").alias("checks"), F.sum("rows").alias("rows"), F.sum("bad").alias("bad")).withColumn("valid_percent", F.round((F.col("rows") - F.col("bad")) * 100.0 / F.col("rows"), 6).cast("double"))


def within_years(df: DataFrame, time: str, by: str, first: int = 2020, last: int = 2030) -> DataFrame:
    """Per group: first and last UTC time (nanoseconds as timestamps), hours between them, and whether both lie in the years."""
    at = S.epoch_timestamp(F.col(time))
    g = df.groupBy(by).agg(F.min(at).alias("first_time"), F.max(at).alias("last_time"), F.round((F.max(time) - F.min(time)) / 3.6e12, 6).alias("hours"))
    return g.withColumn("plausible", (F.year("first_time") >= first) & (F.year("last_time") <= last))


#: Column types that delta files must have.
DELTA_TYPES = {"update_id": ("int", "bigint"), "origin_time": ("bigint",), "side": ("string",)}


def schema_problems(df: DataFrame, types: dict[str, tuple[str, ...]] = DELTA_TYPES) -> list[str]:
    """What keeps a table from being read as deltas: missing columns, other types, no rows."""
    have = dict(df.dtypes)
    out = [f"{c}: missing" if c not in have else f"{c}: {have[c]} is none of {', '.join(t)}" for c, t in types.items() if have.get(c) not in t]
    return out + (["no rows"] if df.isEmpty() else [])


def file_problems(spark: SparkSession, path: str, required: list[str], digest: str | None = None) -> list[str]:
    """What is wrong with a Parquet file: missing, empty, another checksum, unreadable, columns missing, no rows."""
    try:
        found = spark.read.format("binaryFile").load(path).select("length", F.sha2("content", 256).alias("sha256")).collect()
    except Exception as e:  # noqa: BLE001  a missing file is a finding
        return [f"missing: {type(e).__name__}"]
    out = ["empty file"] if any(f["length"] == 0 for f in found) else []
    if digest and [f["sha256"] for f in found] != [digest]:
        out.append("checksum differs")
    try:
        df = spark.read.parquet(path)
        rows = df.count()
    except Exception as e:  # noqa: BLE001  an unreadable file is a finding
        return [*out, f"unreadable: {type(e).__name__}"]
    return out + [f"{c}: missing" for c in required if c not in df.columns] + (["no rows"] if not rows else [])


def recommendation(trades: Column, books: Column) -> Column:
    """Strategy by the valid shares of two tables, at 95 per cent."""
    a, b = trades >= 95.0, books >= 95.0
    return F.when(a & b, "origin_time").when(a & ~b, "trades_origin_time").when(~a & b, "books_origin_time").when((trades < 50) & (books < 50), "arrival_order").otherwise("mixed")


def delta_quality(deltas: DataFrame) -> DataFrame:
    """Rows with a valid update id, price and quantity; null counts as invalid."""
    bad = lambda e: F.count_if(~F.coalesce(F.expr(e), F.lit(False)))
    g = deltas.agg(F.count("*").alias("rows"), bad("update_id > 0").alias("bad_update_id"), bad("price > 0").alias("bad_price"), bad("new_quantity >= 0").alias("bad_quantity"), F.count_if(F.col("new_quantity") == 0).alias("removals"))
    return g.withColumn("bad_percent", _share(F.col("bad_update_id") + F.col("bad_price") + F.col("bad_quantity"), F.col("rows")))


def integrity(df: DataFrame, numeric: list[str], positive: list[str]) -> DataFrame:
    """Long form: check, column, number of rows that fail it."""
    tests = [("null", c, F.col(c).isNull()) for c in numeric] + [("not_positive", c, F.coalesce(F.col(c) <= 0, F.lit(False))) for c in positive]
    g = df.agg(F.array(*[F.struct(F.lit(k).alias("check"), F.lit(c).alias("column_name"), F.count_if(t).alias("failed")) for k, c, t in tests]).alias("r"))
    return g.select(F.inline("r"))


def date_continuity(df: DataFrame, date: str) -> DataFrame:
    """Days from the first to the last date, days present and missing, share present, and whether it reaches 95 per cent."""
    days = df.select(F.col(date).cast("date").alias("d")).filter("d is not null").groupBy("d").count()
    g = days.agg(F.min("d").alias("first_day"), F.max("d").alias("last_day"), F.count("*").alias("present"))
    g = g.withColumn("expected", (F.datediff("last_day", "first_day") + 1).cast("long")).withColumn("missing", F.col("expected") - F.col("present"))
    return g.withColumn("present_percent", _share(F.col("present"), F.col("expected"))).withColumn("continuous", F.col("present_percent") >= 95.0)


def missing_days(df: DataFrame, date: str) -> DataFrame:
    """The dates between the first and the last that have no row."""
    days = df.select(F.col(date).cast("date").alias("d")).filter("d is not null").distinct()
    every = days.agg(F.min("d").alias("a"), F.max("d").alias("b")).filter("a is not null").select(F.explode(F.sequence("a", "b")).alias("d"))
    return every.join(days, "d", "left_anti")


def certificate(files: DataFrame, required: list[str]) -> DataFrame:
    """Readiness of each required data type: ready files, bytes, first and last date, coverage issues, and whether there is any."""
    need = files.sparkSession.createDataFrame([(t,) for t in required], "data_type string")
    ready = files.filter("status = 'READY'").groupBy("data_type").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count_distinct("date").alias("days"))
    days = F.datediff("last_date", "first_date") + 1
    issue = F.when(F.col("files").isNull(), "no ready files").when(F.col("days") < 0.95 * days, "days missing")
    return need.join(ready, "data_type", "left").select("data_type", F.coalesce("files", F.lit(0)).alias("files"), F.coalesce("bytes", F.lit(0)).alias("bytes"), "first_date", "last_date", F.col("files").isNotNull().alias("ready"), issue.alias("issue"))
