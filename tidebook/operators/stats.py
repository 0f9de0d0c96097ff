"""Distribution statistics and comparisons; percentiles interpolate linearly, sums are exact where longs are given."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.functions import scalars as S
from tidebook.operators import ranges


def percentiles(df: DataFrame, value: str, shares: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """Exact percentiles with linear interpolation, over counted values with carried sums: no task sees all values of a group."""
    by = by or []
    g = df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    x = ranges.running(g, "_v", ["_n"], by)
    total = g.groupBy(*by).agg(F.sum("_n").alias("_total")).withColumnsRenamed({b: f"_of_{b}" for b in by})
    same = F.lit(True)
    for b in by:
        same = same & x[b].eqNullSafe(F.col(f"_of_{b}"))
    x = x.join(F.broadcast(total), same)  # one row a group
    at = lambda i: F.min(F.when(F.col("upto__n") > i, F.col("_v")))
    out = []
    for name, p in shares.items():
        place = F.lit(p) * (F.col("_total") - 1)
        low, high = at(F.floor(place)), at(F.ceil(place))
        out.append((low + (high - low) * F.first(place - F.floor(place))).alias(name))
    return x.groupBy(*by).agg(*out)


def basic(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """Mean, population deviation, median, quartiles, extremes and number of values; nulls are left out."""
    c, by = F.col(value), by or []
    r = lambda x: F.round(x, 6)
    g = df.groupBy(*by).agg(r(F.avg(c)).alias("mean"), r(F.stddev_pop(c)).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"), F.count(c).alias("n"))
    p = percentiles(df, value, {"median": 0.5, "q25": 0.25, "q75": 0.75}, by).withColumnsRenamed({b: f"_of_{b}" for b in by})
    same = F.lit(True)
    for b in by:
        same = same & g[b].eqNullSafe(F.col(f"_of_{b}"))
    out = g.join(F.broadcast(p), same, "left")  # one row a group
    return out.select(*by, "mean", "std", r("median").alias("median"), "min", "max", r("q25").alias("q25"), r("q75").alias("q75"), "n")


def compared(a: DataFrame, b: DataFrame, value: str) -> DataFrame:
    """Relative differences of mean, deviation and median of two samples, and whether they stay within 1, 5 and 1 per cent."""
    x, y = basic(a, value), basic(b, value).select(*[F.col(c).alias(f"{c}_2") for c in ("mean", "std", "median", "n")])
    j = x.join(y)  # one row each
    d = {c: F.round(S.relative_difference(F.col(c), F.col(f"{c}_2")), 6) for c in ("mean", "std", "median")}
    out = j.select(*[v.alias(f"{k}_diff") for k, v in d.items()], "n", "n_2")
    return out.withColumn("passed", (F.col("mean_diff") <= 0.01) & (F.col("std_diff") <= 0.05) & (F.col("median_diff") <= 0.01))


def ks_statistic(df: DataFrame, value: str, first: str) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance and asymptotic p-value; ``first`` is SQL that says which rows are sample one.

    Values are counted first, so the ordered pass is over distinct values; it is cut at their
    quantiles and sums are carried forward, so that no task sees all of them.
    """
    g = df.groupBy(F.col(value).alias("v")).agg(F.count_if(F.expr(first)).alias("a"), F.count_if(~F.expr(first)).alias("b")).filter("v is not null")
    total = g.agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
    x = ranges.running(g, "v", ["a", "b"]).withColumnsRenamed({"upto_a": "fa", "upto_b": "fb"})
    d = x.join(F.broadcast(total)).agg(F.max(F.abs(F.col("fa") / F.col("na") - F.col("fb") / F.col("nb"))).alias("d"), F.first("na").alias("n1"), F.first("nb").alias("n2"))
    t = F.col("d") * F.sqrt(F.col("n1") * F.col("n2") / (F.col("n1") + F.col("n2")))
    series = sum(((-1) ** (k - 1) * F.exp(-2.0 * k * k * t * t) for k in range(1, 101)), F.lit(0.0))
    p = F.when(t < 0.2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * series)))
    return d.select(F.round("d", 9).alias("statistic"), "n1", "n2", F.round(p, 6).alias("p_value_asymptotic"))


def power_law(df: DataFrame, value: str, xmin: float) -> DataFrame:
    """Maximum-likelihood exponent of the tail from ``xmin`` on, its number of values and standard error."""
    tail = df.filter(F.col(value) >= xmin).agg(F.count("*").alias("n_tail"), F.sum(F.log(F.col(value) / F.lit(xmin))).alias("s"))
    alpha = F.when(F.col("s") > 0, 1 + F.col("n_tail") / F.col("s"))
    return tail.select("n_tail", F.round(alpha, 6).alias("alpha"), F.round((alpha - 1) / F.sqrt("n_tail"), 6).alias("sigma"), (F.abs(alpha - 2.4) <= 0.1).alias("near_target"))


def power_law_scan(df: DataFrame, value: str, candidates: list[float]) -> DataFrame:
    """Exponent and KS distance for each candidate of xmin; the smallest distance is the fit.

    Tail sums come from running sums, so each pair of a value and a candidate is looked at once, without a window.
    """
    g = df.select(F.col(value).cast("double").alias("x")).filter("x > 0").groupBy("x").agg(F.count("*").alias("n")).withColumn("l", F.col("n") * F.log("x"))
    x = ranges.running(g, "x", ["n", "l"])
    total = g.agg(F.sum("n").alias("n_all"), F.sum("l").alias("l_all"))
    c = df.sparkSession.createDataFrame([(float(v),) for v in candidates], "xmin double")
    below = g.join(F.broadcast(c), F.col("x") < F.col("xmin")).groupBy("xmin").agg(F.sum("n").alias("n0"), F.sum("l").alias("l0"))
    c = c.join(total).join(below, "xmin", "left").withColumns({"n0": F.coalesce("n0", F.lit(0)), "l0": F.coalesce("l0", F.lit(0.0))})  # a row a candidate
    c = c.withColumn("n_tail", F.col("n_all") - F.col("n0")).withColumn("s", F.col("l_all") - F.col("l0") - F.col("n_tail") * F.log("xmin")).filter("s > 0")
    c = c.withColumn("alpha", 1 + F.col("n_tail") / F.col("s"))
    t = x.join(F.broadcast(c), F.col("x") >= F.col("xmin"))
    ecdf, model = (F.col("upto_n") - F.col("n0")) / F.col("n_tail"), 1 - F.pow(F.col("x") / F.col("xmin"), 1 - F.col("alpha"))
    return t.groupBy("xmin").agg(F.first("alpha").alias("alpha"), F.first("n_tail").alias("n_tail"), F.max(F.abs(ecdf - model)).alias("distance"))


def tail_models(df: DataFrame, value: str, xmin: float) -> DataFrame:
    """Log-likelihood of the tail from ``xmin`` on under a power law, an exponential and a lognormal, each at its estimates.

    The lognormal's parameters are those of the logarithms of the tail, without a correction
    for the cut at ``xmin``; ``best`` names the largest likelihood.
    """
    t = df.select(F.col(value).cast("double").alias("x")).filter(F.col("x") >= xmin)
    g = t.agg(F.count("*").alias("n"), F.sum(F.log(F.col("x") / F.lit(xmin))).alias("s"), F.sum(F.col("x") - F.lit(xmin)).alias("e"), F.avg(F.log("x")).alias("mu"), F.var_pop(F.log("x")).alias("v"), F.sum(F.log("x")).alias("lx"))
    alpha, rate, n = 1 + F.col("n") / F.col("s"), F.col("n") / F.col("e"), F.col("n")
    power = n * F.log((alpha - 1) / F.lit(xmin)) - alpha * F.col("s")
    exponential = n * F.log(rate) - rate * F.col("e")
    lognormal = -F.col("lx") - n / 2 * F.log(2 * F.lit(math.pi) * F.col("v")) - n / 2
    out = g.select("n", power.alias("power_law"), exponential.alias("exponential"), lognormal.alias("lognormal"))
    best = F.when((F.col("power_law") >= F.col("exponential")) & (F.col("power_law") >= F.col("lognormal")), "power_law").when(F.col("exponential") >= F.col("lognormal"), "exponential").otherwise("lognormal")
    return out.withColumn("best", best)


def drift_summary(drift: DataFrame, value: str = "rms", threshold: float = 0.05) -> DataFrame:
    """Mean, extremes, share above the threshold (resynchronised), and the 95th and 99th value by index int(p * (n - 1)) of the sorted ones."""
    g = drift.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count("*").alias("n"))
    c = ranges.running(g, "v", ["n"])
    tot = drift.agg(F.count(value).alias("total"), F.avg(value).alias("mean"), F.avg((F.col(value) > threshold).cast("double")).alias("resync"))
    at = lambda p: F.min(F.when(F.col("upto_n") > F.floor(F.lit(p) * (F.col("total") - 1)), F.col("v")))
    return c.join(F.broadcast(tot)).agg(
        F.first("total").alias("snapshots"), F.round(F.first("mean"), 9).alias("mean"), F.round(F.max("v"), 9).alias("max"), F.round(F.min("v"), 9).alias("min"), F.round(at(0.95), 9).alias("p95"), F.round(at(0.99), 9).alias("p99"), F.round(F.first("resync"), 9).alias("resync_rate"),
    )


def samples(df: DataFrame, value: str) -> DataFrame:
    """Peak, mean, least and 95th value by index int(0.95 * n) of the sorted ones."""
    g = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count("*").alias("n"))
    c = ranges.running(g, "v", ["n"])
    tot = df.agg(F.count(value).alias("total"), F.avg(value).alias("mean"))
    at = F.least(F.floor(F.lit(0.95) * F.col("total")), F.col("total") - 1)
    return c.join(F.broadcast(tot)).agg(F.first("total").alias("n"), F.max("v").alias("peak"), F.round(F.first("mean"), 6).alias("mean"), F.min("v").alias("least"), F.min(F.when(F.col("upto_n") > at, F.col("v"))).alias("p95"))


def distances(df: DataFrame, value: str, first: str) -> DataFrame:
    """Two-sample Cramer-von Mises and Anderson-Darling statistics over counted values; ``first`` is SQL that says which rows are sample one."""
    one = F.expr(first)
    g = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count_if(one).alias("a"), F.count_if(~one).alias("b")).withColumn("h", F.col("a") + F.col("b"))
    x = ranges.running(g, "v", ["a", "b", "h"]).join(F.broadcast(g.agg(F.sum("a").alias("n"), F.sum("b").alias("m"))))
    n, m, upto = F.col("n"), F.col("m"), F.col("upto_h")
    every = n + m
    cvm = F.pow(F.col("upto_a") / n - F.col("upto_b") / m, F.lit(2)) * F.col("h")
    ad = F.when(upto < every, F.pow(F.col("upto_a") * every - n * upto, F.lit(2)) * F.col("h") / (upto * (every - upto)))
    out = x.agg(F.sum(cvm).alias("c"), F.sum(ad).alias("d"), F.first("n").alias("n"), F.first("m").alias("m"))
    return out.select("n", "m", F.round(F.col("c") * n * m / F.pow(every, F.lit(2)), 6).alias("cramer_von_mises"), F.round(F.col("d") / (n * m), 6).alias("anderson_darling"))
