"""Ordered computations that no single task does alone: rows are cut into ranges, and what a range needs of those before is carried.

A key may hold a third of all rows. So values are ordered within a key and a range of the order
column, and one row a range (its last value, its sums) is windowed over the key. Keys and
values may be null; a null key is a key of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Values of the order column in a range that is windowed on its own.
SPAN = 65_536
#: Ranges that counted values are cut into, at quantiles of the distinct values.
CUTS = 128


def lagged(df: DataFrame, values: dict[str, str], order: str, key: str, tie: list[str] | None = None, span: int = SPAN) -> DataFrame:
    """``df`` with, for each new name, the value of the row before in the key's order (``order`` is a long, then ``tie``)."""
    # a struct makes null keys equal, and tells a null value from none
    d = df.withColumn("_key", F.struct(F.col(key).alias("k"))).withColumn("_part", F.struct(F.expr(f"`{order}` div {span}").alias("p")))
    along = [order, *(tie or [])]
    kept = F.struct(*[F.col(v).alias(n) for n, v in values.items()])
    tops = d.groupBy("_key", "_part").agg(F.max_by(kept, F.struct(*along)).alias("_top"))
    tops = tops.select("_key", "_part", F.lag("_top").over(Window.partitionBy("_key").orderBy("_part")).alias("_before"))
    d = d.withColumn("_row", F.lag(kept).over(Window.partitionBy("_key", "_part").orderBy(*along)))
    out = d.join(tops, ["_key", "_part"], "left")
    was = F.coalesce("_row", "_before")
    return out.select(*df.columns, *[was[n].alias(n) for n in values])


def running(counted: DataFrame, value: str, sums: list[str], by: list[str] | None = None, cuts: int = CUTS) -> DataFrame:
    """``counted`` (distinct values of each group of ``by``) with ``upto_<sum>``, the running sums in the order of the value."""
    by = by or []
    at = counted.agg(F.percentile_approx(value, [k / cuts for k in range(1, cuts)], 2000)).first()[0] or []
    edges = F.array(*[F.lit(x) for x in sorted(set(at))]) if at else F.array().cast("array<double>")
    ranged = counted.withColumn("_part", F.size(F.filter(edges, lambda e: e < F.col(value))))
    parts = ranged.groupBy(*by, "_part").agg(*[F.sum(s).alias(f"_{s}") for s in sums])
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # CUTS rows a group
    parts = parts.select(*[F.col(b).alias(f"_by_{b}") for b in by], F.col("_part").alias("_of"), *[F.coalesce(F.sum(f"_{s}").over(before), F.lit(0)).alias(f"_{s}") for s in sums])
    same = ranged["_part"] == F.col("_of")
    for b in by:
        same = same & ranged[b].eqNullSafe(F.col(f"_by_{b}"))
    inner = Window.partitionBy(*by, "_part").orderBy(value)
    out = ranged.withColumns({f"upto_{s}": F.sum(s).over(inner) for s in sums})
    out = out.join(F.broadcast(parts) if not by else parts, same)
    return out.select(*counted.columns, *[(F.col(f"upto_{s}") + F.col(f"_{s}")).alias(f"upto_{s}") for s in sums])


def placed(df: DataFrame, order: list, part: str, key: str | None = None) -> DataFrame:
    """``df`` with ``place``, the row's number (from 1) in the order of its key, or of all rows; ``part`` is SQL of a range that grows with the order."""
    d = df.withColumn("_key", F.struct(F.col(key).alias("k")) if key else F.lit(0)).withColumn("_part", F.expr(part))
    counts = d.groupBy("_key", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_key").orderBy(F.asc_nulls_first("_part")).rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    counts = counts.select("_key", F.struct(F.col("_part").alias("p")).alias("_range"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    d = d.withColumn("_range", F.struct(F.col("_part").alias("p")))
    rank = F.row_number().over(Window.partitionBy("_key", "_range").orderBy(*order))
    return d.withColumn("_rank", rank).join(counts, ["_key", "_range"]).select(*df.columns, (F.col("_rank") + F.col("_before")).cast("long").alias("place"))


def carried(df: DataFrame, value: str, order: list, part: str, key: str) -> DataFrame:
    """``df`` with ``_last``, the latest non-null value up to the row in the order of its key."""
    d = df.withColumn("_key", F.struct(F.col(key).alias("k"))).withColumn("_range", F.struct(F.expr(part).alias("p")))
    upto = Window.partitionBy("_key", "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_last", F.last(value, ignorenulls=True).over(upto))
    tops = d.groupBy("_key", "_range").agg(F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.struct(*order))).alias("_top"))
    before = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select("_key", "_range", F.last("_top", ignorenulls=True).over(before).alias("_before"))
    return d.join(tops, ["_key", "_range"]).select(*df.columns, F.coalesce("_last", "_before").alias("_last"))

