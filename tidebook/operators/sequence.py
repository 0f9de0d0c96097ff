"""Sequence gaps and chronology: one window over each symbol's order, then grouped sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebook.functions import scalars as S
from tidebook.operators import ranges


def with_gaps(deltas: DataFrame, key: str = "symbol", recovery: int = 1000) -> DataFrame:
    """Each delta with expected_id, gap (actual - expected; -1 for a duplicate), after_gap and needs_recovery.

    Order is by id, then time; null ids come first and have no gap. Symbols may be null.
    """
    out = ranges.lagged(deltas, {"_prev": "update_id"}, "update_id", key, [c for c in ("origin_time",) if c in deltas.columns])
    out = out.withColumn("expected_id", F.col("_prev") + 1).drop("_prev")
    out = out.withColumn("gap", F.col("update_id") - F.col("expected_id"))
    return out.withColumn("after_gap", F.coalesce(F.col("gap") != 0, F.lit(False))).withColumn("needs_recovery", F.coalesce(F.col("gap") > recovery, F.lit(False)))


def gap_rows(deltas: DataFrame, key: str = "symbol") -> DataFrame:
    """One row a gap: expected_id, actual_id, gap_size, origin_time."""
    return with_gaps(deltas, key).filter("after_gap").select(key, "expected_id", F.col("update_id").alias("actual_id"), F.col("gap").alias("gap_size"), "origin_time")


def gap_summary(deltas: DataFrame, key: str = "symbol") -> DataFrame:
    """Positive gaps of each symbol: numbers, sum, largest, ratio to the id span in per cent and to the updates."""
    g = with_gaps(deltas, key)
    pos = F.when(F.col("gap") > 0, F.col("gap"))
    out = g.groupBy(key).agg(F.count("*").alias("updates"), F.count(pos).alias("gaps"), F.coalesce(F.sum(pos), F.lit(0)).alias("missing"), F.coalesce(F.max(pos), F.lit(0)).alias("largest"), F.min("update_id").alias("first_id"), F.max("update_id").alias("last_id"))
    span = F.col("last_id") - F.col("first_id")
    return out.withColumn("missing_percent", F.when(span > 0, F.round(F.col("missing") * 100.0 / span, 6)).otherwise(0.0)).withColumn("gap_ratio", F.round(F.col("gaps") / F.col("updates"), 6))


def gap_histogram(deltas: DataFrame, bucket: bool = False, key: str = "symbol") -> DataFrame:
    """Number of positive gaps by exact size or by size class."""
    by = S.gap_bucket(F.col("gap")).alias("bucket") if bucket else F.col("gap").alias("gap_size")
    return with_gaps(deltas, key).filter("gap > 0").groupBy(by).agg(F.count("*").alias("n"))


def range_gaps(updates: DataFrame, key: str = "symbol", order: str = "seq", first: str = "first_id", last: str = "final_id") -> DataFrame:
    """Updates with first and last id: those whose first id is not the last id before plus 1; gap or out_of_order."""
    out = ranges.lagged(updates, {"_prev": last}, order, key).withColumn("expected", F.col("_prev") + 1).drop("_prev")
    out = out.filter(F.col(first) != F.col("expected"))
    return out.withColumn("kind", F.when(F.col(first) > F.col("expected"), "gap").otherwise("out_of_order")).withColumn("size", F.abs(F.col(first) - F.col("expected")))


def chronology(df: DataFrame, time: str, order: str, key: str) -> DataFrame:
    """Per key: rows, rows earlier than the row before, largest step back, and whether it is sorted."""
    g = ranges.lagged(df, {"_prev": time}, order, key).withColumn("_back", F.col("_prev") - F.col(time)).groupBy(key).agg(F.count("*").alias("rows"), F.count_if(F.col("_back") > 0).alias("out_of_order"), F.greatest(F.max("_back"), F.lit(0)).alias("largest_step_back"))
    return g.withColumn("largest_step_back", F.coalesce("largest_step_back", F.lit(0))).withColumn("is_sorted", F.col("out_of_order") == 0)


def across_files(df: DataFrame, file: str, time: str, order: str) -> DataFrame:
    """Per file: whether it begins before the last message of the file before (one row a file is windowed)."""
    g = df.groupBy(file).agg(F.min_by(time, order).alias("first_time"), F.max_by(time, order).alias("last_time"))
    prev = F.lag("last_time").over(Window.orderBy(file))
    return g.withColumn("overlaps", F.coalesce(F.col("first_time") < prev, F.lit(False)))


def jumps(df: DataFrame, value: str, order: str, key: str) -> DataFrame:
    """Per key: steps over 1 and over 1000 of a value in row order, unsorted."""
    d = ranges.lagged(df, {"_prev": value}, order, key).withColumn("_d", F.col(value) - F.col("_prev"))
    return d.groupBy(key).agg(F.count_if(F.col("_d") > 1).alias("over_1"), F.count_if(F.col("_d") > 1000).alias("over_1000"))


def sync_points(snapshots: DataFrame, updates: DataFrame, key: str = "symbol") -> DataFrame:
    """First update (first_id, final_id) that applies to each snapshot: first_id <= last_id + 1 <= final_id; older ones are stale.

    The range condition is a join on id buckets, so a snapshot meets only the updates around it.
    """
    width = 64
    at = snapshots.select(key, F.col("update_id").alias("last_id"), F.expr(f"(update_id + 1) div {width}").alias("_b"))
    up = updates.select(key, "first_id", "final_id", F.explode(F.expr(f"sequence(first_id div {width}, final_id div {width})")).alias("_b"))
    hit = at.join(up, [key, "_b"]).filter("first_id <= last_id + 1 and last_id + 1 <= final_id")
    return hit.groupBy(key, "last_id").agg(F.min("first_id").alias("first_update"), F.min_by("final_id", "first_id").alias("final_update"))


def as_of(left: DataFrame, right: DataFrame, key: str, time: str, value: str, tie: str | None = None, span: int = 3_600_000_000_000) -> DataFrame:
    """``left`` with the latest ``value`` of ``right`` at or before its time: one union and ranged windows, no range join.

    Of rows of ``right`` with one time the last by ``tie`` counts (by default the largest value).
    Null values are passed over; a null time comes before all others.
    """
    names = left.columns
    both = left.withColumns({"_v": F.lit(None).cast(dict(right.dtypes)[value]), "_side": F.lit(1), "_tie": F.lit(None).cast("long" if tie is None else dict(right.dtypes)[tie])})
    last = F.col(tie) if tie else F.col(value)
    add = right.select(F.col(key), F.col(time), F.col(value).alias("_v"), F.lit(0).alias("_side"), last.alias("_tie"))
    both = both.withColumn("_tie", F.col("_tie").cast(dict(add.dtypes)["_tie"]))
    every = both.unionByName(add, allowMissingColumns=True)
    every = ranges.carried(every, "_v", [F.col(time), F.col("_side"), F.col("_tie")], f"`{time}` div {span}", key)
    return every.filter("_side = 1").select(*names, F.col("_last").alias(value))
