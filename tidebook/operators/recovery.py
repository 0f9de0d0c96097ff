"""Going on after a break: continuity at a checkpoint, synchronising updates with snapshots, checkpoint intervals.

Null symbols are a symbol of their own; null ids take no part. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.operators import ranges


def continuity(checkpoints: DataFrame, updates: DataFrame, most: int = 1000) -> DataFrame:
    """Per checkpoint (symbol, checkpoint): first id after it, gap, updates not beyond it, and the status of going on.

    ``failed`` if more than ``most`` ids are missing, ``no_updates`` without any beyond it,
    ``duplicates`` if updates repeat what the checkpoint holds, else ``ok``.
    """
    key = lambda d: d.withColumn("_key", F.struct("symbol"))
    u = key(updates).select("_key", "update_id").join(F.broadcast(key(checkpoints).select("_key", "checkpoint")), "_key")  # one row a symbol
    beyond = F.col("update_id") > F.col("checkpoint")
    g = u.groupBy("_key").agg(F.min(F.when(beyond, F.col("update_id"))).alias("first_id"), F.count_if(F.col("update_id") <= F.col("checkpoint")).alias("duplicates"))
    out = key(checkpoints).join(g, "_key", "left").withColumn("gap", F.col("first_id") - F.col("checkpoint") - 1)
    status = F.when(F.col("first_id").isNull(), "no_updates").when(F.col("gap") > most, "failed").when(F.col("duplicates") > 0, "duplicates").otherwise("ok")
    return out.select("symbol", "checkpoint", "first_id", "gap", F.coalesce("duplicates", F.lit(0)).alias("duplicates"), status.alias("status"))


def synchronised(snapshots: DataFrame, updates: DataFrame, points: DataFrame, attempts: int = 5) -> DataFrame:
    """Per symbol: the first of at most ``attempts`` snapshots (in id order) that an update applies to, and from where it must resynchronise.

    ``points`` is what ``sequence.sync_points`` returns for them. ``stale`` counts the updates
    that end before the snapshot; ``resync_at`` is the first later update that doesn't continue the one before it.
    """
    tried = snapshots.select("symbol", F.col("update_id").alias("last_id"), F.row_number().over(Window.partitionBy("symbol").orderBy("update_id")).alias("attempt")).filter(F.col("attempt") <= attempts)
    hit = tried.join(points, ["symbol", "last_id"], "left")
    first = hit.groupBy("symbol").agg(F.min(F.when(F.col("first_update").isNotNull(), F.struct("attempt", "last_id", "first_update"))).alias("s"), F.max("attempt").alias("tried"))
    u = ranges.lagged(updates, {"_prev": "final_id"}, "first_id", "symbol")
    j = u.join(F.broadcast(first), "symbol")  # one row a symbol
    stale, broken = F.col("final_id") <= F.col("s.last_id"), (F.col("first_id") > F.col("s.first_update")) & (F.col("first_id") != F.col("_prev") + 1)
    g = j.groupBy("symbol").agg(F.count_if(stale).alias("stale"), F.min(F.when(broken, F.col("first_id"))).alias("resync_at"))
    out = first.join(g, "symbol", "left")
    return out.select("symbol", F.coalesce("s.attempt", "tried").cast("long").alias("attempts"), F.col("s").isNotNull().alias("synced"), F.col("s.last_id").alias("last_id"), F.col("s.first_update").alias("first_update"), F.coalesce("stale", F.lit(0)).alias("stale"), "resync_at")


def intervals(checkpoints: DataFrame, time: str, order: str, key: str = "symbol") -> DataFrame:
    """Per key: checkpoints, and the mean, least and largest time from one to the next."""
    step = ranges.lagged(checkpoints, {"_prev": time}, order, key).withColumn("_d", F.col(time) - F.col("_prev"))
    return step.groupBy(key).agg(F.count("*").alias("checkpoints"), F.round(F.avg("_d"), 3).alias("mean_interval"), F.min("_d").alias("least_interval"), F.max("_d").alias("largest_interval"))
