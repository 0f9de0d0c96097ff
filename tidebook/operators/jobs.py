"""Composed jobs: replay with its outputs, enrichment that goes on after a checkpoint, and a worker's whole path.

Each writes Parquet and returns a small table of statistics; inputs may be empty.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.operators import book, sequence, unify


@dataclass(frozen=True)
class ReplayConfig:
    """How a replay runs; ``problems`` names what is out of bounds."""

    depth: int = book.DEPTH
    threshold: float = 0.05
    resync: bool = True
    lossy: bool = False

    def problems(self) -> list[str]:
        out = []
        if not 1 <= self.depth <= 5000:
            out.append("depth must be between 1 and 5000")
        if not 0 <= self.threshold <= 1:
            out.append("threshold must be between 0 and 1")
        return out


#: Presets: every level kept; the top of the book only; drift measured but never corrected.
PRESETS = {"exact": ReplayConfig(), "fast": ReplayConfig(depth=20, lossy=True), "audit": ReplayConfig(resync=False)}


def replay_job(events: DataFrame, out: str, config: ReplayConfig = PRESETS["exact"]) -> DataFrame:
    """Write enriched events and drift rows under ``out``; returns events, snapshots, resynchronisations and mean drift by symbol."""
    if bad := config.problems():
        raise ValueError("; ".join(bad))
    spark = events.sparkSession
    book.replay(events, config.depth, config.threshold, config.resync, config.lossy).write.mode("overwrite").parquet(f"{out}/enriched")
    rows = spark.read.parquet(f"{out}/enriched")
    rows.filter("drift_rms is not null").select("symbol", "event_id", "drift_rms", "drift_max", "resynced").write.mode("overwrite").parquet(f"{out}/drift")
    return rows.groupBy("symbol").agg(F.count("*").alias("events"), F.count("drift_rms").alias("measured"), F.count_if("resynced").alias("resyncs"), F.round(F.avg("drift_rms"), 9).alias("mean_drift"))


def enrich_job(deltas: DataFrame, out: str, resume: DataFrame | None = None) -> DataFrame:
    """Write each delta with its gap and the top of the book after it; returns the last id of each symbol.

    The book is that of all deltas given. With ``resume`` (symbol, update_id: what the function
    returned before) only rows beyond it are written, so a job that is run again goes on.
    """
    rows = sequence.with_gaps(deltas).select("symbol", "update_id", "gap", "after_gap", "needs_recovery")
    top = book.top_of_book(deltas)
    both = rows.join(top, ["symbol", "update_id"])
    if resume is not None:
        last = F.broadcast(resume.select(F.col("symbol"), F.col("update_id").alias("_done")))  # one row a symbol
        both = both.join(last, "symbol", "left").filter("_done is null or update_id > _done").drop("_done")
    both.write.mode("append").parquet(out)
    return deltas.sparkSession.read.parquet(out).groupBy("symbol").agg(F.max("update_id").alias("update_id"))


def symbol_job(trades: DataFrame, snapshots: DataFrame, deltas: DataFrame, symbol: str, out: str, config: ReplayConfig = PRESETS["exact"]) -> DataFrame:
    """One symbol's path: its events are merged, replayed and written; returns the statistics of ``replay_job``."""
    own = [d.filter(F.col("symbol") == symbol) for d in (trades, snapshots, deltas.withColumnRenamed("new_quantity", "quantity"))]
    return replay_job(unify.unioned(*own), f"{out}/symbol={symbol}", config)
