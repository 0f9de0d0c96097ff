"""Sinks: hourly Parquet with a manifest, JSON lines, quarantine and checksums."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidebook.functions import scalars as S
from tidebook.operators import unify

#: Rows in a file at most.
FILE_ROWS = 5_000_000


def hour_columns(time: str = "event_timestamp") -> list[Column]:
    path = F.split(S.hour_path(F.col(time)), "/")
    return [path[k].alias(n) for k, n in enumerate(("year", "month", "day", "hour"))]


def for_file(events: DataFrame) -> DataFrame:
    """Unified events as they are stored: decimals of 18 places, levels as JSON."""
    c = dict(events.dtypes)
    out = events
    for name in ("trade_price", "trade_quantity", "delta_price", "delta_quantity"):
        out = out.withColumn(name, F.col(name).cast(S.DECIMAL)) if name in c else out
    for name in ("bids", "asks"):
        out = out.withColumn(name, F.to_json(name)) if c.get(name, "string") not in ("string", "void") else out
    return out


def write_events(events: DataFrame, path: str, quarantine: str | None = None) -> None:
    """Valid events by symbol and UTC hour, sorted by time in each file; invalid ones with their reason to ``quarantine``."""
    checked = unify.problems(events)
    good = for_file(checked.filter("reason is null").drop("reason")).select("*", *hour_columns())
    dealt = good.repartition("symbol", "year", "month", "day", "hour").sortWithinPartitions("symbol", "year", "month", "day", "hour", "event_timestamp")
    (dealt.write.mode("append").partitionBy("symbol", "year", "month", "day", "hour").option("compression", "snappy").option("parquet.enable.dictionary", "false").option("maxRecordsPerFile", FILE_ROWS).parquet(path))
    if quarantine:
        for_file(checked.filter("reason is not null")).write.mode("append").parquet(quarantine)


def manifest(events: DataFrame, time: str = "event_timestamp") -> DataFrame:
    """One row a symbol and hour: rows, first and last time, event types."""
    hour = S.hour_path(F.col(time)).alias("partition_path")
    return events.groupBy("symbol", hour).agg(F.count("*").alias("row_count"), F.min(time).alias("timestamp_min"), F.max(time).alias("timestamp_max"), F.array_join(F.sort_array(F.collect_set("event_type")), ",").alias("event_types"))


def append_manifest(events: DataFrame, path: str, batch: int = 0, time: str = "event_timestamp") -> None:
    """Add the manifest rows of some events to the manifest table; ``batch`` tells repeated additions apart."""
    manifest(events, time).withColumn("batch", F.lit(batch).cast("long")).write.mode("append").parquet(path)


def compacted(rows: DataFrame) -> DataFrame:
    """One row a symbol and hour of appended manifest rows; of additions under one batch number one counts."""
    once = rows.dropDuplicates(["batch", "symbol", "partition_path"])
    types = F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_set(F.split("event_types", ","))))), ",")  # few types a row
    return once.groupBy("symbol", "partition_path").agg(F.sum("row_count").alias("row_count"), F.min("timestamp_min").alias("timestamp_min"), F.max("timestamp_max").alias("timestamp_max"), types.alias("event_types"))


def compact_manifest(spark: SparkSession, path: str, out: str) -> DataFrame:
    """Read an appended manifest table, write it compacted to ``out`` and return that table."""
    compacted(spark.read.parquet(path)).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def from_file(events: DataFrame) -> DataFrame:
    """Unified events as ``for_file`` stored them, with levels as arrays again."""
    for name in ("bids", "asks"):
        if dict(events.dtypes).get(name) == "string":
            events = events.withColumn(name, F.from_json(name, "array<struct<price:decimal(38,18),quantity:decimal(38,18)>>"))
    return events


def overlapping(rows: DataFrame, begin: int, end: int) -> DataFrame:
    """Partitions that hold times between the bounds."""
    return rows.filter((F.col("timestamp_max") >= begin) & (F.col("timestamp_min") <= end))


def manifest_stats(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("partitions"), F.sum("row_count").alias("rows"), F.min("timestamp_min").alias("first"), F.max("timestamp_max").alias("last"))


def read_range(spark: SparkSession, path: str, begin: int, end: int) -> DataFrame:
    """Events between two times; the hours' directories are pruned first."""
    df = spark.read.parquet(path)
    hour = lambda ns: F.date_format(F.timestamp_seconds(F.lit(ns // 10**9)), "yyyy/MM/dd/HH")
    key = F.concat_ws("/", F.col("year").cast("string"), F.lpad(F.col("month").cast("string"), 2, "0"), F.lpad(F.col("day").cast("string"), 2, "0"), F.lpad(F.col("hour").cast("string"), 2, "0"))
    return df.filter(key.between(hour(begin), hour(end)) & F.col("event_timestamp").between(begin, end))


def write_messages(df: DataFrame, path: str, hourly: bool = False) -> None:
    """Messages as gzip JSON lines, one folder an hour of ``capture_ns`` if asked."""
    if hourly:
        df = df.withColumn("hour", F.replace(S.hour_path(F.col("capture_ns")), F.lit("/"), F.lit("-")))
    writer = df.write.mode("append").option("compression", "gzip")
    (writer.partitionBy("hour") if hourly else writer).json(path)


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256, MD5 and size of each file under a path."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"), F.md5("content").alias("md5"))


def verified(found: DataFrame, expected: DataFrame, name: str = "path", digest: str = "sha256") -> DataFrame:
    """Each file of either list: ok, mismatch, missing (only expected) or unlisted (only found)."""
    j = found.select(name, F.col(digest).alias("_f")).join(expected.select(name, F.col(digest).alias("_e")), name, "full")
    status = F.when(F.col("_e").isNull(), "unlisted").when(F.col("_f").isNull(), "missing").when(F.col("_f") == F.col("_e"), "ok").otherwise("mismatch")
    return j.select(name, status.alias("status"))


def session_metadata(spark: SparkSession, path: str) -> str:
    """JSON of a capture session: its files with sizes and SHA-256, and totals (one line a file reaches the driver)."""
    files = [r.asDict() for r in checksums(spark, path).drop("md5").orderBy("path").collect()]
    return json.dumps({"files": files, "file_count": len(files), "bytes": sum(f["length"] for f in files)}, indent=1)


def report(rows: DataFrame, title: str, limit: int = 1000) -> tuple[str, str]:
    """A small result as (JSON, Markdown); a report shows ``limit`` rows at most and says so."""
    names, got = rows.columns, [r.asDict(recursive=True) for r in rows.limit(limit + 1).collect()]
    more = f"\n\nFirst {limit} rows." if len(got) > limit else ""
    got = got[:limit]
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|")
    lines = ["| " + " | ".join(names) + " |", "|" + "---|" * len(names), *["| " + " | ".join(cell(r[n]) for n in names) + " |" for r in got]]
    return json.dumps({"title": title, "rows": got}, default=str, indent=1), f"# {title}\n\n" + "\n".join(lines) + more + "\n"


def kept_latest(files: DataFrame, key: str, order: str, n: int) -> DataFrame:
    """The latest ``n`` rows of each key (checkpoints, log segments), with their rank; the rest may go."""
    w = Window.partitionBy(key).orderBy(F.desc_nulls_last(order))
    return files.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
