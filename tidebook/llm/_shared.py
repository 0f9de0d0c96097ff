"""Parts that several operators of this subpackage use.

Three things live here: tables written to the folder that the whole cluster
shares (to cut lineage and to survive lost executors), byte-level text
vectorisation with NumPy, and connected components over an edge table.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step works on; bounds a worker's memory.
SLICE_BYTES = 1 << 19

_M1, _M2, _SEED = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_LANE = np.array([0] + [(1 << (8 * k)) - 1 for k in range(1, 9)], dtype=np.uint64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


# ---------------------------------------------------------------- shared tables


def shared_dir(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``; where that is unset, a temporary one on one machine, as in tests, and an error on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        base = "file://" + tempfile.mkdtemp(prefix="tidebook-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tidebook-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}"
    schema = df.schema
    df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out.shared_path = path
    return out


def released(*tables: DataFrame) -> None:
    """Remove written tables that nothing reads any more: all that came from them is written itself."""
    for t in tables:
        spark = t.sparkSession
        jpath = spark._jvm.org.apache.hadoop.fs.Path(t.shared_path.rsplit("/", 1)[0])
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


# ------------------------------------------------------------------ text in bulk


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Zero-copy row slices of ``batch`` with about ``limit`` bytes of text each, one row at least."""
    n = batch.num_rows
    if not n:
        return
    at = text_bytes(batch.column(batch.schema.get_field_index(column)))[1]
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, side="right")) - 1)
        yield batch.slice(i, min(j, n) - i)
        i = j


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its row offsets; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    return raw, at - at[0]


def lowered(raw: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, all other bytes as they are."""
    return _LOWER[raw]


def word_spans(raw: np.ndarray, at: np.ndarray, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in ``raw`` and, per row, the index of its first word.

    ``inside`` says which byte values belong to words; white space separates by default.
    """
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    word = ~_SPACE[raw] if inside is None else inside[raw]
    edge = np.zeros(n + 1, dtype=bool)
    edge[at] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:n]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, at, side="left")


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans, eight bytes a step."""
    lens = ends - starts
    padded = np.empty(len(raw) + 8, np.uint8)
    padded[: len(raw)] = raw
    padded[len(raw) :] = 0
    eights = np.ndarray((len(raw) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    h = mixed(lens.astype(np.uint64) + _SEED)
    step, left = 0, None
    while True:
        if left is None:
            h = mixed(h ^ (eights[starts] & _LANE[np.minimum(lens, 8)]))
        else:
            h[left] = mixed(h[left] + _SEED ^ (eights[starts[left] + step] & _LANE[np.minimum(lens[left] - step, 8)]))
        step += 8
        left = np.flatnonzero(lens > step) if left is None else left[lens[left] > step]
        if not len(left):
            return h


def char_index(raw: np.ndarray) -> np.ndarray:
    """For each byte position (and the end), how many code points begin before it."""
    out = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=out[1:])
    return out


# ---------------------------------------------------------- connected components


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b: long): id, component (the smallest id reachable).

    Alternating large-star and small-star steps until the edges form stars: each step is one
    grouped minimum, which Spark combines before the shuffle, and one join that adaptive
    execution splits where a node has very many neighbours. Each round is written to the
    shared folder; rounds grow with the logarithm of the largest diameter. Nulls and loops
    are left out.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else e
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        kept = both.filter("b > a") if large else both
        linked = kept.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        if not large:
            linked = linked.unionByName(low.select("a", F.col("m").alias("b")))
        return down(linked)

    def down(e: DataFrame) -> DataFrame:
        """Each edge once, from the larger to the smaller end."""
        return e.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def settled(e: DataFrame) -> bool:
        """Whether each node has one smaller neighbour at most, which has none."""
        ends = e.select(F.col("a").alias("v"), F.lit(1).alias("up")).unionByName(e.select(F.col("b").alias("v"), F.lit(0).alias("up")))
        return ends.groupBy("v").agg(F.sum("up").alias("s"), F.min("up").alias("m")).filter("s > 1 or s = 1 and m = 0").isEmpty()

    e = written(down(edges), "edges")
    while not settled(e):
        before, e = e, written(star(star(e, True), False), "edges")
        released(before)
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def unused(name: str, names: list[str]) -> str:
    """``name``, lengthened until no column has it."""
    while name.lower() in {n.lower() for n in names}:
        name += "_"
    return name


def tuned(spark: SparkSession) -> None:
    """Arrow batches of at most 1,000 rows for this session, so that long texts stay within a worker's memory.

    Python workers also get this package's place on their path; where executors do not
    see it, ship the package with --py-files.
    """
    place = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if place not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (paths, place) if x)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > 1000:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
