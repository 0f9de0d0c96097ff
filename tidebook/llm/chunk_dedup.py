"""Repeated passages by content-defined chunking.

A gear rolling hash over the last ``WINDOW`` bytes of the lower-cased text cuts it into chunks
where it is smaller than at ``REACH`` places to either side, so cuts depend on nearby bytes only
and an insertion moves no cut but those around it. White space runs count as one space. Each
chunk is known by its digest and that of the chunk before it (a pair of neighbouring chunks, so
a short common phrase is no repeat); pairs whose digest occurs in several documents are
repeats, and maximal runs of repeated chunks that cover ``MIN_WORDS`` words are repeated
passages. A run is divided where the smallest document that holds its pairs changes: that
document keeps the part, the others are told which one that is. So a text from which all parts
are taken that it doesn't keep still stands, chunk by chunk, in some document.

Digests are 64 bits wide and not compared byte by byte: a run of ``MIN_WORDS`` words has
several of them in a row, so equal digests of different texts make no run.

Digests are counted by one aggregation with map-side sums, and only digests that several
documents share are joined back, so the hottest passage costs one row for each occurrence.

Nulls: rows without id take no part; null and blank texts have no chunks. Rows that repeat
an id and text count once, different texts of one id are told apart and repeat nothing of
one another. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.llm import _shared

#: Chunks end where the rolling hash is a strict minimum within its reach, which is less than its window
#: so that no cut depends on another row, and at MAX bytes (text of a short period has no such minimum).
WINDOW, REACH, MAX = 16, 15, 128
#: Words that a run of repeated chunks must cover. A repeat keeps the chunks between its first and
#: last cut that depend on it alone, which are about WINDOW + 2 * REACH bytes from its start and
#: 2 * REACH from its end.
MIN_WORDS = 26

_U = np.uint64
_GEAR = np.random.default_rng(7).integers(0, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)


def gear(raw: np.ndarray) -> np.ndarray:
    """Gear hash after each byte: the sum of the last ``WINDOW`` bytes' random numbers, the older ones shifted further."""
    h = _GEAR[raw] & _U(0xFFFFFFFF)
    span = 1
    while span < WINDOW:  # doubling: a window of 2k is two windows of k
        old = h.copy()
        h[span:] += old[:-span] << _U(span)
        span *= 2
    return h & _U(0xFFFFFFFF)


def chunk_ends(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sorted ends of the chunks of all rows."""
    if not len(raw):
        return np.zeros(0, np.int64)
    h = np.full(len(raw) + 2 * REACH, 0xFFFFFFFF, np.uint32)
    h[REACH:-REACH] = gear(raw)
    starts = np.unique(at[:-1])
    for k in range(WINDOW - 1):  # the window lies within the row
        h[REACH + starts[starts + k < len(raw)] + k] = 0xFFFFFFFF
    # minima of spans of REACH places: of 8, then of two that overlap
    low = h
    for span in (1, 2, 4):
        low = np.minimum(low[:-span], low[span:])
    low = np.minimum(low[: 8 - REACH], low[REACH - 8 :])
    here = h[REACH:-REACH]
    soft = np.flatnonzero((here < low[: len(raw)]) & (here < low[REACH + 1 :])) + 1
    hard = np.unique(at[at > 0])
    cuts = np.union1d(soft, hard)
    # what is left too long is cut every MAX bytes
    starts = np.concatenate([[0], cuts[:-1]])
    extra = (cuts - starts - 1) // MAX
    long = np.flatnonzero(extra > 0)
    if len(long):
        k = np.arange(extra[long].sum()) - np.repeat(np.cumsum(extra[long]) - extra[long], extra[long])
        cuts = np.union1d(cuts, np.repeat(starts[long], extra[long]) + (k + 1) * MAX)
    return cuts


def chunks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, digest of a chunk with the one before, and two packed numbers, which ``_unpacked`` opens."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(_shared.text_slices(b, "text") for b in batches):
            raw, at = _shared.text_bytes(batch.column(1))
            chars = _shared.char_index(raw)
            low = _shared.lowered(raw)
            blank = np.isin(low, np.array([9, 10, 11, 12, 13, 32], np.uint8))
            low = np.where(blank, np.uint8(32), low)
            if not len(low):
                continue
            keep = np.ones(len(low), bool)
            keep[1:] = ~(blank[1:] & blank[:-1])
            keep[at[:-1][at[:-1] < len(low)]] = True
            place = np.flatnonzero(keep)
            text, rows_at = low[keep], np.searchsorted(place, at)
            ends = chunk_ends(text, rows_at)
            starts = np.concatenate([[0], ends[:-1]])
            row = np.searchsorted(rows_at, starts, side="right") - 1
            h = _shared.span_hashes(text, starts, ends)
            space = np.zeros(len(text) + 1, np.int64)
            np.cumsum(text == 32, out=space[1:])
            pair = np.flatnonzero(row[1:] == row[:-1]) + 1
            if not len(pair):
                continue
            ids = batch.column(0).to_numpy()[row[pair]]
            first_chunk = np.searchsorted(row, np.arange(len(at) - 1))
            first_of_row = first_chunk[row[pair]]
            orig = np.append(place, len(raw))
            begin, stop = orig[starts[pair - 1]], orig[ends[pair] - 1] + 1
            row_begin = at[row[pair]]
            words, before = space[ends[pair]] - space[starts[pair]], space[starts[pair]] - space[starts[pair - 1]]
            span = (chars[begin] - chars[row_begin] << 32) | (chars[stop] - chars[row_begin])
            whole = np.add.reduceat(_shared.mixed(h + np.arange(len(h), dtype=np.uint64) - first_chunk[row].astype(np.uint64)), first_chunk[np.unique(row)])
            version = (_shared.mixed(whole) >> _U(48)).astype(np.int64)[np.searchsorted(np.unique(row), row[pair])]
            info = (pair - first_of_row << 32) | (version << 16) | (words << 8) | before
            digest = _shared.mixed(h[pair - 1] * _U(3) ^ _shared.mixed(h[pair])).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(digest), pa.array(span), pa.array(info)], names=["doc_id", "digest", "span", "info"])

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).filter("doc_id is not null and text is not null")
    return plain.mapInArrow(work, "doc_id long, digest long, span long, info long")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Passages that several documents hold: doc_id, start, stop (code points), n_words, first_doc_id, keeps.

    One row for each part of a maximal run of repeated chunks; ``first_doc_id`` is the smallest
    id that holds the part's chunks, ``keeps`` whether this row is that document's. Parts of
    a text don't overlap; a run covers ``min_words`` words, its parts may be shorter.
    """
    _shared.tuned(docs.sparkSession)
    parts = chunks(docs, id_col, text_col)  # cut twice: chunk rows would take most of the input's size on disk
    shared = parts.groupBy("digest").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high").select("digest", F.col("low").alias("first_doc_id"))
    # rows stay packed on their way; repeated rows of an id share all numbers
    hits = parts.join(shared, "digest").select("doc_id", "span", "info", "first_doc_id").dropDuplicates(["doc_id", "info"])
    hits = hits.withColumn("version", F.expr("cast((info >> 16) & 65535 as int)")).repartition("doc_id", "version").select("doc_id", "version", *_unpacked(), "first_doc_id")
    # neighbouring hits of a document form a run: k minus its rank stays the same
    text, run = ["doc_id", "version"], ["doc_id", "version", "run"]
    along = Window.partitionBy(*run).orderBy("k")
    hits = hits.withColumn("run", F.col("k") - F.row_number().over(Window.partitionBy(*text).orderBy("k")))
    hits = hits.withColumns({"last_first": F.lag("first_doc_id").over(along), "last_stop": F.lag("stop").over(along)})
    hits = hits.withColumn("words", F.col("words") + F.when(F.col("last_stop").isNull(), F.col("before")).otherwise(0))
    hits = hits.withColumns({"part": F.sum((~F.col("first_doc_id").eqNullSafe(F.col("last_first"))).cast("int")).over(along), "run_words": F.sum("words").over(Window.partitionBy(*run))})
    out = hits.filter(F.col("run_words") >= min_words).groupBy(*run, "part").agg(
        F.min(F.coalesce("last_stop", "start")).alias("start"), F.max("stop").alias("stop"), F.min("first_doc_id").alias("first_doc_id"), F.sum("words").cast("long").alias("n_words"),
    )
    return out.select("doc_id", "start", "stop", "n_words", "first_doc_id", (F.col("doc_id") == F.col("first_doc_id")).alias("keeps"))


def _unpacked() -> list:
    """k (place of the chunk in its text), start and stop (code points of the pair), words of the chunk and of the one before."""
    parts = {"k": "info >> 32", "start": "span >> 32", "stop": "span & 4294967295", "words": "(info >> 8) & 255", "before": "info & 255"}
    return [F.expr(e).alias(n) for n, e in parts.items()]
