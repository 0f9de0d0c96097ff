"""Best-two-fit packing of tokenised documents into fixed-length sequences.

Lengths are whole numbers from 1 to the capacity, so the packing problem is
fully described by its histogram, which has at most ``capacity`` entries however
large the corpus is. The driver packs that histogram: it fills a bin greedily with
the longest documents that fit, then replaces the bin's smallest document with two
unpacked ones that fit the expanded gap more tightly, and repeats the resulting
pattern as often as the counts allow. The plan (pattern runs) is what travels to
the workers; documents find their place by their rank among the documents of equal
length, counted in salted groups so that a very frequent length is never ranked by
one task.

Nulls: a null text is an empty document (one end token); a null id stays null.
Repeated rows are documents of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import itertools
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.llm import _shared

CAPACITY = 2048
END = 0
#: Pieces of one length that one task ranks, about: salts follow from the number of all pieces.
RANKED = 500_000


@lru_cache(maxsize=2)
def _encoder(ranks_file: str, pattern: str):
    """tiktoken over the ranks of the byte-level vocabulary: the same ids as the tokenizers file, about four times as fast."""
    import tiktoken

    with open(ranks_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def _reference_encoder(json_file: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(json_file)
    t.encode_special_tokens = True
    return t


def encoded(text: str, ranks_file: str, pattern: str, json_file: str) -> bytes:
    """Ids of ``text`` as little-endian unsigned 32-bit numbers, without the end token."""
    try:
        return bytes(memoryview(_encoder(ranks_file, pattern)._core_bpe.encode_to_tiktoken_buffer(text, set())))
    except Exception:  # its regex engine gives up on some extreme runs; the slower encoder of the same vocabulary does not
        return np.array(_reference_encoder(json_file).encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens: full ones, of which only the first may be shorter."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, tokenizer_dir: str | None = None, keep_ids: bool = True) -> DataFrame:
    """Tokenise ``docs`` and cut what is longer than ``capacity``.

    Returns id, piece, start, length, ids_crc32 and, with ``keep_ids``, ids: the
    piece's token ids as little-endian unsigned 32-bit numbers (binary).
    """
    import public_tokenizers

    _shared.tuned(docs.sparkSession)
    where = tokenizer_dir.rstrip("/") + "/" if tokenizer_dir else ""
    ranks, json_file = (where + f if where else public_tokenizers.path(f) for f in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json"))
    ranks, json_file, pattern = str(ranks), str(json_file), public_tokenizers.PATTERN
    end = np.array([END], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(_shared.text_slices(b, text_col) for b in batches):
            out: list[list] = [[], [], [], [], [], []]
            ids = batch.column(batch.schema.get_field_index(id_col)).to_pylist()
            for doc, text in zip(ids, batch.column(batch.schema.get_field_index(text_col)), strict=True):
                raw = encoded(text.as_py() or "", ranks, pattern, json_file) + end
                for k, (start, length) in enumerate(piece_bounds(len(raw) // 4, capacity)):
                    part = raw[4 * start : 4 * (start + length)]
                    for col, v in zip(out, (doc, k, start, length, zlib.crc32(part), part if keep_ids else None), strict=True):
                        col.append(v)
            arrays = [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)]
            names = [id_col, "piece", "start", "length", "ids_crc32", "ids"]
            k = 6 if keep_ids else 5
            yield pa.RecordBatch.from_arrays(arrays[:k], names=names[:k])

    schema = f"`{id_col}` long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias(text_col)).mapInArrow(cut, schema)


def packing_plan(counts: np.ndarray, capacity: int) -> np.ndarray:
    """Best-two-fit on a histogram: ``counts[n]`` documents of length n.

    Returns rows (length, first rank, first sequence, times in a sequence, offset):
    documents of that length from that rank on fill one sequence after the other.
    """
    left = counts.astype(np.int64).copy()
    next_rank = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    while left.any():
        have = np.flatnonzero(left)
        used: dict[int, int] = {}
        gap, at = capacity, len(have) - 1
        while at >= 0:
            n = int(have[at])
            if times := min(int(left[n]), gap // n):
                used[n] = times
                gap -= times * n
            at = min(at, int(np.searchsorted(have, gap, side="right"))) - 1 if gap >= have[0] else -1
        # replace the smallest document by two that fill its place and the gap more tightly
        while gap and sum(used.values()) > 1:
            smallest = min(used)
            room = gap + smallest
            spare = left.copy()
            for n, times in used.items():
                spare[n] -= times
            free = np.flatnonzero(spare[: room + 1])
            if not len(free):
                break
            partner = np.searchsorted(free, np.minimum(room - free, free), side="right") - 1
            ok = partner >= 0
            a, b = free[ok], free[partner[ok]]
            fits = (a != b) | (spare[a] > 1)
            a, b = a[fits], b[fits]
            if not len(a) or int((a + b).max()) <= smallest:
                break
            best = int(np.argmax(a + b))
            used[smallest] -= 1
            if not used[smallest]:
                del used[smallest]
            for n in (int(a[best]), int(b[best])):
                used[n] = used.get(n, 0) + 1
            gap = room - int(a[best] + b[best])
        bins = min(int(left[n]) // times for n, times in used.items())
        offset = 0
        for n in sorted(used, reverse=True):
            rows.append((n, int(next_rank[n]), sequence, used[n], offset))
            offset += n * used[n]
            next_rank[n] += bins * used[n]
            left[n] -= bins * used[n]
        sequence += bins
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def packed(parts: DataFrame, id_col: str = "doc_id", capacity: int = CAPACITY, ranked_rows: int = RANKED) -> DataFrame:
    """Give each piece its sequence_id and offset; ``parts`` must be a written table with length, piece and ids_crc32.

    All columns of ``parts`` stay. Lengths outside 1..capacity raise.
    """
    spark = parts.sparkSession
    keys = [id_col, "piece", "ids_crc32"]
    salts = 16 + parts.count() // ranked_rows  # full pieces may all have one length
    salted = parts.withColumn("_salt", F.pmod(F.xxhash64(*keys), F.lit(salts)).cast("int"))
    groups = _shared.written(salted.groupBy("length", "_salt").agg(F.count("*").alias("_n")), "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for n, times in groups.groupBy("length").agg(F.sum("_n")).collect():  # one row for each length: capacity rows at most
        if not 1 <= n <= capacity:
            raise ValueError(f"a piece has {n} tokens; the capacity is {capacity}")
        counts[n] = times
    plan = spark.sparkContext.broadcast(packing_plan(counts, capacity))
    before = groups.select("length", "_salt", (F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n")).alias("_before"))
    ranked = salted.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*keys, "start")) - 1).join(before, ["length", "_salt"])
    ranked = ranked.select(*parts.columns, (F.col("_rank") + F.col("_before")).cast("long").alias("_rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = plan.value
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "_rank"))
            # runs are sorted by length, then first rank: find each row's run
            order = np.searchsorted(runs[:, 0] * (1 << 48) + runs[:, 1], length * (1 << 48) + rank, side="right") - 1
            run, k = runs[order], rank - runs[order, 1]
            out = batch.drop_columns(["_rank"])
            yield out.append_column("sequence_id", pa.array(run[:, 2] + k // run[:, 3])).append_column("offset", pa.array(run[:, 4] + k % run[:, 3] * length))

    schema = ", ".join(f"`{n}` {t}" for n, t in parts.dtypes) + ", sequence_id long, offset long"
    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, tokenizer_dir: str | None = None, keep_ids: bool = True) -> DataFrame:
    """Tokenise, cut and pack whole documents; see ``pieces`` and ``packed`` for the columns."""
    parts = _shared.written(pieces(docs, id_col, text_col, capacity, tokenizer_dir, keep_ids), "pieces")
    return packed(parts, id_col, capacity)
