"""Interpolated modified Kneser-Ney bigram model, counted in Spark and memory-mapped by workers.

Counting runs twice over the training texts. First the words: each task counts the hashes of
a run of tokens and deals sorted (hash, count) blocks by hash range; a reducer merges a
range into a sorted array. A word's place in the concatenation of the ranges is its
number. Then the bigrams: sorted blocks of (context, word) numbers are dealt by the
context's range and merged to sorted arrays as well; contexts so frequent that they would
fill a range are spread over all ranges by a hash of the pair. Blocks of thousands of
entries are shuffled instead of rows, and all of a range's followers of a context meet in
one place, so its numbers of followers seen once, twice or more often are counted there.

The model is a folder of sorted arrays in the cluster's shared folder. Workers map the files
into memory and look words and pairs up by binary search; nothing of the model's size passes
the driver. Its memory needs follow the number of ranges, which follows the input's partitions.
The folder must be a path that all executors mount (``file:``), as memory mapping needs one.

The order is two: nearly all longer n-grams of a large corpus are unique, so a third order
doubles the arrays. Tokens are words split at white space, A-Z lower-cased, then one end token;
a start mark is context only. Unknown words share one further place of the vocabulary.
Null and blank texts consist of their end. Repeated rows count and are scored each. Without
training rows every word is unknown and the model is uniform. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.llm import _shared

#: Tokens that a task counts before it deals them out.
RUN = 1_000_000
#: Hash ranges at most (six files each); at 100 TB of text a range's blocks then take some 400 MB.
MOST_RANGES = 262_144
#: Bits of a word number in a pair's key; the context's number within its range has the others.
WORD_BITS = 40
END = np.uint64(0x45C4_8E01_F00D_0001)

_U = np.uint64


def token_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all rows, each row closed by the end token; each row's first token."""
    raw, at = _shared.text_bytes(column)
    raw = _shared.lowered(raw)
    starts, ends, word_at = _shared.word_spans(raw, at)
    n = np.diff(word_at)
    first = word_at + np.arange(len(word_at))
    out = np.full(len(starts) + len(n), END, np.uint64)
    out[np.arange(len(starts)) + np.repeat(np.arange(len(n)), n)] = _shared.span_hashes(raw, starts, ends)
    return out, first


def _local(folder: str) -> str:
    if not folder.startswith("file:") and "://" in folder:
        raise NotImplementedError(f"the model is memory-mapped, so spark.checkpoint.dir must be a mounted path, not {folder}")
    return "/" + folder.removeprefix("file:").lstrip("/")


def _save(path: str, values: np.ndarray) -> None:
    """Write an array in one step, so that a repeated task leaves one whole file."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    values.tofile(part)
    os.replace(part, path)


@lru_cache(maxsize=30_000)  # systems allow some 65,000 maps
def _mapped(path: str, kind: str) -> np.ndarray:
    return np.memmap(path, kind, "r") if os.path.getsize(path) else np.zeros(0, kind)


@dataclass
class Model:
    """Where the arrays are, and the few numbers that all workers need."""

    folder: str
    ranges: int
    base: np.ndarray  # first word number of each range, and the number of words
    tokens: int = 0
    rows: int = 0  # training rows: how often the start mark is a context
    hot: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # numbers of spread contexts
    hot_followers: np.ndarray = field(default_factory=lambda: np.zeros((0, 3)))
    discount: np.ndarray = field(default_factory=lambda: np.zeros(4))
    low_discount: np.ndarray = field(default_factory=lambda: np.zeros(4))
    low_gamma: float = 1.0
    pairs: int = 0

    @property
    def words(self) -> int:
        return int(self.base[-1])

    def range_of(self, h: np.ndarray) -> np.ndarray:
        """Ranges of hashes: equal parts of their values."""
        return ((h >> _U(32)) * _U(self.ranges) >> _U(32)).astype(np.int64)

    def _by_range(self, r: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(range, begin, end) of sorted range numbers."""
        if len(r):
            cut = np.concatenate([[0], np.flatnonzero(r[1:] != r[:-1]) + 1, [len(r)]])
            yield from zip(r[cut[:-1]].tolist(), cut[:-1].tolist(), cut[1:].tolist(), strict=True)

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """Word numbers of sorted hashes; -1 for unknown ones."""
        out = np.full(len(h), -1, np.int64)
        for r, a, b in self._by_range(self.range_of(h)):
            keys = _mapped(f"{self.folder}/words/{r}", "<u8")
            if len(keys):
                k = np.minimum(np.searchsorted(keys, h[a:b]), len(keys) - 1)
                out[a:b] = np.where(keys[k] == h[a:b], k + self.base[r], -1)
        return out

    def gather(self, name: str, kind: str, numbers: np.ndarray, width: int = 1) -> np.ndarray:
        """Values of sorted word numbers from the arrays ``name``; 0 for unknown words."""
        out = np.zeros((len(numbers), width) if width > 1 else len(numbers), np.int64)
        known = np.flatnonzero(numbers >= 0)
        n = numbers[known]
        for r, a, b in self._by_range(np.searchsorted(self.base, n, side="right") - 1):
            values = _mapped(f"{self.folder}/{name}/{r}", kind)
            out[known[a:b]] = (values.reshape(-1, width) if width > 1 else values)[n[a:b] - self.base[r]]
        return out

    def pair_range(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Ranges of pairs: the context's, or any for spread contexts."""
        r = np.searchsorted(self.base, context, side="right") - 1
        if len(self.hot):
            k = np.minimum(np.searchsorted(self.hot, context), len(self.hot) - 1)
            spread = self.range_of(_shared.mixed(_shared.mixed(context.astype(np.uint64)) ^ word.astype(np.uint64)))
            r = np.where(self.hot[k] == context, spread, r)
        return np.clip(r, 0, self.ranges - 1)

    def pair_keys(self, context: np.ndarray, word: np.ndarray, r: np.ndarray) -> np.ndarray:
        """Keys of pairs within their ranges: the context's number there (spread contexts count from the end) and the word's."""
        own = context - self.base[r]
        if len(self.hot):
            k = np.minimum(np.searchsorted(self.hot, context), len(self.hot) - 1)
            own = np.where(self.hot[k] == context, (1 << 64 - WORD_BITS) - 1 - k, own)
        return (own.astype(np.uint64) << _U(WORD_BITS)) | word.astype(np.uint64)

    def pair_counts(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """How often the known pairs were seen; in any order."""
        r = self.pair_range(context, word)
        key = self.pair_keys(context, word, r)
        order = np.lexsort((key, r))
        out = np.zeros(len(key), np.int64)
        for part, a, b in self._by_range(r[order]):
            keys = _mapped(f"{self.folder}/pairs/{part}", "<u8")
            if len(keys):
                want = key[order[a:b]]
                k = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
                found = keys[k] == want
                count = _mapped(f"{self.folder}/counts/{part}", "u1")[k].astype(np.int64)
                if (count == 255).any():
                    many = _mapped(f"{self.folder}/many/{part}", "<u8").reshape(-1, 2)
                    big = count == 255
                    count[big] = many[np.minimum(np.searchsorted(many[:, 0], want[big]), len(many) - 1), 1]
                out[order[a:b]] = np.where(found, count, 0)
        return out

    def score(self, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per row: the model's and the base model's log10 probability, and the number of known tokens."""
        types, code = np.unique(h, return_inverse=True)
        number = self.numbers(types)
        count = self.gather("tally", "<u8", number)
        cont = self.gather("cont", "<u8", number)
        size = self.words + 1
        low = np.where(cont > 0, (cont - self.low_discount[np.minimum(cont, 3)]) / max(self.pairs, 1), 0.0) + self.low_gamma / size
        followers = self.gather("followers", "<u4", number, 3)
        if len(self.hot):
            k = np.minimum(np.searchsorted(self.hot, number), len(self.hot) - 1)
            followers = np.where((self.hot[k] == number)[:, None], self.hot_followers[k], followers)
        gamma = np.where(count > 0, followers @ self.discount[1:] / np.maximum(count, 1), 1.0)
        # contexts: the token before, the start mark at a row's first token
        at = np.zeros(len(h), bool)
        at[first[:-1]] = True
        before = np.append(0, code[:-1])
        start = self.hot_followers[-1] if self.rows else np.zeros(3)
        start_gamma = start @ self.discount[1:] / self.rows if self.rows else 1.0
        context = np.where(at, self.words, number[before])
        total = np.where(at, self.rows, count[before])
        back = np.where(at, start_gamma, gamma[before])
        word = number[code]
        seen = np.flatnonzero((context >= 0) & (word >= 0) & (total > 0))
        pair = np.zeros(len(h), np.int64)
        if len(seen):
            pair[seen] = self.pair_counts(context[seen], word[seen])
        high = np.where(pair > 0, (pair - self.discount[np.minimum(pair, 3)]) / np.maximum(total, 1), 0.0)
        log_p = np.log10(high + back * low[code])
        log_base = np.log10((count + 0.5) / (self.tokens + 0.5 * size))[code]
        rows = first[:-1]
        return np.add.reduceat(log_p, rows), np.add.reduceat(log_base, rows), np.add.reduceat((count > 0)[code].astype(np.int64), rows)


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order].astype(np.int64)
    head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[head], np.add.reduceat(counts, head)


def _discounts(n: np.ndarray) -> np.ndarray:
    """D0..D3+ from the numbers n1..n4 of things seen once to four times (Chen and Goodman)."""
    n1, n2, n3, n4 = (float(x) for x in n)
    if not n1 or not n2:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    d = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.5]
    return np.array([0.0] + [min(max(x, 0.05), k) for k, x in enumerate(d[1:], 1)])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens and row beginnings of about ``RUN`` tokens at a time."""
    held, size = [], 0
    for batch in itertools.chain.from_iterable(_shared.text_slices(b, "text") for b in batches):
        held.append(token_hashes(batch.column(0)))
        size += len(held[-1][0])
        if size >= RUN:
            yield _joined(held)
            held, size = [], 0
    if held:
        yield _joined(held)


def _joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    at = np.cumsum([0] + [len(h) for h, _ in parts])
    return np.concatenate([h for h, _ in parts]), np.concatenate([f[:-1] + a for (_, f), a in zip(parts, at, strict=False)])


def trained(texts: DataFrame) -> Model:
    """Count ``texts`` (one column, text) and write the model's arrays to the shared folder."""
    spark = texts.sparkSession
    ranges = max(8, min(MOST_RANGES, 4 * texts.rdd.getNumPartitions()))
    folder = _local(_shared.shared_dir(spark))
    blank = Model(folder, ranges, np.zeros(ranges + 1, np.int64))

    def dealt(r: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
        """One row a range: its part of the columns as bytes; r is sorted."""
        parts = list(blank._by_range(r))
        arrays = [pa.array([p[0] for p in parts], pa.int32())] + [pa.array([c[a:b].tobytes() for _, a, b in parts], pa.binary()) for c in columns]
        return pa.RecordBatch.from_arrays(arrays, names=["range", *[f"c{k}" for k in range(len(columns))]])

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, _ in _runs(batches):
            types, n = np.unique(h, return_counts=True)
            yield dealt(blank.range_of(types), types, n.astype("<u4"))

    def merge_words(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        r = key[0]
        types, n = _merged(*(np.frombuffer(b"".join(blocks[c]), k) for c, k in (("c0", "<u8"), ("c1", "<u4"))))
        n = n.astype(np.int64)
        _save(f"{folder}/words/{r}", types.astype("<u8"))
        _save(f"{folder}/tally/{r}", n.astype("<u8"))
        top = np.argsort(-n)[:64]
        top = top[n[top] * 512 >= n.sum()]
        return pd.DataFrame({"range": [r], "types": [len(types)], "tokens": [int(n.sum())], "top": [top.tolist()], "top_n": [n[top].tolist()]})

    words = texts.mapInArrow(count_words, "range int, c0 binary, c1 binary").groupBy("range").applyInPandas(merge_words, "range int, types long, tokens long, top array<long>, top_n array<long>")
    stats = {r["range"]: r for r in words.collect()}  # a row a range
    base = np.cumsum([0] + [stats[r]["types"] if r in stats else 0 for r in range(ranges)])
    if np.diff(base).max() >= 1 << 64 - WORD_BITS - 1:
        raise ValueError(f"a range has {np.diff(base).max()} different words; more ranges are needed")
    tokens = sum(s["tokens"] for s in stats.values())
    model = Model(folder, ranges, base, tokens, texts.count())
    for r in set(range(ranges)) - set(stats):
        for name in ("words", "tally"):
            _save(f"{folder}/{name}/{r}", np.zeros(0, np.uint8))
    frequent = [int(base[r]) + k for r, s in stats.items() for k, n in zip(s["top"], s["top_n"], strict=True) if n * 8 * ranges > tokens]
    model.hot = np.array([*sorted(frequent), model.words], np.int64)  # the start mark is a context of all rows
    known = spark.sparkContext.broadcast(model)

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = known.value
        for h, first in _runs(batches):
            types, code = np.unique(h, return_inverse=True)
            before = np.append(0, code[:-1])
            before[first] = len(types)  # the start mark
            pair, n = np.unique((before.astype(np.int64) << 32) | code, return_counts=True)
            number = np.append(m.numbers(types), m.words)
            context, word = number[pair >> 32], number[pair & 0xFFFFFFFF]
            r = m.pair_range(context, word)
            key = m.pair_keys(context, word, r)
            order = np.lexsort((key, r))
            key, n, r = key[order], n[order], r[order]
            context, word = (key >> _U(WORD_BITS)).astype("<u4"), key & _U((1 << WORD_BITS) - 1)
            for part, a, b in m._by_range(r):
                head = np.flatnonzero(np.append(True, context[a + 1 : b] != context[a : b - 1]))
                many = n[a:b] > 254
                parts = (context[a:b][head], np.diff(np.append(head, b - a)).astype("<u4"), (word[a:b] & _U(0xFFFFFFFF)).astype("<u4"), (word[a:b] >> _U(32)).astype("u1"), np.where(many, 255, n[a:b]).astype("u1"), n[a:b][many].astype("<u4"))
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32())] + [pa.array([x.tobytes()], pa.binary()) for x in parts], names=["range", "contexts", "lengths", "words", "high", "counts", "many"])

    def merge_pairs(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        m, r = known.value, key[0]
        get = lambda c, k: np.frombuffer(b"".join(blocks[c]), k)
        pairs = (np.repeat(get("contexts", "<u4"), get("lengths", "<u4")).astype(np.uint64) << _U(WORD_BITS)) | (get("high", "u1").astype(np.uint64) << _U(32)) | get("words", "<u4")
        n = get("counts", "u1").astype(np.int64)
        n[n == 255] = get("many", "<u4")
        pairs, n = _merged(pairs, n)
        many = n >= 255
        _save(f"{folder}/pairs/{r}", pairs.astype("<u8"))
        _save(f"{folder}/counts/{r}", np.minimum(n, 255).astype("u1"))
        _save(f"{folder}/many/{r}", np.stack([pairs[many], n[many].astype(np.uint64)], axis=1).astype("<u8"))
        context, word = (pairs >> _U(WORD_BITS)).astype(np.int64), (pairs & _U((1 << WORD_BITS) - 1)).astype(np.int64)
        kind = np.minimum(n, 3) - 1
        own = np.zeros((m.base[r + 1] - m.base[r], 3), "<u4")
        k = (1 << 64 - WORD_BITS) - 1 - context
        spread = k < len(m.hot)
        np.add.at(own, (context[~spread], kind[~spread]), 1)
        _save(f"{folder}/followers/{r}", own)
        shared = np.zeros((len(m.hot), 3), np.int64)
        np.add.at(shared, (k[spread], kind[spread]), 1)
        # the words' numbers of different contexts, to their own ranges
        types, times = np.unique(word, return_counts=True)
        at = np.searchsorted(m.base, types, side="right") - 1
        parts = list(m._by_range(at))
        seen = [int((n == c).sum()) for c in range(1, 5)]
        return pd.DataFrame(
            {
                "range": [-1] + [p for p, _, _ in parts], "words": [b""] + [(types[a:b] - m.base[p]).astype("<u4").tobytes() for p, a, b in parts], "times": [b""] + [times[a:b].astype("<u4").tobytes() for _, a, b in parts],
                "seen": [seen] + [[]] * len(parts), "hot": [shared.ravel().tolist()] + [[]] * len(parts),
            }
        )

    pairs = texts.mapInArrow(count_pairs, "range int, contexts binary, lengths binary, words binary, high binary, counts binary, many binary")
    merged = _shared.written(pairs.groupBy("range").applyInPandas(merge_pairs, "range int, words binary, times binary, seen array<long>, hot array<long>"), "contexts")
    sums = merged.filter("range = -1").select(F.posexplode(F.concat("seen", "hot")).alias("k", "v")).groupBy("k").agg(F.sum("v").alias("v")).collect()  # a number for each hot context
    total = np.zeros(4 + 3 * len(model.hot), np.int64)
    for row in sums:
        total[row["k"]] = row["v"]
    model.discount, model.hot_followers = _discounts(total[:4]), total[4:].reshape(-1, 3).astype(float)

    def merge_contexts(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        m, r = known.value, key[0]
        word, times = (np.frombuffer(b"".join(blocks[c]), "<u4").astype(np.int64) for c in ("words", "times"))
        cont = np.bincount(word, times, m.base[r + 1] - m.base[r]).astype("<u8")
        _save(f"{folder}/cont/{r}", cont)
        return pd.DataFrame({"seen": [[int((cont == c).sum()) for c in range(1, 5)] + [int((cont >= 3).sum()), int(cont.sum())]]})

    parts = merged.filter("range >= 0").groupBy("range").applyInPandas(merge_contexts, "seen array<long>")
    n = np.array([sum(x) for x in zip(*(r["seen"] for r in parts.collect()), strict=True)] or [0] * 6)  # a row a range
    model.low_discount, model.pairs = _discounts(n[:4]), int(n[5])
    model.low_gamma = float(model.low_discount[1:] @ [n[0], n[1], n[4]]) / model.pairs if model.pairs else 1.0
    for r in range(ranges):  # ranges that nothing fell into
        for name, width in (("pairs", 0), ("counts", 0), ("many", 0), ("followers", 12), ("cont", 8)):
            if not os.path.exists(path := f"{folder}/{name}/{r}"):
                _save(path, np.zeros(width * int(base[r + 1] - base[r]), np.uint8))
    return model


def scored(docs: DataFrame, train: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of each row; log10 probabilities of whole texts.

    ``train`` says which rows the model learns from (all by default).
    """
    spark = docs.sparkSession
    _shared.tuned(spark)
    texts = (docs.filter(train) if train is not None else docs).select(F.col(text_col).alias("text"))
    model = spark.sparkContext.broadcast(trained(texts))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in itertools.chain.from_iterable(_shared.text_slices(b, "text") for b in batches):
            h, first = token_hashes(batch.column(1))
            score, base, known = m.score(h, first)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(first)), pa.array(known), pa.array(np.full(len(known), m.tokens)), pa.array(base), pa.array(score)],
                names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(work, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
