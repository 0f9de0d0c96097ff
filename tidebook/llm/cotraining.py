"""Quality classifier by co-training on two views of a document.

View one is the text's content: byte, word and line statistics of the whole text. View two
is the page's metadata: language, source and stated length, never the text. Each view has an additive
logistic model over binned features. In each round, each model labels all unlabelled documents
on the executors, and what it is confident of joins the other view's training set as
pseudo-labels: the executors sum their gradients and curvature bounds, which is all that
the other view's fit needs of them. In the end both views are calibrated on labelled rows that
took no part, and a logistic combination of the calibrated views scores all documents.

Of the labelled rows at most ``LABELLED`` (smallest hashes first) reach the driver, as feature
rows; unlabelled ones are as many as the table has, and reach it as sums of fixed size. All
documents are scored whole on the executors. Null and blank texts score as empty texts; null
metadata is a value of its own. Repeated rows each get a score; of contradictory labels of one
id the good one counts. An empty table gives an empty result. Without labels of both classes
every document gets the share of good labels (1 without labels). An input column that is named
like the score is replaced by it.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.llm import _shared

#: Labelled rows that the models are fitted on; rounds of exchange; confidence that makes a pseudo-label.
LABELLED, ROUNDS, CONFIDENT = 6_000, 3, 0.98
#: The weight of all pseudo-labels together, as a share of the labelled rows.
WEIGHT = 0.3
#: Bins of a numeric feature; hashed bins of a category.
BINS, HASHED = 16, 64
#: Documents below this probability of being good are rejected; low, as losing a good one costs more.
THRESHOLD = 0.1

CONTENT = (
    "bytes", "words", "word_bytes", "long_words", "upper", "digits", "marks", "symbols", "other", "distinct_words", "top_word", "repeated_pairs", "lines", "line_bytes", "repeated_lines", "end_marks", "pipes", "upper_words",
)

_CLASS = np.zeros(256, np.int8)  # 1 upper, 2 lower, 3 digit, 4 sentence mark, 5 symbol, 6 beyond ASCII, 7 space
_CLASS[0x41:0x5B], _CLASS[0x61:0x7B], _CLASS[0x30:0x3A], _CLASS[0x80:] = 1, 2, 3, 6
_CLASS[[ord(c) for c in ".,;:?'\"-"]] = 4
_CLASS[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~()"]] = 5
_CLASS[[9, 10, 11, 12, 13, 32]] = 7


def _repeats(h: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Per row the share of its hashes that occurred before in it."""
    n = np.bincount(row, minlength=rows)
    if not len(h):
        return np.zeros(rows)
    order = np.lexsort((h, row))
    again = np.append(False, (h[order][1:] == h[order][:-1]) & (row[order][1:] == row[order][:-1]))
    return np.bincount(row[order], again, rows) / np.maximum(n, 1)


def content_features(column: pa.Array) -> np.ndarray:
    """Rows of ``CONTENT`` statistics of whole texts."""
    raw, at = _shared.text_bytes(column)
    rows = len(at) - 1
    n = np.diff(at).astype(float)
    row = np.repeat(np.arange(rows), np.diff(at))
    kind = np.bincount(row * 8 + _CLASS[raw], minlength=8 * rows).reshape(rows, 8) / np.maximum(n, 1)[:, None]
    starts, ends, word_at = _shared.word_spans(raw, at)
    words = np.diff(word_at).astype(float)
    word_row = np.repeat(np.arange(rows), np.diff(word_at))
    lens = ends - starts
    h = _shared.span_hashes(_shared.lowered(raw), starts, ends) if len(starts) else np.zeros(0, np.uint64)
    mean = lambda v: np.bincount(word_row, v, rows) / np.maximum(words, 1)
    inner = word_row[1:] == word_row[:-1]
    pairs = _shared.mixed(h[:-1] * np.uint64(3) + h[1:])[inner] if len(h) > 1 else h[:0]
    top = np.zeros(rows)
    if len(h):
        order = np.lexsort((h, word_row))
        head = np.flatnonzero(np.append(True, (h[order][1:] != h[order][:-1]) | (word_row[order][1:] != word_row[order][:-1])))
        np.maximum.at(top, word_row[order][head], np.diff(np.append(head, len(h))))
    line = np.ones(256, bool)
    line[0x0A] = False
    l_starts, l_ends, l_at = _shared.word_spans(raw, at, line)
    l_row = np.repeat(np.arange(rows), np.diff(l_at))
    l_hash = _shared.span_hashes(raw, l_starts, l_ends) if len(l_starts) else np.zeros(0, np.uint64)
    lines = np.diff(l_at).astype(float)
    last = raw[ends - 1] if len(ends) else raw[:0]
    capital = (_CLASS[raw[starts]] == 1) & (_CLASS[raw[np.maximum(starts, ends - 2)]] == 1) & (lens > 1) if len(starts) else np.zeros(0, bool)
    return np.stack(
        [
            np.log1p(n), np.log1p(words), mean(lens), mean(lens > 14), kind[:, 1], kind[:, 3], kind[:, 4], kind[:, 5], kind[:, 0] + kind[:, 6], 1 - _repeats(h, word_row, rows), top / np.maximum(words, 1),
            _repeats(pairs, word_row[1:][inner] if len(h) > 1 else word_row[:0], rows), np.log1p(lines), np.log1p(n / np.maximum(lines, 1)), _repeats(l_hash, l_row, rows), mean(np.isin(last, np.frombuffer(b".!?", np.uint8))), kind[:, 5] * 0 + np.bincount(row, raw == 0x7C, rows) / np.maximum(n, 1), mean(capital),
        ],
        axis=1,
    )


def metadata_features(lang: list[str | None], source: list[str | None], length: list[int | None]) -> np.ndarray:
    """Rows of (language, source, length bin) numbers."""
    number = lambda x: 0 if x is None else 1 + zlib.crc32(x.encode()) % (HASHED - 1)
    return np.array([[number(a), number(b), 0 if c is None else 1 + min(int(np.log2(max(c, 0) + 1) * 2), HASHED - 2)] for a, b, c in zip(lang, source, length, strict=True)], np.int64).reshape(-1, 3)


@dataclass
class View:
    """An additive logistic model over binned features, and its calibration (slope, offset)."""

    edges: list[np.ndarray] | None  # of numeric features; None: the features are bins already
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    calibration: tuple[float, float] = (1.0, 0.0)

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Weight numbers of each row's features; the last weight is the constant."""
        if self.edges is None:
            return x + np.arange(x.shape[1]) * HASHED
        return np.stack([np.searchsorted(e, x[:, k], side="right") + k * (BINS + 1) for k, e in enumerate(self.edges)], axis=1)

    def size(self, features: int) -> int:
        return features * (HASHED if self.edges is None else BINS + 1) + 1

    def fit(self, x: np.ndarray, y: np.ndarray, extra: tuple[float, np.ndarray, np.ndarray] | None = None) -> None:
        """Logistic regression with a small penalty by Newton's method.

        ``extra``: number, gradient and curvature of pseudo-labelled rows at the present weights.
        They enter as the quadratic that bounds their likelihood from below (a row of k
        features has a curvature of at most k / 4 on each of them).
        """
        b = np.hstack([self.bins(x), np.full((len(x), 1), self.size(x.shape[1]) - 1)])
        design = np.zeros((len(x), self.size(x.shape[1])))
        design[np.arange(len(x))[:, None], b] = 1
        start = self.weights if len(self.weights) else np.zeros(design.shape[1])
        pull, bend = np.zeros_like(start), np.zeros_like(start)
        if extra and extra[0]:
            share = WEIGHT * len(y) / extra[0]
            pull, bend = share * extra[1], share * b.shape[1] * extra[2]
        beta = start
        for _ in range(15):
            p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
            h = (design * (p * (1 - p))[:, None]).T @ design + np.diag(bend + 0.5)
            step = np.linalg.solve(h, design.T @ (y - p) + pull - bend * (beta - start) - 0.5 * beta)
            beta = beta + step
            if np.abs(step).max() < 1e-4:
                break
        self.weights = beta

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.of_bins(self.bins(x))

    def of_bins(self, b: np.ndarray) -> np.ndarray:
        return self.weights[b].sum(axis=1) + self.weights[-1]

    def calibrated(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.logit(x), -30, 30) * self.calibration[0] + self.calibration[1]


@dataclass
class Model:
    content: View
    metadata: View
    mix: np.ndarray  # weights of the calibrated views and a constant
    prior: float | None = None

    def score(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        """Probability of being good."""
        if self.prior is not None:
            return np.full(len(content), self.prior)
        z = np.stack([self.content.calibrated(content), self.metadata.calibrated(metadata), np.ones(len(content))], axis=1) @ self.mix
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, start: np.ndarray, penalty: float) -> np.ndarray:
    """Logistic regression that is drawn towards ``start``."""
    beta = start.astype(float)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(x.shape[1])
        beta = beta + np.linalg.solve(h, x.T @ (y - p) - penalty * (beta - start))
    return beta


def content_edges(content: np.ndarray) -> list[np.ndarray] | None:
    """Edges of the bins of each content feature: quantiles of the labelled rows."""
    return [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in content.T] if len(content) else None


def pseudo_sums(one: View, two: View, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """What each view gets of rows that the other is confident of: number, gradient and curvature bound of its weights, in one vector.

    ``first`` and ``second`` are the rows' weight numbers in both views.
    """
    p, q = (1 / (1 + np.exp(-np.clip(v.of_bins(b), -30, 30))) for v, b in ((one, first), (two, second)))
    out = []
    for to, bins, mine, other in ((one, first, p, q), (two, second, q, p)):
        sure = np.flatnonzero((other >= CONFIDENT) | (other <= 1 - CONFIDENT))
        wrong, size = (other[sure] > 0.5) - mine[sure], len(to.weights)
        b = np.hstack([bins[sure], np.full((len(sure), 1), size - 1)])
        out += [[len(sure)], np.bincount(b.ravel(), np.repeat(wrong, b.shape[1]), size), np.bincount(b.ravel(), minlength=size) / 4]
    return np.concatenate(out)


def cotrained(content: np.ndarray, metadata: np.ndarray, y: np.ndarray, sums: Callable[[View, View], np.ndarray]) -> Model:
    """Two views trained together; every third labelled row only serves calibration and combination.

    ``sums`` gives ``pseudo_sums`` of all unlabelled rows for two views.
    """
    edges = content_edges(content)
    one, two = View(edges), View(None)
    if not len(y) or y.min() == y.max():
        return Model(one, two, np.zeros(3), float(y.mean()) if len(y) else 1.0)
    held = np.arange(len(y)) % 3 == 2
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.zeros(len(y), bool)
    learn = ~held
    one.fit(content[learn], y[learn])
    two.fit(metadata[learn], y[learn])
    for _ in range(ROUNDS):
        given = sums(one, two)
        for view, x in ((one, content), (two, metadata)):
            size = len(view.weights)
            view.fit(x[learn], y[learn], (given[0], given[1 : 1 + size], given[1 + size : 1 + 2 * size]))
            given = given[1 + 2 * size :]
    check = held if held.any() else learn
    for view, x in ((one, content), (two, metadata)):
        a, b = _logistic(np.stack([np.clip(view.logit(x[check]), -30, 30), np.ones(check.sum())], axis=1), y[check], np.array([1.0, 0.0]), 1.0)
        view.calibration = (max(float(a), 0.0), float(b))
    z = np.stack([one.calibrated(content[check]), two.calibrated(metadata[check]), np.ones(check.sum())], axis=1)
    return Model(one, two, _logistic(z, y[check], np.array([1.0, 0.0, 0.0]), 1.0))


def _views(docs: DataFrame, text_col: str, extra: list[str]) -> DataFrame:
    """doc_id, content (binary row of floats), lang, source, n_chars and ``extra`` columns of each row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(_shared.text_slices(b, "text") for b in batches):
            x = content_features(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), *[batch.column(k) for k in range(1, batch.num_columns)]], names=["content", *batch.schema.names[1:]])

    names = ["lang", "source", "n_chars", *extra]
    plain = docs.select(F.col(text_col).alias("text"), *names)
    kinds = dict(plain.dtypes)
    return plain.mapInArrow(work, "content binary, " + ", ".join(f"{n} {kinds[n]}" for n in names))


def _binned(docs: DataFrame, text_col: str, view: View) -> DataFrame:
    """_id and the bins of both views (bytes) of each row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offsets = np.arange(len(CONTENT)) * (BINS + 1)
        for batch in itertools.chain.from_iterable(_shared.text_slices(b, "text") for b in batches):
            first = (view.bins(content_features(batch.column(1))) - offsets).astype(np.uint8)
            second = metadata_features(*(batch.column(k).to_pylist() for k in (2, 3, 4))).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r.tobytes() for r in x], pa.binary()) for x in (first, second)]], names=["_id", "first", "second"])

    return docs.select("_id", F.col(text_col).alias("text"), "lang", "source", "n_chars").mapInArrow(work, "_id long, first binary, second binary")


def _summed(rows: DataFrame, one: View, two: View) -> np.ndarray:
    """``pseudo_sums`` of all rows: each task adds up its own, the tasks' vectors are added by place."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                first, second = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(batch.num_rows, -1).astype(np.int64) for k in (0, 1))
                part = pseudo_sums(one, two, first + np.arange(first.shape[1]) * (BINS + 1), second + np.arange(second.shape[1]) * HASHED)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["place", "value"])

    out = np.zeros(2 + 2 * len(one.weights) + 2 * len(two.weights))
    for r in rows.select("first", "second").mapInArrow(work, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect():  # a number for each weight
        out[r["place"]] = r["value"]
    return out


def model_of(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> Model:
    """A model from a bounded sample of the labelled and from all unlabelled documents."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.max(label_col).cast("double").alias("y"))
    picked = known.orderBy(F.xxhash64("_id"), "_id").limit(LABELLED)
    plain = docs.select(F.col(id_col).cast("long").alias("_id"), text_col, *_metadata(docs))
    # features leave the executors, not texts
    rows = _views(plain.join(F.broadcast(picked), "_id"), text_col, ["y", "_id"]).orderBy(F.xxhash64("_id"), "content", "lang", "source", "n_chars").limit(LABELLED).collect()  # LABELLED rows at most
    content = np.array([np.frombuffer(r["content"], float) for r in rows]).reshape(-1, len(CONTENT))
    metadata = metadata_features([r["lang"] for r in rows], [r["source"] for r in rows], [r["n_chars"] for r in rows])
    free: list[DataFrame] = []

    def sums(one: View, two: View) -> np.ndarray:
        if not free:  # 21 bytes a document
            binned = _shared.written(_binned(plain, text_col, one), "binned")
            free.append(_shared.written(binned.join(known.select("_id"), "_id", "left_anti"), "unlabelled"))
            _shared.released(binned)
        return _summed(free[0], one, two)

    model = cotrained(content, metadata, np.array([r["y"] for r in rows], float), sums)
    _shared.released(*free)
    return model


def _metadata(docs: DataFrame) -> list:
    """lang, source and n_chars of ``docs``; null where there is no such column."""
    return [(F.col(c) if c in docs.columns else F.lit(None)).cast(t).alias(c) for c, t in (("lang", "string"), ("source", "string"), ("n_chars", "long"))]


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", score_col: str = "score") -> DataFrame:
    """``docs`` with a further column: the probability (0 to 1) that a document is good.

    ``labels``: id and label (1 good, 0 bad; nulls are left out). A column of the new one's name is replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop(score_col)
    _shared.tuned(spark)
    model = spark.sparkContext.broadcast(model_of(docs, labels, id_col, text_col, label_col))
    names = docs.columns
    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes) + f", `{score_col}` double"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = lambda b, c: b.column(names.index(c)).to_pylist() if c in names else [None] * b.num_rows
        for batch in itertools.chain.from_iterable(_shared.text_slices(b, text_col) for b in batches):
            x = content_features(batch.column(names.index(text_col)))
            score = model.value.score(x, metadata_features(get(batch, "lang"), get(batch, "source"), get(batch, "n_chars")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*names, score_col])

    return docs.mapInArrow(work, schema)
