"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

The labels are of documents, so labelled tokens are made first: within toxic documents of
a bounded training sample, a token is toxic if its word, its beginning or its ending is
strongly associated with toxic documents. The field has two tags (other, toxic), hashed
features of the word and its neighbours, and transition weights; it is trained on windows
of labelled tokens by gradient ascent on the conditional likelihood. Forward-backward gives
each token's marginal over the whole text. A logistic calibration, fitted on labelled rows
that the field did not see, turns the marginals of a document into its score.

Inputs of a score are the text alone. Only the sample (``SAMPLE`` rows of at most
``SAMPLE_CHARS`` characters, smallest hashes first) reaches the driver; all texts are scored
whole on the executors. Null and blank texts have no tokens and get the calibration's base
score. Repeated rows each get a result; an empty table gives an empty one. Without labels of
both classes every score is the share of toxic labels (0 without labels).
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.llm import _shared

SAMPLE, SAMPLE_CHARS = 3_000, 8_000
THRESHOLD = 0.7
#: Hashed features, tokens in a training window, training steps, tokens in a block of the scan.
BITS, WINDOW, STEPS, BLOCK = 18, 12, 60, 64
#: A feature marks toxic tokens if it is in so many toxic documents, and so much likelier there.
LEAST_DOCS, LEAST_RATIO = 4, 25.0

_U = np.uint64
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100), 0x27]] = True


@dataclass
class Model:
    """Emission weights of hashed features, log transitions (from, to), log start, calibration."""

    weights: np.ndarray
    trans: np.ndarray
    start: np.ndarray
    calibration: np.ndarray
    prior: float | None = None


def tokens(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, first token of each row, and hashes (word, beginnings of 4, 5 and 6 bytes, last 4) of each token."""
    raw = _shared.lowered(raw)
    starts, ends, token_at = _shared.word_spans(raw, at, _WORD)
    lens = ends - starts
    columns = [_shared.span_hashes(raw, starts, ends)]
    for k in (4, 5, 6):
        columns.append(_shared.mixed(_shared.span_hashes(raw, starts, starts + np.minimum(lens, k)) + _U(k)))
    columns.append(_shared.mixed(_shared.span_hashes(raw, ends - np.minimum(lens, 4), ends) + _U(99)))
    return starts, ends, token_at, np.stack(columns) if len(starts) else np.zeros((5, 0), np.uint64)


def features(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Feature numbers of each token: its own hashes and its neighbours' words. ``first``: whether a row begins there."""
    n = hashes.shape[1]
    before, after = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    if n > 1:
        before[1:] = np.where(first[1:], _U(0), hashes[0, :-1])
        after[:-1] = np.where(first[1:], _U(0), hashes[0, 1:])
    rows = [*hashes, _shared.mixed(before + _U(0xA5A5)), _shared.mixed(after + _U(0x5A5A))]
    return np.stack([(row >> _U(64 - BITS)).astype(np.int32) for row in rows])


def _scan(score: np.ndarray, first: np.ndarray, trans: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward vectors (n, 2), each scaled to sum 1, of all rows at once.

    Rows stand one after the other; a row's first token has a matrix that forgets what
    came before. Blocks of the chain are multiplied side by side, then joined.
    """
    n = len(score)
    blocks = -(-n // BLOCK)
    e = np.ones(blocks * BLOCK)
    e[:n] = np.exp(np.clip(score, -30, 30))
    f = np.ones(blocks * BLOCK, bool)
    f[:n] = first
    e, f = e.reshape(blocks, BLOCK).T.copy(), f.reshape(blocks, BLOCK).T.copy()
    a, p = np.exp(trans), np.exp(start)
    m = [[np.where(f, p[j], a[i, j]) * (e if j else 1.0) for j in (0, 1)] for i in (0, 1)]

    prod = [[np.ones(blocks), np.zeros(blocks)], [np.zeros(blocks), np.ones(blocks)]]
    for t in range(BLOCK):
        prod = [[prod[i][0] * m[0][j][t] + prod[i][1] * m[1][j][t] for j in (0, 1)] for i in (0, 1)]
        scale = 1 / (prod[0][0] + prod[0][1] + prod[1][0] + prod[1][1])
        prod = [[x * scale for x in row] for row in prod]
    p00, p01, p10, p11 = (prod[i][j].tolist() for i in (0, 1) for j in (0, 1))
    left, right = [(0.5, 0.5)] * blocks, [(0.5, 0.5)] * blocks
    x, y = 0.5, 0.5
    for b in range(blocks - 1):
        x, y = x * p00[b] + y * p10[b], x * p01[b] + y * p11[b]
        x, y = x / (x + y), y / (x + y)
        left[b + 1] = (x, y)
    x, y = 0.5, 0.5
    for b in range(blocks - 1, 0, -1):
        x, y = p00[b] * x + p01[b] * y, p10[b] * x + p11[b] * y
        x, y = x / (x + y), y / (x + y)
        right[b - 1] = (x, y)

    fwd, bwd = np.empty((BLOCK, blocks, 2)), np.empty((BLOCK, blocks, 2))
    v0, v1 = np.array(left).T.copy()
    for t in range(BLOCK):
        v0, v1 = v0 * m[0][0][t] + v1 * m[1][0][t], v0 * m[0][1][t] + v1 * m[1][1][t]
        s = v0 + v1
        v0, v1 = v0 / s, v1 / s
        fwd[t, :, 0], fwd[t, :, 1] = v0, v1
    v0, v1 = np.array(right).T.copy()
    for t in range(BLOCK - 1, -1, -1):
        bwd[t, :, 0], bwd[t, :, 1] = v0, v1
        v0, v1 = m[0][0][t] * v0 + m[0][1][t] * v1, m[1][0][t] * v0 + m[1][1][t] * v1
        s = v0 + v1
        v0, v1 = v0 / s, v1 / s
    flat = lambda z: z.transpose(1, 0, 2).reshape(-1, 2)[:n]
    return flat(fwd), flat(bwd)


def marginals(feats: np.ndarray, first: np.ndarray, model: Model) -> np.ndarray:
    """Probability of the toxic tag for each token."""
    if not feats.shape[1]:
        return np.zeros(0)
    fwd, bwd = _scan(model.weights[feats].sum(axis=0), first, model.trans, model.start)
    both = fwd * bwd
    return both[:, 1] / both.sum(axis=1)


def trained(feats: np.ndarray, first: np.ndarray, tags: np.ndarray) -> Model:
    """Maximum conditional likelihood by AdaGrad steps over all windows at once, with an L2 penalty."""
    size = 1 << BITS
    w, trans, start = np.zeros(size), np.log(np.array([[0.9, 0.1], [0.5, 0.5]])), np.log(np.array([0.9, 0.1]))
    cache, cache_t, cache_s = np.full(size, 1e-2), np.full((2, 2), 1e-2), np.full(2, 1e-2)
    inner = ~first
    prev = np.append(0, tags[:-1])
    seen_t = np.array([[np.sum(inner & (prev == i) & (tags == j)) for j in (0, 1)] for i in (0, 1)], float)
    seen_s = np.array([np.sum(first & (tags == j)) for j in (0, 1)], float)
    used = np.unique(feats)
    for _ in range(STEPS):
        score = w[feats].sum(axis=0)
        fwd, bwd = _scan(score, first, trans, start)
        both = fwd * bwd
        z = both.sum(axis=1)
        p = both[:, 1] / z
        wrong = tags - p
        g = np.zeros(size)
        for row in feats:
            g += np.bincount(row, wrong, size)
        g = g / len(tags) * 100 - 1e-3 * w
        cache[used] += g[used] ** 2
        w[used] += 0.5 * g[used] / np.sqrt(cache[used])
        emit = np.stack([np.ones(len(score)), np.exp(np.clip(score, -30, 30))], axis=1)
        pair = fwd[:-1, :, None] * np.exp(trans)[None] * (emit * bwd)[1:, None, :]
        pair = pair[inner[1:]]
        want_t = (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        g_t, g_s = (seen_t - want_t) / len(tags) * 100, (seen_s - np.array([np.sum(first * (1 - p)), np.sum(first * p)])) / len(tags) * 100
        cache_t += g_t**2
        cache_s += g_s**2
        trans, start = trans + 0.2 * g_t / np.sqrt(cache_t), start + 0.2 * g_s / np.sqrt(cache_s)
    return Model(w.astype(np.float32), trans, start, np.zeros(4))


def summary(p: np.ndarray, token_at: np.ndarray) -> np.ndarray:
    """Per row what the calibration sees: 1, log odds of the strongest token, log of the expected number of toxic tokens and their share."""
    rows = len(token_at) - 1
    n = np.diff(token_at)
    most, total = np.zeros(rows), np.zeros(rows)
    full = np.flatnonzero(n)
    if len(full):
        most[full] = np.maximum.reduceat(p, token_at[full])
        total[full] = np.add.reduceat(p, token_at[full])
    most = np.clip(most, 1e-6, 1 - 1e-6)
    return np.stack([np.ones(rows), np.log(most / (1 - most)) / 10, np.log(total + 1e-3), np.log((total + 1e-3) / (n + 10))], axis=1)


def _calibrated(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method with a small penalty."""
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        beta = beta + np.linalg.solve(h, x.T @ (y - p) - 1e-2 * beta)
    return beta


def fit(texts: list[str], labels: list[int]) -> Model:
    """A model from labelled texts; every third one only serves the calibration."""
    y = np.array(labels, float)
    if len(y) == 0 or y.min() == y.max():
        return Model(np.zeros(1 << BITS, np.float32), np.zeros((2, 2)), np.zeros(2), np.zeros(4), float(y.mean()) if len(y) else 0.0)
    _, _, at, hashes = tokens(*_shared.text_bytes(pa.array(texts, pa.large_string())))
    n = np.diff(at)
    doc = np.repeat(np.arange(len(y)), n)
    first = np.zeros(hashes.shape[1], bool)
    first[at[:-1][n > 0]] = True
    learn = np.arange(len(y)) % 3 != 2
    # association of word, beginnings and ending with toxic documents, by document
    marked = np.zeros(hashes.shape[1], bool)
    on = learn[doc]
    nt, nc = y[learn].sum(), (1 - y[learn]).sum()
    for row in hashes:
        key, code = np.unique(row, return_inverse=True)
        code = code.astype(np.int32)
        once = np.unique(code[on].astype(np.int64) * len(y) + doc[on])
        k, d = once // len(y), once % len(y)
        toxic, clean = (np.bincount(k, w, len(key)) for w in (y[d], 1 - y[d]))
        ratio = (toxic + 0.1) / (nt + 1) / ((clean + 0.1) / (nc + 1))
        marked |= ((toxic >= LEAST_DOCS) & (ratio >= LEAST_RATIO))[code]
    tags = marked & (y[doc] == 1)
    feats = features(hashes, first)
    del hashes
    # windows around toxic tokens, and the beginnings of learned documents as plain text
    take = np.zeros(len(tags), bool)
    hits = np.flatnonzero(tags & on)
    for k in range(-WINDOW, WINDOW + 1):
        j = np.clip(hits + k, 0, len(tags) - 1)
        take[j[doc[j] == doc[hits]]] = True
    place = np.arange(len(tags)) - at[:-1][doc]
    take |= on & (y[doc] == 0) & (place % 97 < 2 * WINDOW)
    index = np.flatnonzero(take)
    heads = first[index].copy()
    heads[0] = True
    heads[1:] |= np.diff(index) > 1
    model = trained(feats[:, index], heads, tags[index].astype(float)) if len(hits) else Model(np.zeros(1 << BITS, np.float32), np.zeros((2, 2)), np.zeros(2), np.zeros(4))
    p = np.concatenate([marginals(feats[:, a:b], first[a:b], model) for a, b in itertools.pairwise(at[[*range(0, len(y), 200), len(y)]].tolist())])
    x = summary(p, at)
    held = ~learn if len(set(y[~learn])) == 2 else np.ones(len(y), bool)
    model.calibration = _calibrated(x[held], y[held])
    return model


def score_texts(column: pa.Array, model: Model) -> tuple[np.ndarray, list[list[dict]]]:
    """Scores and toxic spans (start, end in code points, probability) of whole texts."""
    raw, at = _shared.text_bytes(column)
    starts, ends, token_at, hashes = tokens(raw, at)
    n = np.diff(token_at)
    first = np.zeros(hashes.shape[1], bool)
    first[token_at[:-1][n > 0]] = True
    p = marginals(features(hashes, first), first, model)
    beta = model.calibration
    score = 1 / (1 + np.exp(-np.clip(summary(p, token_at) @ beta, -30, 30))) if model.prior is None else np.full(len(n), model.prior)
    hit = np.flatnonzero(p >= 0.5)
    row = np.searchsorted(token_at, hit, side="right") - 1
    chars = _shared.char_index(raw)
    spans: list[list[dict]] = [[] for _ in range(len(n))]
    for h, r in zip(hit.tolist(), row.tolist(), strict=True):
        spans[r].append({"start": int(chars[starts[h]] - chars[at[r]]), "end": int(chars[ends[h]] - chars[at[r]]), "probability": float(p[h])})
    return score, spans


def toxicity(docs: DataFrame, labels: DataFrame, train=None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """doc_id, score (0 to 1) and spans (array of start, end, probability) of each row.

    ``labels`` (id, label 0/1; null labels are left out) teaches; ``train`` is a column
    expression over it that says which rows may be learned from (all by default).
    """
    spark = docs.sparkSession
    _shared.tuned(spark)
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.filter(train) if train is not None else known
    picked = known.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(label_col).cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    sample = plain.filter(F.length("text") <= SAMPLE_CHARS).join(F.broadcast(picked), "doc_id").orderBy(F.xxhash64("doc_id"), "text").limit(SAMPLE).collect()  # SAMPLE rows at most
    model = spark.sparkContext.broadcast(fit([r["text"] for r in sample], [r["y"] for r in sample]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))
        for batch in itertools.chain.from_iterable(_shared.text_slices(b, "text") for b in batches):
            score, spans = score_texts(batch.column(1), model.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array(spans, kind)], names=["doc_id", "score", "spans"])

    return plain.mapInArrow(work, "doc_id long, score double, spans array<struct<start:long,end:long,probability:double>>")
