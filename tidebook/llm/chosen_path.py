"""Near-duplicate classes by chosen-path set similarity join.

Each document becomes a sketch of ``TOKENS`` minwise tokens and ``MARKS`` one-byte minwise marks of
its word shingles. Trees of nodes branch the documents by selected tokens: in a node, a token is
selected if a hash of node and token falls below 1 / (branch * number of tokens), so similar
documents choose the same paths. The roots of ``TREES`` independent trees choose from the
tokens, all nodes below them from the marks. Small nodes are compared exhaustively on marks;
every pair that may reach the threshold is then confirmed on its full shingle sets. Trees are
repeated for recall: a pair at the threshold has on average ``similarity / branch`` (1.25)
common children a level. All trees choose from the same tokens, so they are independent only
given how many of these the pair shares. Averaged over that number (binomial with the
threshold, 0.75), a pair is lost with a probability below 0.00000001 in nodes that are compared
whole, as nearly all are, and below 0.0003 and 0.0008 in nodes that branch 6 and 12 times.

Large groups stay linear. Exact copies meet first, by a digest of their words, and are
represented by one document. In each node documents are then linked to pivots (one pair a
document), and what the confirmed links connect counts as one class; only pairs of different
classes are searched for further. A node is shuffled once: up to ``Limits.local`` documents are branched
by the task that holds them, since sketches are small. A larger node that one class fills is
compared in blocks of that class, each with the few documents outside it; other larger nodes
branch through a shuffle, and what is still large at the last level is compared in blocks
of all its documents, so no pair is dropped. Full sets meet in the node if they are small
enough for a task's memory (``Limits.sets``), else pair by pair.

Null and blank texts have empty sets and no links. Rows with the same id count as one
document whose links are those of all its texts. Null ids have a null component and
are kept. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.llm import _shared

TOKENS = 64
#: One-byte minwise marks by which sketches are compared before the full sets are.
MARKS = 256
TREES = 16
#: A node's documents select 1 / BRANCH tokens on average.
BRANCH = 0.6


@dataclass(frozen=True)
class Limits:
    """Sizes at which the search takes another way; none of them drops a pair."""

    #: Nodes of at most so many documents are compared exhaustively, and larger ones with at most
    #: so many documents outside their largest class.
    leaf: int = 2048
    outside: int = 512
    #: Nodes of at most so many documents are branched by the task that holds their sketches (300 bytes each).
    local: int = 32_768
    #: Levels of branching; beyond them nodes are compared in blocks of all their documents.
    depth: int = 12
    #: Shingles of a node's candidates that a task holds (8 bytes each); beyond it their pairs are dealt out.
    sets: int = 4_000_000
    #: Members of a pivot that one task compares with it.
    members: int = 2048
    #: Rows of ids up to this number are broadcast to find their texts (some 40 bytes each); beyond it texts are shuffled.
    broadcast: int = 1_000_000


_U = np.uint64
_RNG = np.random.default_rng(20_240_601)
_MUL = _RNG.integers(1, 2**63, MARKS, dtype=np.uint64) * _U(2) + _U(1)
_ADD = _RNG.integers(0, 2**63, MARKS, dtype=np.uint64)
_PLACE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * _U(2) + _U(1)
_SEEDS = _RNG.integers(1, 2**63, 1024, dtype=np.uint64)
_COLUMN = _RNG.integers(1, 2**63, MARKS, dtype=np.uint64)


def shingle_sets(raw: np.ndarray, at: np.ndarray, width: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Per row the sorted distinct shingle hashes; word counts; 128-bit digests of the word sequence."""
    raw = _shared.lowered(raw)
    starts, ends, word_at = _shared.word_spans(raw, at)
    h = _shared.span_hashes(raw, starts, ends)
    n_words = np.diff(word_at)
    k = np.arange(len(h), dtype=np.uint64) - np.repeat(word_at[:-1], n_words).astype(np.uint64)
    sums = []
    for salt in (_U(0x2545F4914F6CDD1D), _U(0x9E6C63D0876A9A35)):
        total = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(_shared.mixed(h ^ (k + _U(1)) * salt), out=total[1:])
        sums.append(_shared.mixed(total[word_at[1:]] - total[word_at[:-1]] + n_words.astype(np.uint64)))
    grams = np.zeros(max(0, len(h) - width + 1), np.uint64)
    for j in range(width):
        grams += h[j : j + len(grams)] * _PLACE[j]
    grams = _shared.mixed(grams)
    sets = []
    for a, b in zip(word_at[:-1].tolist(), word_at[1:].tolist(), strict=True):
        if b - a >= width:
            sets.append(np.unique(grams[a : b - width + 1]))
        elif b > a:  # too short: the whole sequence is one shingle
            sets.append(_shared.mixed(np.array([(h[a:b] * _PLACE[32 : 32 + b - a]).sum() + _U(b - a)], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets, n_words, np.stack(sums)


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """doc_id, n_shingles, d1, d2 (digest), tokens and marks (binary; null for empty sets)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(_shared.text_slices(b, "text") for b in batches):
            sets, _, digest = shingle_sets(*_shared.text_bytes(batch.column(1)), width)
            n = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(n)
            tokens, marks = [None] * len(n), [None] * len(n)
            if len(full):
                every = np.concatenate([sets[i] for i in full])
                first = np.concatenate([[0], np.cumsum(n[full])[:-1]])
                low = np.empty((len(full), MARKS), np.uint32)
                for j in range(MARKS):
                    low[:, j] = np.minimum.reduceat((every * _MUL[j] + _ADD[j]) >> _U(32), first)
                byte = (_shared.mixed(low.astype(np.uint64)) >> _U(56)).astype(np.uint8)
                for row, i in enumerate(full):
                    tokens[i], marks[i] = low[row, :TOKENS].tobytes(), byte[row].tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(digest[0].view(np.int64)), pa.array(digest[1].view(np.int64)), pa.array(tokens, pa.binary()), pa.array(marks, pa.binary())], names=["doc_id", "n_shingles", "d1", "d2", "tokens", "marks"])

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(make, "doc_id long, n_shingles long, d1 long, d2 long, tokens binary, marks binary")


# ------------------------------------------------------------------------------ trees


def _matrix(column, kind: type = np.uint8) -> np.ndarray:
    """Rows of a binary column: marks, or tokens as uint32."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, MARKS if kind is np.uint8 else TOKENS)


def _chosen(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, child) of the tokens that fall below the selection bound; ``tokens`` are hashed with their node."""
    row, col = np.nonzero(tokens < _U(int(2**64 / (BRANCH * tokens.shape[1]))))
    return row, _shared.mixed(tokens[row, col] + _U(1))


def _below(marks: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, child node) under the nodes in which the documents with these marks stand."""
    rows, children = [], []
    for a in range(0, len(marks), 4096):
        row, child = _chosen(_shared.mixed((marks[a : a + 4096].astype(np.uint64) + _U(1)) * _COLUMN ^ node[a : a + 4096, None]))
        rows.append(row + a)
        children.append(child)
    return np.concatenate(rows), np.concatenate(children)


def _roots(reps: DataFrame, trees: int) -> DataFrame:
    """The first level of every tree: node, doc_id."""

    def branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = np.arange(1, TOKENS + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)
        for b in batches:
            for batch in (b.slice(i, 2000) for i in range(0, b.num_rows, 2000)):
                ids, tokens = batch.column(0).to_numpy(), _shared.mixed(_matrix(batch.column(1), np.uint32).astype(np.uint64) + places)
                for t in range(trees):
                    row, node = _chosen(_shared.mixed(tokens ^ _SEEDS[t]))
                    yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(ids[row])], names=["node", "doc_id"])

    return reps.select("doc_id", "tokens").mapInArrow(branch, "node long, doc_id long")


def _children(rows: DataFrame) -> DataFrame:
    """The next level under the nodes of ``rows`` (node, doc_id, marks): node, doc_id."""

    def branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                row, child = _below(_matrix(batch.column(2)), batch.column(0).to_numpy().view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(batch.column(1).to_numpy()[row])], names=["node", "doc_id"])

    return rows.select("node", "doc_id", "marks").mapInArrow(branch, "node long, doc_id long")


# -------------------------------------------------------------------- comparing a node


class _Marks:
    """Which documents may be alike, by their marks and the sizes of their sets."""

    def __init__(self, marks: np.ndarray, sizes: np.ndarray, percent: int):
        share = percent / 100 + (1 - percent / 100) / 256  # marks of a pair at the threshold that agree
        self.least = int(MARKS * share - 4.5 * np.sqrt(MARKS * share * (1 - share)))
        near = (self.least + 4.5 * np.sqrt(MARKS * 0.19)) / MARKS
        self.quarter = int(MARKS // 4 * near - 4.75 * np.sqrt(MARKS // 4 * near * (1 - near)))
        self.marks, self.few, self.sizes, self.percent = marks, np.ascontiguousarray(marks[:, : MARKS // 4]), sizes, percent

    def alike(self, i: int, j: np.ndarray) -> np.ndarray:
        """Those of the places ``j`` that may be alike to ``i``."""
        j = j[100 * np.minimum(self.sizes[j], self.sizes[i]) >= self.percent * np.maximum(self.sizes[j], self.sizes[i])]
        if len(j) > 64:  # a quarter of the marks rules most out; its bound loses one true pair in a million
            j = j[(self.few[j] == self.few[i]).sum(axis=1) >= self.quarter]
        return j[(self.marks[j] == self.marks[i]).sum(axis=1) >= self.least]

    def pairs(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the pairs (i, j) may be alike."""
        out = 100 * np.minimum(self.sizes[j], self.sizes[i]) >= self.percent * np.maximum(self.sizes[j], self.sizes[i])
        for a in range(0, len(i), 16_384):
            out[a : a + 16_384] &= (self.marks[i[a : a + 16_384]] == self.marks[j[a : a + 16_384]]).sum(axis=1) >= self.least
        return out


def _candidates(comps: np.ndarray, m: _Marks, rows: np.ndarray, node: int, limits: Limits, depth: int = 0) -> Iterator[tuple[int, np.ndarray]]:
    """(i, places j of other classes that may be alike) of a node's rows; the largest class is never compared inside itself.

    A node that is neither small nor nearly filled by one class branches on.
    """
    _, code, count = np.unique(comps[rows], return_inverse=True, return_counts=True)
    if len(count) < 2:
        return
    most = int(np.argmax(count))
    if len(rows) <= limits.leaf or len(rows) - count[most] <= limits.outside or depth >= limits.depth:
        for k in np.flatnonzero(code != most).tolist():
            other = (code != code[k]) & ((code == most) | (np.arange(len(rows)) > k))
            if len(j := m.alike(int(rows[k]), rows[other])):
                yield int(rows[k]), j
        return
    row, child = _below(m.marks[rows], np.full(len(rows), node, np.uint64))
    order = np.argsort(child, kind="stable")
    edges = np.concatenate([[0], np.flatnonzero(child[order][1:] != child[order][:-1]) + 1, [len(order)]])
    for a in np.flatnonzero(np.diff(edges) > 1).tolist():
        part = order[edges[a] : edges[a + 1]]
        yield from _candidates(comps, m, rows[row[part]], int(child[part[0]]), limits, depth + 1)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole nodes and where their nodes begin and end; rows are sorted by the first column, the node."""

    def cut(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
        node = table.column(0).to_numpy()
        return table.combine_chunks(), np.concatenate([[0], np.flatnonzero(node[1:] != node[:-1]) + 1, [len(node)]])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        last = batch.column(0)[batch.num_rows - 1].as_py()
        if held[0].column(0)[0].as_py() == last:
            continue
        table = pa.Table.from_batches(held)
        whole = int(np.flatnonzero(table.column(0).to_numpy() != last)[-1]) + 1
        yield cut(table.slice(0, whole))
        held = table.slice(whole).to_batches()
    if held:
        yield cut(pa.Table.from_batches(held))


def _starred(nodes: DataFrame, percent: int, local: int) -> DataFrame:
    """Pairs of documents and pivots that may be alike (a, b), and the rows of nodes that hold further pairs.

    ``nodes``: node, n, low, doc_id, n_shingles, marks. A pivot is the lowest document
    that is like no pivot before. Nodes of two, and nodes whose documents all became
    pivots, are done with; the rows of the others are returned with node, n, doc_id,
    n_shingles and marks, pairs with a null node.
    """

    def pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, edges in _whole(batches):
            n, ids, home = (t.column(c).to_numpy() for c in ("n", "doc_id", "home"))
            m = _Marks(_matrix(t.column("marks")), t.column("n_shingles").to_numpy(), percent)
            size = np.diff(edges)
            two = edges[:-1][size == 2]
            two = two[m.pairs(two, two + 1)]
            a, b, more = [two + 1], [two], n > local
            for begin, end in zip(edges[:-1][size > 2].tolist(), edges[1:][size > 2].tolist(), strict=True):
                rest, linked = np.arange(begin, end), False
                for _ in range(64 if end - begin <= 64 else 16):
                    if not len(rest):
                        break
                    like = m.alike(int(rest[0]), rest[1:])
                    if len(like):
                        a.append(like)
                        b.append(np.full(len(like), rest[0]))
                        linked = True
                    rest = np.setdiff1d(rest[1:], like, assume_unique=True)
                more[begin:end] |= linked or len(rest) > 0
            a, b = ids[np.concatenate(a)], ids[np.concatenate(b)]
            a, b = a[a != b], b[a != b]
            keep = np.flatnonzero(more & home)
            none = lambda k, kind: pa.nulls(k, kind)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), none(len(a), pa.int64()), none(len(a), pa.int64()), none(len(a), pa.int64()), none(len(a), pa.int64()), none(len(a), pa.binary())], names=names)
            kept = t.take(pa.array(keep))
            for part in kept.select(names[2:]).to_batches():
                yield pa.RecordBatch.from_arrays([none(part.num_rows, pa.int64()), none(part.num_rows, pa.int64()), *part.columns], names=names)

    names = ["a", "b", "node", "n", "doc_id", "n_shingles", "marks"]
    # a node too large for a task is dealt in blocks, each with the lowest document
    blocks = f"ceil(n / {local})"
    place = f"case when n <= {local} then 0 else pmod(xxhash64(doc_id), {blocks}) end"
    dealt = nodes.withColumn("block", F.explode(F.expr(f"case when n > {local} and doc_id = low then sequence(0L, {blocks} - 1) else array({place}) end")))
    dealt = dealt.select(F.expr(f"case when n <= {local} then node else xxhash64(node, block) end").alias("key"), *names[2:], F.expr(f"block = {place}").alias("home"))
    dealt = dealt.repartition("key").sortWithinPartitions("key", "doc_id")
    return dealt.mapInArrow(pivots, "a long, b long, node long, n long, doc_id long, n_shingles long, marks binary")


def _flagged(rows: DataFrame, percent: int, limits: Limits) -> DataFrame:
    """What must be compared on full sets in each node (node, doc_id, component, n_shingles, marks): rows, or pairs in ``other``."""

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, edges in _whole(batches):
            node, ids, comps, sizes = (t.column(k).to_numpy() for k in range(4))
            mixed = np.logical_or.reduceat(comps != np.repeat(comps[edges[:-1]], np.diff(edges)), edges[:-1])
            m = _Marks(_matrix(t.column(4)), sizes, percent)
            hit = np.zeros(len(ids), bool)
            for k in np.flatnonzero(mixed).tolist():
                begin, end = int(edges[k]), int(edges[k + 1])
                for i, j in _candidates(comps, m, np.arange(begin, end), int(node[begin]) & (1 << 64) - 1, limits):
                    hit[i] = True
                    hit[j] = True
                if sizes[begin:end][hit[begin:end]].sum() <= limits.sets:
                    continue
                hit[begin:end] = False
                for i, j in _candidates(comps, m, np.arange(begin, end), int(node[begin]) & (1 << 64) - 1, limits):
                    a, b = np.maximum(ids[j], ids[i]), np.minimum(ids[j], ids[i])
                    none = pa.nulls(len(j), pa.int64())
                    yield pa.RecordBatch.from_arrays([none, pa.array(a), none, none, pa.nulls(len(j), pa.binary()), pa.array(b)], names=names)
            for part in t.filter(pa.array(hit)).to_batches():
                yield pa.RecordBatch.from_arrays([*part.columns, pa.nulls(part.num_rows, pa.int64())], names=names)

    names = ["node", "doc_id", "component", "n_shingles", "marks", "other"]
    dealt = rows.select(*names[:5]).repartition("node").sortWithinPartitions("node", "doc_id")
    return dealt.mapInArrow(flag, "node long, doc_id long, component long, n_shingles long, marks binary, other long")


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if not len(x) or 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _within(flagged: DataFrame, docs: DataFrame, width: int, percent: int, limits: Limits) -> DataFrame:
    """Links (a, b) between different classes within nodes, confirmed on full sets; rows as of ``_flagged``.

    Links that connect what the node's links connect already are left out, so what
    leaves a node stays below its size.
    """

    def links(sets: dict, ids: list[int], comps: list[int], sizes: list[int], marks: list[bytes], node: int) -> Iterator[tuple[int, int]]:
        m = _Marks(np.frombuffer(b"".join(marks), np.uint8).reshape(-1, MARKS), np.array(sizes), percent)
        _, code = np.unique(np.array(comps), return_inverse=True)
        top = list(range(len(ids)))

        def root(k: int) -> int:
            while top[k] != k:
                top[k] = top[top[k]]
                k = top[k]
            return k

        for i, others in _candidates(np.array(comps), m, np.arange(len(ids)), node & (1 << 64) - 1, limits):
            for j in others.tolist():
                x, y = root(int(code[i])), root(int(code[j]))
                if x != y and any(_similar(s, t, percent) for s in sets.get(ids[i], ()) for t in sets.get(ids[j], ())):
                    top[max(x, y)] = min(x, y)
                    yield max(ids[i], ids[j]), min(ids[i], ids[j])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

        now, held = None, ({}, [], [], [], [])
        for batch in itertools.chain.from_iterable(_shared.text_slices(b, "text") for b in batches):
            node, ids, comps, sizes, marks = (batch.column(k).to_pylist() for k in range(5))
            sets = shingle_sets(*_shared.text_bytes(batch.column(5)), width)[0]
            for k in range(batch.num_rows):
                if node[k] != now:
                    if held[1]:
                        yield batch_of(list(links(*held, now)))
                    now, held = node[k], ({}, [], [], [], [])
                if marks[k] is None:
                    held[0].setdefault(ids[k], []).append(sets[k])
                else:
                    for column, v in zip(held[1:], (ids[k], comps[k], sizes[k], marks[k]), strict=True):
                        column.append(v)
        if held[1]:
            yield batch_of(list(links(*held, now)))

    rows = flagged.filter("other is null").select("node", "doc_id", "component", "n_shingles", "marks")
    texts = docs.join(_sized(rows.select("node", "doc_id").distinct(), limits.broadcast), "doc_id").select("node", "doc_id", F.lit(None).cast("long").alias("component"), F.lit(None).cast("long").alias("n_shingles"), F.lit(None).cast("binary").alias("marks"), "text")
    both = rows.withColumn("text", F.lit(None).cast("string")).unionByName(texts).repartition("node").sortWithinPartitions("node", "doc_id")
    return both.mapInArrow(link, "a long, b long")


def _small(df: DataFrame, rows: int) -> DataFrame:
    """A written table, broadcast if it has at most ``rows`` rows."""
    return F.broadcast(df) if df.count() <= rows else df


def _sized(df: DataFrame, rows: int) -> DataFrame:
    """``df``, written, and broadcast if it has at most ``rows`` rows."""
    return _small(_shared.written(df, "sized"), rows)


def confirmed(pairs: DataFrame, docs: DataFrame, width: int, percent: int, limits: Limits) -> DataFrame:
    """Pairs (a, b) whose full shingle sets reach the threshold: a, b. ``docs``: doc_id, text.

    Texts meet by b, its own first; a hot b is dealt in blocks, each with its text.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pivots = None, []
        for batch in itertools.chain.from_iterable(_shared.text_slices(b, "text") for b in batches):
            b, block, own, ids = (batch.column(k).to_pylist() for k in range(4))
            sets = shingle_sets(*_shared.text_bytes(batch.column(4)), width)[0]
            found = []
            for k in range(batch.num_rows):
                if (b[k], block[k]) != now:
                    now, pivots = (b[k], block[k]), []
                if own[k]:
                    pivots.append(sets[k])
                elif any(_similar(sets[k], x, percent) for x in pivots):
                    found.append((ids[k], b[k]))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

    counts = pairs.groupBy("b").agg(F.ceil(F.count("*") / limits.members).alias("blocks"))
    members = pairs.join(counts, "b").select(F.col("a").alias("doc_id"), "b", F.expr("pmod(xxhash64(a), blocks)").alias("block"), F.lit(False).alias("own"))
    pivots = counts.select(F.col("b").alias("doc_id"), "b", F.expr("explode(sequence(0L, blocks - 1))").alias("block"), F.lit(True).alias("own"))
    rows = docs.join(_sized(members.unionByName(pivots), limits.broadcast), "doc_id").select("b", "block", "own", "doc_id", "text")
    dealt = rows.repartition("b", "block").sortWithinPartitions("b", "block", F.desc("own"))
    return dealt.mapInArrow(check, "a long, b long")


# ----------------------------------------------------------------------------- classes


def _classes(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, trees: int, limits: Limits) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, n_shingles, d1, d2), classes of equal texts (d1, d2, rep, copies), components of their documents (id, component), repeated ids (doc_id, several: of different texts)."""
    _shared.tuned(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = _shared.written(sketches(docs, id_col, text_col, width), "sketches")
    linked = rows.filter("doc_id is not null and n_shingles > 0")
    reps = linked.groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "n_shingles", "tokens", "marks")).alias("r"), F.count("*").alias("copies"))
    reps = _shared.written(reps.select("d1", "d2", "copies", "r.*"), "reps")
    digest = lambda c: F.when(F.col("n_shingles") > 0, F.col(c))
    again = rows.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"), (F.min(digest("d1")) < F.max(digest("d1"))).alias("x"), (F.min(digest("d2")) < F.max(digest("d2"))).alias("y"))
    again = _shared.written(again.filter("n > 1").select("doc_id", F.expr("coalesce(x or y, false)").alias("several")), "again")
    several = again.filter("several").select("doc_id")

    links: list[DataFrame] = []
    if not several.isEmpty():  # a document of several texts links their classes
        own = linked.join(several, "doc_id", "left_semi").join(reps.select("d1", "d2", F.col("doc_id").alias("rep")), ["d1", "d2"])
        links.append(own.filter("doc_id <> rep").select(F.greatest("doc_id", "rep").alias("a"), F.least("doc_id", "rep").alias("b")))

    def every_link() -> DataFrame:
        out = links[0]
        for x in links[1:]:
            out = out.unionByName(x)
        return out

    def classed(nodes: DataFrame) -> DataFrame:
        """Rows of nodes with a class that the links so far connect: the lowest neighbour's lowest neighbour."""
        low = _sized(every_link().groupBy(F.col("a").alias("doc_id")).agg(F.min("b").alias("m")), limits.broadcast)
        out = nodes.join(low, "doc_id", "left").withColumn("m", F.coalesce("m", "doc_id"))
        return out.join(low.select(F.col("doc_id").alias("m"), F.col("m").alias("mm")), "m", "left").withColumn("component", F.coalesce("mm", "m")).drop("m", "mm")

    level = _roots(reps, trees)
    for depth in range(limits.depth + 1):
        of_node = level.groupBy("node").agg(F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high").drop("high")
        nodes = level.join(of_node, "node").join(reps.select("doc_id", "n_shingles", "marks"), "doc_id")
        starred = _shared.written(_starred(nodes, percent, limits.local), "starred")
        pairs = _shared.written(starred.filter("a is not null").select("a", "b").distinct(), "pairs")
        links.append(_shared.written(confirmed(pairs, plain, width, percent, limits), "stars"))
        _shared.released(pairs)
        open_ = starred.filter("node is not null").drop("a", "b")
        if open_.isEmpty():
            _shared.released(starred)
            break
        last = open_.filter(f"n > {limits.local}").isEmpty()
        if last:
            rest = classed(open_)
        else:
            named = _shared.written(classed(open_), "named")
            by_class = named.filter(f"n > {limits.local}").groupBy("node", "component").agg(F.count("*").alias("size"))
            top = by_class.groupBy("node").agg(F.max(F.struct("size", "component")).alias("top"), F.count("*").alias("classes")).filter("classes > 1")
            large = named.join(top.select("node", "top.size", F.col("top.component").alias("most")), "node")
            large = _shared.written(large, "large")
            # a class that fills a node is dealt in blocks, each with all documents outside it
            filled, blocks = large.filter(f"n - size <= {limits.outside}"), f"ceil(size / {limits.local - limits.outside})"
            dealt = filled.withColumn("block", F.explode(F.expr(f"case when component = most then array(pmod(xxhash64(doc_id), {blocks})) else sequence(0L, {blocks} - 1) end")))
            if depth == limits.depth:  # what is left is compared in blocks of all documents
                left = large.filter(f"n - size > {limits.outside}").withColumn("k", F.expr(f"ceil(2 * n / {limits.local})")).withColumn("mine", F.expr("pmod(xxhash64(doc_id), k)"))
                left = left.withColumn("with", F.explode(F.expr("sequence(0L, k - 1)"))).withColumn("block", F.expr("least(mine, with) * k + greatest(mine, with)"))
                dealt = dealt.unionByName(left.select(*dealt.columns))
            names = ["node", "doc_id", "component", "n_shingles", "marks"]
            rest = named.filter(f"n <= {limits.local}").select(*names).unionByName(dealt.withColumn("node", F.xxhash64("node", "block")).select(*names))
        flagged = _shared.written(_flagged(rest, percent, limits), "flagged")
        _shared.released(starred, *([] if last else [named]))
        links.append(_shared.written(_within(flagged, plain, width, percent, limits), "links"))
        by_pair = flagged.filter("other is not null").select(F.col("doc_id").alias("a"), F.col("other").alias("b"))
        if not by_pair.isEmpty():
            pairs = _shared.written(by_pair.distinct(), "pairs")
            links.append(_shared.written(confirmed(pairs, plain, width, percent, limits), "links"))
            _shared.released(pairs)
        _shared.released(flagged)
        if last or depth == limits.depth:
            break
        level = _children(large.filter(f"n - size > {limits.outside}"))
    found = _shared.written(_shared.components(every_link()), "components")
    return rows.drop("tokens", "marks"), reps.select("d1", "d2", F.col("doc_id").alias("rep"), "copies"), found, again


def _placed(rows: DataFrame, classes: DataFrame, found: DataFrame, limits: Limits) -> DataFrame:
    """``rows`` with rep and component_id, by the digest of their words."""
    # only classes of several copies or with links differ from their documents
    moved = classes.join(_small(found, limits.broadcast), classes.rep == found.id, "left").filter("copies > 1 or id is not null").select(F.col("d1").alias("k1"), F.col("d2").alias("k2"), "rep", F.coalesce("component", "rep").alias("component"))
    own = F.when(F.expr("doc_id is not null and n_shingles > 0"), F.col("d1"))
    moved = _sized(moved, limits.broadcast)
    out = rows.join(moved, (own == moved.k1) & (rows.d2 == moved.k2), "left")
    return out.select("doc_id", "n_shingles", "d1", "d2", F.coalesce("rep", "doc_id").alias("rep"), F.coalesce("component", "doc_id").alias("component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 75, trees: int = TREES, limits: Limits = Limits()) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept, for each row of ``docs``.

    Documents are linked if 100 * intersection >= ``percent`` * union of their sets of
    ``width``-word shingles (A-Z lower-cased, words split at white space).
    """
    rows, classes, found, _ = _classes(docs, id_col, text_col, width, percent, trees, limits)
    out = _placed(rows, classes, found, limits)
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """``docs`` with one document of each class of near-duplicates, the one with the smallest id; all columns stay.

    Rows without id stay. Of rows that repeat an id and its words (case and white space aside)
    the one with the smallest text stays. A group that holds an id of several different texts
    keeps one copy of each different text, the one with the smallest id, so no text is lost.
    """
    rows, classes, found, again = _classes(docs, id_col, text_col, 5, 75, TREES, limits)
    placed, key = _placed(rows, classes, found, limits), docs[id_col].cast("long")
    if again.isEmpty():
        gone = _sized(placed.filter("doc_id <> component_id").select(F.col("doc_id").alias("_gone")), limits.broadcast)
        return docs.join(gone, key == gone["_gone"], "left_anti")
    placed = _shared.written(placed, "placed")
    mixed = _sized(placed.join(again.filter("several"), "doc_id", "left_semi").select("component_id", F.lit(True).alias("mixed")).distinct(), limits.broadcast)
    placed = placed.join(mixed, "component_id", "left").withColumn("stays", F.expr("doc_id is null or doc_id = component_id or coalesce(mixed, false) and doc_id = rep"))
    # documents with an id of their own
    known = _small(again.select(F.col("doc_id").alias("_again")), limits.broadcast)
    gone = _sized(placed.join(known, F.col("doc_id") == known["_again"], "left_anti").filter("not stays").select(F.col("doc_id").alias("_gone")), limits.broadcast)
    out = docs.join(known, key == known["_again"], "left_anti").join(gone, key == gone["_gone"], "left_anti")
    # repeated ids: rows are told apart by the digest of their words
    named = [_shared.unused(n, docs.columns) for n in ("_d1", "_d2")]

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(_shared.text_slices(b, text_col) for b in batches):
            _, _, d = shingle_sets(*_shared.text_bytes(batch.column(batch.schema.get_field_index(text_col))), 5)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(d[0].view(np.int64)), pa.array(d[1].view(np.int64))], names=[*batch.schema.names, *named])

    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, T.LongType()) for n in named]])
    repeated = docs.join(known, key == known["_again"], "left_semi").mapInArrow(digests, schema)
    stay = placed.join(known, F.col("doc_id") == known["_again"], "left_semi").filter("stays").select(F.col("doc_id").alias("_id"), F.col("d1").alias("_x"), F.col("d2").alias("_y")).distinct()
    repeated = repeated.join(stay, (repeated[id_col].cast("long") == stay["_id"]) & (repeated[named[0]] == stay["_x"]) & (repeated[named[1]] == stay["_y"]), "left_semi")
    simple = [c for c, t in docs.dtypes if "map<" not in t]
    first = repeated.groupBy(id_col, *named).agg(F.min_by(F.struct(*docs.columns), F.struct(text_col, F.xxhash64(*simple))).alias("_row"))
    return out.unionByName(first.select("_row.*"))
