"""Document fingerprints as Merkle trees over paragraphs and sections.

A text is cut into leaves (content-defined runs of about 48 bytes that never cross a
line end), leaves form paragraphs (lines), and paragraphs form sections (runs that end
after a blank line or where a paragraph's digest says so, about eight paragraphs). Every
digest covers exactly its bytes, so the root tests equality, and comparing two trees
from the top finds the differing branches, which locate an edit. Cuts depend on nearby
bytes only: an edit changes the leaves it touches and the digests above them.

A fingerprint is a string: 32 hex digits of the root, ``:``, then per section
``digest(paragraph digest,leaf digests ...)`` packed as base64 numbers; see
``fingerprint``. Equal texts have equal fingerprints. Null texts count as empty; the
empty text has a root and no sections.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.llm import _shared

#: Leaves end where the hash of the last eight bytes has this many zero bits (1 in 32), 16 bytes at least.
LEAF_BITS, LEAF_MIN = 5, 16
#: A section ends after a paragraph whose digest is divisible by this, or after a blank line.
SECTION = 8
#: Rows in a range of ids, and the most ranges (their first ids travel to the driver).
RANGE_ROWS, MOST_RANGES = 64, 65536

_U = np.uint64


def _leaf_ends(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sorted end positions of leaves over the concatenated rows."""
    n = len(raw)
    cut = np.zeros(n + 1, bool)
    if n >= 8:
        eights = np.ndarray((n - 7,), dtype="<u8", buffer=np.ascontiguousarray(raw).data, strides=(1,))
        cut[8:] = (eights * _U(0x9E3779B97F4A7C15)) >> _U(64 - LEAF_BITS) == 0
    hard = np.zeros(n + 1, bool)
    hard[1:] = raw == 0x0A
    hard[at] = True
    soft, fixed = np.flatnonzero(cut & ~hard), np.flatnonzero(hard)
    # a soft cut counts only if it is far from the hard cut and the soft cut before it
    last_hard = fixed[np.searchsorted(fixed, soft, side="right") - 1] if len(soft) else soft
    soft = soft[soft - last_hard >= LEAF_MIN]
    if len(soft):
        gap = np.diff(soft, prepend=-LEAF_MIN)
        soft = soft[gap >= LEAF_MIN]
    return np.union1d(fixed, soft)


def _folded(h: np.ndarray, first: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Order-sensitive digests of runs ``first[i]:ends[i]`` of ``h``."""
    k = np.arange(len(h), dtype=np.uint64) - np.repeat(first, ends - first).astype(np.uint64)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(_shared.mixed(h ^ _shared.mixed(k + _U(0xD1B54A32D192ED03))), out=total[1:])
    return _shared.mixed(total[ends] - total[first] + (ends - first).astype(np.uint64))


def trees(raw: np.ndarray, at: np.ndarray) -> list[str]:
    """Fingerprints of the rows of ``raw`` (UTF-8, concatenated; ``at``: row offsets)."""
    rows = len(at) - 1
    ends = _leaf_ends(raw, at)
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    keep = ends > starts
    starts, ends = starts[keep], ends[keep]
    leaf = _shared.span_hashes(raw, starts, ends) if len(ends) else np.zeros(0, np.uint64)
    row = np.searchsorted(at, starts, side="right") - 1
    # paragraphs: leaves up to a line end or the row's end
    closes = np.zeros(len(ends), bool)
    if len(ends):
        closes = (raw[ends - 1] == 0x0A) | np.append(row[1:] != row[:-1], True)
    p_end = np.flatnonzero(closes) + 1
    p_first = np.concatenate([[0], p_end[:-1]]).astype(np.int64) if len(p_end) else p_end
    para = _folded(leaf, p_first, p_end) if len(p_end) else leaf
    p_row = row[p_first] if len(p_end) else row
    if len(p_end):
        blank = (ends[p_end - 1] - starts[p_first] <= 1) & (raw[ends[p_end - 1] - 1] == 0x0A)
        s_close = blank | (para % _U(SECTION) == 0) | np.append(p_row[1:] != p_row[:-1], True)
    else:
        s_close = np.zeros(0, bool)
    s_end = np.flatnonzero(s_close) + 1
    s_first = np.concatenate([[0], s_end[:-1]]).astype(np.int64) if len(s_end) else s_end
    section = _folded(para, s_first, s_end) if len(s_end) else para
    s_row = p_row[s_first] if len(s_end) else p_row
    out = []
    s_at = np.searchsorted(s_row, np.arange(rows + 1))
    # packed numbers: 24 bits a node, which is four base64 characters; the root keeps 128 bits
    small = [(x >> _U(40)).astype(">u4").view(np.uint8).reshape(-1, 4)[:, 1:] for x in (section, para, leaf)]
    for r in range(rows):
        a, b = s_at[r], s_at[r + 1]
        root = hashlib.blake2b(section[a:b].tobytes() + (at[r + 1] - at[r]).astype("<i8").tobytes(), digest_size=16)
        parts = []
        for s in range(a, b):
            inner = [base64.b64encode(small[1][p].tobytes()).decode() + base64.b64encode(small[2][p_first[p] : p_end[p]].tobytes()).decode() for p in range(s_first[s], s_end[s])]
            parts.append(base64.b64encode(small[0][s].tobytes()).decode() + "." + ",".join(inner))
        out.append(root.hexdigest() + ":" + ";".join(parts))
    return out


def fingerprint(texts: list[str | None]) -> list[str]:
    """Fingerprints of ``texts``."""
    return trees(*_shared.text_bytes(pa.array([t or "" for t in texts], pa.string())))


def _leaves(print_: str) -> Counter:
    """Leaf digests of a fingerprint with their numbers."""
    out: Counter = Counter()
    for section in print_[33:].split(";"):
        for para in section[5:].split(","):
            out.update(para[k : k + 4] for k in range(4, len(para), 4))
    return out


def likeness(a: str, b: str) -> float:
    """Share of equal leaves of two fingerprints, from 0 to 1 (Dice); 1 exactly for equal roots.

    Sections with equal digests match as a whole; only the others are compared leaf by leaf.
    """
    if a[:32] == b[:32]:
        return 1.0
    left, right = Counter(a[33:].split(";")), Counter(b[33:].split(";"))
    same = left & right
    total = both = 0
    for s, n in same.items():
        k = sum(max(0, len(p) // 4 - 1) for p in s[5:].split(","))
        both += n * k
        total += 2 * n * k
    x, y = (_leaves(" " * 33 + ";".join((side - same).elements())) for side in (left, right))
    both += (x & y).total()
    total += x.total() + y.total()
    return min(2 * both / total, 1 - 1e-9) if total else 0.0


def differing(a: str, b: str) -> list[tuple[int, int]]:
    """(section, paragraph) places of ``a`` that have no equal paragraph in ``b``: where an edit lies."""
    if a[:32] == b[:32]:
        return []
    other = Counter(b[33:].split(";"))
    known = Counter(p for s in b[33:].split(";") for p in s[5:].split(","))
    out = []
    for i, s in enumerate(a[33:].split(";")):
        if other[s]:
            continue
        out += [(i, k) for k, p in enumerate(s[5:].split(",")) if not known[p]]
    return out


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and next_text: the text of the next row by descending id, the first one's after the last.

    Ids are cut into ranges at quantiles (``RANGE_ROWS`` rows each), and each range also
    gets the row that follows its last one, so texts are dealt once and no task sees more
    than its ranges. Equal ids are ordered by a hash of the text; null ids come last. A
    single row is its own next.
    """
    from pyspark.ml.feature import Bucketizer

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ids = plain.select(F.col("doc_id").cast("double").alias("x")).filter("x is not null")
    ranges = max(1, min(MOST_RANGES, ids.count() // RANGE_ROWS))
    cuts = sorted(set(ids.approxQuantile("x", [k / ranges for k in range(1, ranges)], 0.25 / ranges))) if ranges > 1 else []
    x = plain.withColumn("tie", F.xxhash64("text"))
    known = F.lit(0)
    if cuts:
        x = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="x", outputCol="bucket", handleInvalid="keep").transform(x.withColumn("x", F.col("doc_id").cast("double")))
        known = F.col("bucket").cast("int")
    nulls = (F.shiftright("tie", 58) - 64).cast("int")
    x = x.select("doc_id", "text", "tie", F.when(F.col("doc_id").isNull(), nulls).otherwise(known).alias("range"))
    # the first row of each range follows the last row of the range above it
    tops = sorted(x.groupBy("range").agg(F.max("doc_id").alias("top")).collect(), reverse=True, key=lambda r: r["range"])  # one row a range
    if not tops:
        return plain.withColumn("next_text", F.lit(""))
    follows = [(tops[(k + 1) % len(tops)]["range"], tops[(k + 1) % len(tops)]["top"], r["range"]) for k, r in enumerate(tops)]
    ghosts = docs.sparkSession.createDataFrame(follows, "of int, top long, above int")
    ghost = x.join(F.broadcast(ghosts), (x.range == ghosts.of) & x.doc_id.eqNullSafe(ghosts.top))
    ghost = ghost.groupBy("above").agg(F.max(F.struct("tie", "doc_id", "text")).alias("row"))
    ghost = ghost.select("row.doc_id", "row.text", "row.tie", F.col("above").alias("range"), F.lit(1).alias("ghost"))
    order = Window.partitionBy("range").orderBy("ghost", F.desc_nulls_last("doc_id"), F.desc("tie"))
    every = x.withColumn("ghost", F.lit(0)).unionByName(ghost).withColumn("next_text", F.lead("text").over(order))
    return every.filter("ghost = 0").select("doc_id", "text", "next_text")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint each text and its edited text, whose last half is replaced by the beginning of the next text.

    Returns doc_id, n_chars, edited (the edited text), fingerprint, edited_fingerprint,
    near_edited, near_next, edits (number of paragraphs in which the two differ).
    """
    _shared.tuned(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(_shared.text_slices(b, "text", _shared.SLICE_BYTES // 2) for b in batches):
            texts, nexts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(texts, nexts, strict=True)]
            mine, changed = fingerprint(texts), fingerprint(edited)
            # the next text mostly is the next row's: only the others need a tree of their own
            other = [i for i, n in enumerate(nexts) if i + 1 == len(nexts) or texts[i + 1] != n]
            following = [*mine[1:], ""]
            for i, f in zip(other, fingerprint([nexts[i] for i in other]), strict=True):
                following[i] = f
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([len(t) for t in texts]), pa.array(edited), pa.array(mine), pa.array(changed),
                    pa.array([likeness(a, b) for a, b in zip(mine, changed, strict=True)]), pa.array([likeness(a, b) for a, b in zip(mine, following, strict=True)]),
                    pa.array([len(differing(a, b)) for a, b in zip(mine, changed, strict=True)]),
                ],
                names=["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edits"],
            )

    schema = "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, edits long"
    return with_next(docs, id_col, text_col).mapInArrow(work, schema)
