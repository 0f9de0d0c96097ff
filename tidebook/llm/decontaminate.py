"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and items are normalised (A-Z lower-cased, runs of characters other than ASCII
letters, digits and non-ASCII count as one space). An item of m bytes with an edit budget of
e edits that occurs in a text shares at least m - q + 1 - q * e of its q-grams with it,
all on diagonals (text place minus item place) within e of each other. Hits of the items'
q-gram index are therefore counted in diagonal bands that overlap by half, each twice as
wide as the budget; regions that reach the bound are retained and verified by aligning the
item with the region in a band of e edits to either side. Every occurrence within the
budget is found (of occurrences that overlap, the one with the lowest diagonals); all
occurrences of items shorter than ``Q`` bytes are looked up literally, as whole words.

Items are read in blocks of bounded size (``BLOCK_BYTES``), and each block's index is
broadcast; all texts are scanned whole for each block, so scans grow with the bytes of items.

Nulls: null texts and items contain nothing, null ids stay. Repeated rows each give their
matches. Empty tables give no rows.
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

Q = 12
#: Edits allowed, as a share of an item's bytes, and items' bytes whose index is broadcast at once.
BUDGET, BLOCK_BYTES = 0.05, 8_000_000
#: Contaminated rows up to this number are broadcast to leave them out (16 bytes each); beyond it, shuffled.
BROADCAST_ROWS = 2_000_000

_U = np.uint64
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def normalised(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised bytes, row offsets in them, and the place of each byte in ``raw``."""
    low = _shared.lowered(raw)
    word = _INSIDE[raw]
    low = np.where(word, low, np.uint8(32))
    keep = word.copy()
    keep[1:] |= word[:-1]  # one space after a word
    ends = at[1:][at[1:] < len(raw)]
    keep[ends] = word[ends]  # a row does not begin with the space of the row before
    place = np.flatnonzero(keep)
    return low[place], np.searchsorted(place, at), place


def grams(text: np.ndarray) -> np.ndarray:
    """Hash of the q-gram that begins at each byte."""
    if len(text) < Q:
        return np.zeros(0, np.uint64)
    text = np.ascontiguousarray(text)
    eights = np.ndarray((len(text) - 7,), dtype="<u8", buffer=text.data, strides=(1,))
    n = len(text) - Q + 1
    return _shared.mixed(eights[:n] * _U(0x9E3779B97F4A7C15) ^ eights[Q - 8 : Q - 8 + n])


@dataclass
class Index:
    """The q-grams of a block of items, sorted by hash, with a bitmap of their low bits before them."""

    ids: list[int | None]
    texts: list[bytes]
    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray
    bitmap: np.ndarray
    short: list[int]

    def budget(self, k: int) -> int:
        """Edits allowed for item k: its share, as long as the bound stays positive."""
        m = len(self.texts[k])
        return max(0, min(int(BUDGET * m), (m - Q) // Q))

    def bound(self, k: int) -> int:
        """Shared q-grams that an occurrence of item k has at least."""
        return len(self.texts[k]) - Q + 1 - Q * self.budget(k)


def index(items: list[tuple[int | None, str]]) -> Index:
    """The index of some items; blank ones are left out."""
    raw, at = _shared.text_bytes(pa.array([t for _, t in items], pa.large_string()))
    text, at, _ = normalised(raw, at)
    rows = [(i, text[a:b].tobytes().rstrip(b" ")) for (i, _), a, b in zip(items, at[:-1].tolist(), at[1:].tolist(), strict=True)]
    rows = [r for r in rows if r[1]]
    hashes = [grams(np.frombuffer(t, np.uint8)) for _, t in rows]
    item = np.repeat(np.arange(len(rows)), [len(h) for h in hashes])
    place = np.concatenate([np.arange(len(h)) for h in hashes]) if rows else np.zeros(0, np.int64)
    every = np.concatenate(hashes) if rows else np.zeros(0, np.uint64)
    order = np.argsort(every, kind="stable")
    bitmap = np.zeros(1 << 24, bool)
    bitmap[(every & _U(0xFFFFFF)).astype(np.int64)] = True
    return Index([i for i, _ in rows], [t for _, t in rows], every[order], item[order].astype(np.int32), place[order].astype(np.int32), bitmap, [k for k, h in enumerate(hashes) if not len(h)])


def edits(item: bytes, text: bytes, lowest: int, highest: int, budget: int) -> tuple[int, int, int]:
    """Fewest edits between the item and a part of the text, up to ``budget`` + 1, and that part's begin and end.

    Only cells on the diagonals (text place minus item place) from ``lowest`` to ``highest``
    are computed, a row of the band for each byte of the item; the part may begin and end
    at any of them.
    """
    a = np.frombuffer(item, np.uint8)
    lowest, highest = max(lowest, -len(a)), min(highest, len(text))
    if lowest > highest:
        return budget + 1, 0, 0
    exact = text.find(item, max(lowest, 0), highest + len(a))
    if exact >= 0:
        return 0, exact, exact + len(a)
    far = 1 << 30  # of cells that no path reaches
    # text bytes of the band's cells: row i covers places lowest + i to highest + i; 0 stands beyond the text
    width = highest - lowest + 1
    b = np.zeros(width + len(a), np.uint8)
    begin_at, end_at = max(lowest, 0), min(highest + len(a), len(text))
    b[begin_at - lowest : end_at - lowest] = np.frombuffer(text, np.uint8)[begin_at:end_at]
    step = np.arange(width)
    place = lowest + step  # text place before which each cell of the row stands
    cost, begin = np.where((place >= 0) & (place <= len(text)), 0, far), place.copy()
    for i in range(len(a)):
        inside = (place + i >= 0) & (place + i < len(text))
        across = np.where(inside, cost + (b[i : i + width] != a[i]), far)
        above = np.append(cost[1:] + 1, far)  # the item's byte is left out
        away, start = np.minimum(across, above), np.where(across <= above, begin, np.append(begin[1:], 0))
        away = np.where((place + i + 1 >= 0) & (place + i + 1 <= len(text)), away, far)
        # text bytes left out: a running minimum along the row
        low = np.minimum.accumulate(away - step)
        source = np.maximum.accumulate(np.where(away - step == low, step, 0))
        cost, begin = np.minimum(low + step, far), start[source]
        cost[(place + i + 1 < 0) | (place + i + 1 > len(text))] = far
        if cost.min() > budget:
            return budget + 1, 0, 0
    at = int(np.argmin(cost))
    if cost[at] > budget:
        return budget + 1, 0, 0
    return int(cost[at]), int(begin[at]), int(place[at]) + len(a)


def matches(index_: Index, column: pa.Array) -> list[tuple[int, int, int, int, int]]:
    """(row, item, begin, end, edits) of all items in the rows; begin and end in bytes of the row's text."""
    raw, raw_at = _shared.text_bytes(column)
    if not len(raw) or not index_.texts:
        return []
    text, at, place = normalised(raw, raw_at)
    out = []
    body = text.tobytes()
    for k in index_.short:
        item = index_.texts[k]
        x = body.find(item)
        while x >= 0:  # whole words of one row; occurrences may overlap
            r, y = int(np.searchsorted(at, x, side="right")) - 1, x + len(item)
            if y <= at[r + 1] and (x == at[r] or body[x - 1] == 32) and (y == at[r + 1] or body[y] == 32):
                out.append((r, k, int(place[x]) - int(raw_at[r]), int(place[y - 1]) + 1 - int(raw_at[r]), 0))
            x = body.find(item, x + 1)
    h = grams(text)
    hit = np.flatnonzero(index_.bitmap[(h & _U(0xFFFFFF)).astype(np.int64)])
    low, high = (np.searchsorted(index_.hashes, h[hit], side=s) for s in ("left", "right"))
    n = high - low
    hit, low, n = hit[n > 0], low[n > 0], n[n > 0]
    if not len(hit):
        return out
    entry = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    where = np.repeat(hit, n)
    row = np.searchsorted(at, where, side="right") - 1
    inside = where + Q <= at[row + 1]
    entry, where, row = entry[inside], where[inside], row[inside]
    item, diagonal = index_.item[entry].astype(np.int64), where - at[row] - index_.place[entry]
    # bands of width 2w that overlap by half: a diagonal lies in two of them
    width = np.array([max(1, index_.budget(k)) for k in range(len(index_.texts))], np.int64)
    bound = np.array([max(1, index_.bound(k)) for k in range(len(index_.texts))], np.int64)
    band = (diagonal + (1 << 40)) // width[item]
    found: dict[tuple[int, int], list[tuple[int, int]]] = {}
    # each hit counts in both, so the hits of neighbouring half bands are counted together
    key = np.concatenate([np.stack([row, item, band]), np.stack([row, item, band - 1])], axis=1)
    order = np.lexsort(key[::-1])
    key, w = key[:, order], np.concatenate([where, where])[order]
    head = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0)))
    # distinct places of the text in a band
    size = np.diff(np.append(head, key.shape[1]))
    for g in np.flatnonzero(size >= bound[key[1, head]]).tolist():
        r, k = int(key[0, head[g]]), int(key[1, head[g]])
        w0 = w[head[g] : head[g] + size[g]]
        if len(np.unique(w0)) >= bound[k]:
            first = int((key[2, head[g]]) * width[k] - (1 << 40))  # the band's lowest diagonal
            found.setdefault((r, k), []).append((first, first + 2 * int(width[k])))
    for (r, k), bands in found.items():
        done: list[tuple[int, int]] = []
        line, budget = body[at[r] : at[r + 1]], index_.budget(k)
        for lowest, highest in sorted(set(bands)):
            # an occurrence's diagonals lie within the budget of those of its hits
            cost, begin, end = edits(index_.texts[k], line, lowest - budget, highest - 1 + budget, budget)
            if cost <= budget and end > begin and not any(x < end and begin < y for x, y in done):
                done.append((begin, end))
                out.append((r, k, int(place[at[r] + begin]) - int(raw_at[r]), int(place[at[r] + end - 1]) + 1 - int(raw_at[r]), cost))
    return out


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Occurrences of items in documents: doc_id, item_id, start, stop (code points), edits, row_digest.

    Documents without an occurrence have no row. ``row_digest`` is a hash of the whole text.
    """
    spark = docs.sparkSession
    _shared.tuned(spark)
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("row_digest"))
    schema = "doc_id long, item_id long, start long, stop long, edits long, row_digest long"
    out = None

    def scan(block) -> DataFrame:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in itertools.chain.from_iterable(_shared.text_slices(b, "text") for b in batches):
                found = matches(block.value, batch.column(1))
                if not found:
                    continue
                rows, item, begin, end, cost = (list(x) for x in zip(*found, strict=True))
                raw, at = _shared.text_bytes(batch.column(1))
                chars = _shared.char_index(raw)
                place = lambda r, x: int(chars[at[r] + x] - chars[at[r]])
                ids = [block.value.ids[k] for k in item]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(ids, pa.int64()), pa.array([place(r, x) for r, x in zip(rows, begin, strict=True)]), pa.array([place(r, x) for r, x in zip(rows, end, strict=True)]), pa.array(cost, pa.int64()), batch.column(2).take(pa.array(rows))],
                    names=["doc_id", "item_id", "start", "stop", "edits", "row_digest"],
                )

        return plain.mapInArrow(work, schema)

    held, size = [], 0
    for r in items.select(F.col(item_id).cast("long"), item_text).filter(F.col(item_text).isNotNull()).toLocalIterator():
        held.append((r[0], r[1]))
        size += len(r[1].encode())
        if size >= BLOCK_BYTES:
            part = scan(spark.sparkContext.broadcast(index(held)))
            out = part if out is None else out.unionByName(part)
            held, size = [], 0
    if held or out is None:
        part = scan(spark.sparkContext.broadcast(index(held)))
        out = part if out is None else out.unionByName(part)
    return out


def without_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item occurs; all columns stay."""
    hit = contaminated(docs, items, id_col, text_col).select(F.col("doc_id").alias("_id"), "row_digest").distinct()
    hit = _shared.written(hit, "contaminated")
    hit = F.broadcast(hit) if hit.count() <= BROADCAST_ROWS else hit
    return docs.join(hit, docs[id_col].cast("long").eqNullSafe(hit["_id"]) & (F.xxhash64(docs[text_col]) == hit["row_digest"]), "left_anti")
