"""The order book after every event: from deltas by ranges of update ids, and as a fold of all events.

Deltas alone set levels, so the book at the beginning of a range of ids is the last quantity of
each level before it: a grouped maximum. Ranges are then folded independently, each from its
own first state, so one busy symbol spreads over as many tasks as it has ranges and no level
meets more deltas than those of its own range. The fold of all events also knows
snapshots and trades, whose effect depends on the book; it reads each symbol's events in
order as a stream of Arrow batches and holds the book, never the group.

Deltas with a null side, price or quantity change nothing and give a row. Deltas of one id
apply in the order of side and price. A null symbol is a symbol of its own. Empty tables
give empty results.
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.functions import session

#: Update ids in a range that is folded on its own.
SPAN = 65_536
#: Levels a side of a book that are looked at.
DEPTH = 20


def level_intervals(deltas: DataFrame) -> DataFrame:
    """symbol, side, price, quantity, begin, end: from which update id to before which a level lives (end null: still)."""
    w = Window.partitionBy("symbol", "side", "price").orderBy("update_id")
    return deltas.select("symbol", "side", "price", F.col("new_quantity").alias("quantity"), F.col("update_id").alias("begin"), F.lead("update_id").over(w).alias("end"))


def _folded(deltas: DataFrame, probes: DataFrame | None = None) -> DataFrame:
    """Rows of ranges for a fold: symbol, part, update_id (null: the range's first state), side, price, quantity, probe."""
    part = F.expr(f"update_id div {SPAN}")
    rows = deltas.select("symbol", part.alias("part"), "update_id", "side", "price", F.col("new_quantity").alias("quantity"), F.lit(False).alias("probe"))
    at = probes.select("symbol", part.alias("part"), "update_id", F.lit(None).cast("string").alias("side"), F.lit(None).cast("long").alias("price"), F.lit(None).cast("long").alias("quantity"), F.lit(True).alias("probe")) if probes is not None else rows.limit(0)
    needed = (at if probes is not None else rows).groupBy(F.struct("symbol").alias("key")).agg(F.max("part").alias("top"))
    last = rows.filter("side is not null and price is not null and quantity is not null").groupBy("symbol", "side", "price", "part").agg(F.max_by("quantity", "update_id").alias("quantity"))
    last = last.withColumn("next", F.lead("part").over(Window.partitionBy("symbol", "side", "price").orderBy("part"))).filter("quantity > 0").withColumn("key", F.struct("symbol"))
    first = last.join(F.broadcast(needed), "key").withColumn("end", F.least(F.coalesce("next", "top"), "top")).filter("part < end")  # one row a symbol
    first = first.select("symbol", F.expr("explode(sequence(part + 1, end))").alias("part"), F.lit(None).cast("long").alias("update_id"), "side", "price", "quantity", F.lit(False).alias("probe"))
    return first.unionByName(rows).unionByName(at)


class _Half:
    """One side of a book that knows its best price: a heap whose removed prices are passed over later."""

    def __init__(self, sign: int):
        self.sign, self.level, self.heap, self.volume = sign, {}, [], 0

    def set(self, price: int, quantity: int) -> None:
        old = self.level.pop(price, None)
        self.volume += max(quantity, 0) - (old or 0)
        if quantity > 0:
            self.level[price] = quantity
            if old is None:
                heapq.heappush(self.heap, self.sign * price)

    def best(self) -> int | None:
        while self.heap and self.sign * self.heap[0] not in self.level:
            heapq.heappop(self.heap)
        return self.sign * self.heap[0] if self.heap else None

    def top(self, depth: int) -> list[tuple[int, int]]:
        return [(p, self.level[p]) for p in heapq.nsmallest(depth, self.level, key=lambda p: self.sign * p)]


def _steps(rows: pd.DataFrame) -> Iterator[tuple[int, bool, _Half, _Half]]:
    """(update_id, probe, bids, asks) after each row of a range, its first state aside."""
    sides = {"BID": _Half(-1), "ASK": _Half(1)}
    start = rows["update_id"].isna()
    for side, price, quantity in zip(*(rows.loc[start, c].tolist() for c in ("side", "price", "quantity")), strict=True):
        sides[side].set(int(price), int(quantity))
    rest = _ordered(rows)
    whole = rest["price"].notna() & rest["quantity"].notna()
    for update_id, probe, side, price, quantity, ok in zip(rest["update_id"].tolist(), rest["probe"].tolist(), rest["side"].tolist(), rest["price"].tolist(), rest["quantity"].tolist(), whole.tolist(), strict=True):
        if ok and side in sides:
            sides[side].set(int(price), int(quantity))
        yield int(update_id), probe, sides["BID"], sides["ASK"]


#: Prices of a range up to which its sides are filled forward price by price, as arrays.
PRICES = 512


def _ordered(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.loc[rows["update_id"].notna()].sort_values(["update_id", "probe", "side", "price"], kind="stable")


def _filled(rows: pd.DataFrame, rest: pd.DataFrame, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Best price (0 where there is none), number and volume of a side's levels after each row; None if it has too many prices."""
    n = len(rest)
    first = rows.loc[rows["update_id"].isna() & (rows["side"] == side)]
    first = dict(zip(first["price"].astype(np.int64).tolist(), first["quantity"].astype(np.int64).tolist(), strict=True))
    at = np.flatnonzero(((rest["side"] == side) & rest["price"].notna() & rest["quantity"].notna()).to_numpy(bool))
    price, quantity = (rest[c].to_numpy()[at].astype(np.int64) for c in ("price", "quantity"))
    prices = sorted(set(first) | set(price.tolist()), reverse=side == "BID")
    if len(prices) > PRICES:
        return None
    order = np.argsort(price, kind="stable")
    at, price, quantity = at[order], price[order], np.maximum(quantity[order], 0)
    begin, end = np.searchsorted(price, prices), np.searchsorted(price, prices, side="right")
    best, depth, volume, none = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64), np.ones(n, bool)
    for p, a, b in zip(prices, begin.tolist(), end.tolist(), strict=True):
        held = np.repeat(np.append(first.get(p, 0), quantity[a:b]), np.diff(np.concatenate([[0], at[a:b], [n]])))
        live = held > 0
        depth += live
        volume += held
        new = live & none
        best[new] = p
        none &= ~live
    return best, depth, volume


TOP = "symbol string, update_id long, best_bid long, best_ask long, bid_depth long, ask_depth long, bid_volume long, ask_volume long"


def top_of_book(deltas: DataFrame) -> DataFrame:
    """After each delta: best bid and ask (null for an empty side) and the number and volume of levels of each side."""

    def fold(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rest = _ordered(rows)
        sides = [_filled(rows, rest, side) for side in ("BID", "ASK")]
        if any(s is None for s in sides):  # many prices: a heap for each side
            out = [(n, b.best(), a.best(), len(b.level), len(a.level), b.volume, a.volume) for n, _, b, a in _steps(rows)]
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in TOP.split(", ")][1:])
        else:
            (bid, bids, bid_volume), (ask, asks, ask_volume) = sides
            best = [pd.array(v, "Int64") for v in (bid, ask)]
            for column, n in zip(best, (bids, asks), strict=True):
                column[n == 0] = pd.NA
            columns = (rest["update_id"].to_numpy().astype(np.int64), *best, bids, asks, bid_volume, ask_volume)
            frame = pd.DataFrame(dict(zip([c.split()[0] for c in TOP.split(", ")][1:], columns, strict=True)))
        frame.insert(0, "symbol", key[0])
        return frame.astype({"best_bid": "Int64", "best_ask": "Int64"})

    session.importable(deltas.sparkSession)
    return _folded(deltas).groupBy("symbol", "part").applyInPandas(fold, TOP)


def final_book(deltas: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The best ``depth`` levels a side after the last delta, with their rank."""
    live = level_intervals(deltas).filter("end is null and quantity > 0")
    best = F.when(F.col("side") == "BID", -F.col("price")).otherwise(F.col("price"))
    ranked = live.withColumn("rank", F.row_number().over(Window.partitionBy("symbol", "side").orderBy(best)))
    return ranked.filter(F.col("rank") <= depth).select("symbol", "side", "rank", "price", "quantity")


@dataclass
class Side:
    """One side of a book: sorted prices and their quantities; lossy sides forget what falls out of the top."""

    descending: bool
    depth: int = DEPTH
    lossy: bool = False
    prices: list[int] = field(default_factory=list)  # ascending by sign * price
    quantity: dict[int, int] = field(default_factory=dict)

    def _key(self, price: int) -> int:
        return -price if self.descending else price

    def set(self, price: int, quantity: int) -> None:
        """Set a level; a quantity of zero or less removes it."""
        key = self._key(price)
        if quantity <= 0:
            if self.quantity.pop(price, None) is not None:
                del self.prices[bisect.bisect_left(self.prices, key)]
            return
        if price not in self.quantity:
            bisect.insort(self.prices, key)
        self.quantity[price] = quantity
        if self.lossy and len(self.prices) > self.depth:
            del self.quantity[self._key(self.prices.pop())]

    def load(self, levels: list[tuple[int, int]]) -> None:
        self.prices, self.quantity = [], {}
        for price, quantity in levels:
            self.set(price, quantity)

    def best(self) -> int | None:
        return self._key(self.prices[0]) if self.prices else None

    def top(self) -> dict[int, int]:
        return {p: self.quantity[p] for p in map(self._key, self.prices[: self.depth])}


def side_drift(book: dict[int, int], snap: dict[int, int]) -> tuple[float, float]:
    """Root mean square and largest relative deviation of a book side's quantities from a snapshot's.

    Prices that only one has deviate by 1; an empty snapshot side gives 0 for an empty book side, else 1.
    """
    if not snap:
        return (0.0, 0.0) if not book else (1.0, 1.0)
    terms, most = [], 0.0
    for p in snap.keys() | book.keys():
        s, r = snap.get(p, 0), book.get(p, 0)
        if s:
            terms.append(((s - r) / s) ** 2)
        elif r:
            terms.append(1.0)
        most = max(most, abs(r - s) / s if s and p in book else float(bool(s or r)))
    return ((sum(terms) / len(terms)) ** 0.5 if terms else 0.0), most


@dataclass
class Book:
    """The state of a replay: nothing counts before the first snapshot."""

    depth: int = DEPTH
    lossy: bool = False
    threshold: float = 0.05
    resync: bool = True
    #: Deltas before the first snapshot wait for it and are applied with it, if they are newer.
    queue: bool = False
    waiting: list[tuple] = field(default_factory=list)
    started: bool = False
    bids: Side = None
    asks: Side = None

    def __post_init__(self) -> None:
        self.bids, self.asks = Side(True, self.depth, self.lossy), Side(False, self.depth, self.lossy)

    def snapshot(self, bids: list[tuple[int, int]], asks: list[tuple[int, int]], update_id: int | None = None) -> tuple[float, float, bool] | None:
        """Load the first snapshot; later ones give (drift, largest deviation, whether the book was reloaded)."""
        if not self.started:
            self.started = True
            self.bids.load(bids)
            self.asks.load(asks)
            for n, *d in self.waiting:
                if update_id is None or n is None or n > update_id:
                    self.delta(*d)
            self.waiting = []
            return None
        both = [side_drift(s.top(), {p: q for p, q in lv if q > 0}) for s, lv in ((self.bids, bids), (self.asks, asks))]
        rms, most = ((both[0][0] ** 2 + both[1][0] ** 2) / 2) ** 0.5, max(both[0][1], both[1][1])
        again = self.resync and rms > self.threshold
        if again:
            self.bids.load(bids)
            self.asks.load(asks)
        return rms, most, again

    def trade(self, side: str | None, price: int | None, quantity: int | None) -> None:
        """A trade takes from the best level of the other side if it reaches it."""
        if not self.started or price is None or quantity is None or price <= 0:
            return
        other = self.asks if side == "BUY" else self.bids if side == "SELL" else None
        best = other.best() if other else None
        if best is not None and (best <= price if side == "BUY" else best >= price):
            other.set(best, other.quantity[best] - quantity)

    def delta(self, side: str | None, price: int | None, quantity: int | None, update_id: int | None = None) -> None:
        if not self.started and self.queue:
            self.waiting.append((update_id, side, price, quantity))
        if self.started and price is not None and quantity is not None:
            if side == "BID":
                self.bids.set(price, quantity)
            elif side == "ASK":
                self.asks.set(price, quantity)

    def apply(self, e) -> tuple[float, float, bool] | None:
        """One event with fields event_type, side, price, quantity, bids, asks."""
        missing = lambda x: None if x is None or x != x else int(x)
        if e.event_type == "BOOK_SNAPSHOT":
            pairs = lambda lv: [(int(x["price"]), int(x["quantity"])) for x in (lv if lv is not None else [])]
            return self.snapshot(pairs(e.bids), pairs(e.asks))
        getattr(self, "trade" if e.event_type == "TRADE" else "delta")(e.side, missing(e.price), missing(e.quantity))
        return None


REPLAYED = "symbol string, event_id long, event_type string, best_bid long, best_ask long, spread long, bid_depth long, ask_depth long, drift_rms double, drift_max double, resynced boolean"


def replayed_rows(book: Book, rows: pd.DataFrame) -> pd.DataFrame:
    """Apply rows in order; the book after each."""
    out = []
    for e in rows.itertuples(index=False):
        drift = book.apply(e) or (None, None, None)
        bid, ask = (book.bids.best(), book.asks.best()) if book.started else (None, None)
        out.append((e.symbol, e.event_id, e.event_type, bid, ask, ask - bid if bid is not None and ask is not None else None, len(book.bids.prices), len(book.asks.prices), *drift))
    frame = pd.DataFrame(out, columns=[c.split()[0] for c in REPLAYED.split(", ")])
    return frame.astype({c: "Int64" for c in ("best_bid", "best_ask", "spread")}).astype({"drift_rms": float, "drift_max": float, "resynced": "boolean"})


def replay(events: DataFrame, depth: int = DEPTH, threshold: float = 0.05, resync: bool = True, lossy: bool = False) -> DataFrame:
    """The book after each event of unified events (symbol, event_id, event_type, origin_time, update_id, side, price, quantity, bids, asks).

    Rows of one symbol are sorted in its task by (origin_time, update_id, event_id) and read as a stream.
    """

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        symbol, book = None, None
        for rows in batches:
            for name, part in rows.groupby("symbol", sort=False, dropna=False):
                name = None if pd.isna(name) else name  # a null symbol equals itself
                if name != symbol or book is None:
                    symbol, book = name, Book(depth, lossy, threshold, resync)
                yield replayed_rows(book, part)

    session.importable(events.sparkSession)
    cols = ["symbol", "event_id", "event_type", "side", "price", "quantity", "bids", "asks"]
    rank = F.expr("case event_type when 'TRADE' then 0 when 'BOOK_SNAPSHOT' then 1 else 2 end")
    ordered = events.repartition("symbol").sortWithinPartitions("symbol", F.asc_nulls_first("origin_time"), F.asc_nulls_first("update_id"), rank, "event_id")
    return ordered.select(*cols).mapInPandas(fold, REPLAYED)


def snapshot_drift(book: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Drift of book levels from snapshot levels (symbol, snap_id, side, price, quantity): one row a snapshot.

    A full outer join by price gives each pair of levels once.
    """
    on = ["symbol", "snap_id", "side", "price"]
    j = snapshot.select(*on, F.col("quantity").alias("s")).join(book.select(*on, F.col("quantity").alias("r")), on, "full")
    term = F.when(F.col("s") > 0, F.pow((F.col("s") - F.coalesce("r", F.lit(0))) / F.col("s"), 2)).when(F.col("r") > 0, 1.0)
    off = F.when(F.col("s").isNull() | F.col("r").isNull(), 1.0).otherwise(F.abs(F.col("r") - F.col("s")) / F.col("s"))
    side = j.groupBy("symbol", "snap_id", "side").agg(F.sqrt(F.avg(term)).alias("rms"), F.max(off).alias("dev"), F.count("s").alias("n_s"), F.count("r").alias("n_r"))
    rms = lambda s: F.coalesce(F.max(F.when(F.col("side") == s, F.when(F.col("n_s") == 0, 1.0).otherwise(F.col("rms")))), F.lit(0.0))
    diff = lambda s: F.coalesce(F.max(F.when(F.col("side") == s, F.abs(F.col("n_s") - F.col("n_r")))), F.lit(0))
    out = side.groupBy("symbol", "snap_id").agg(rms("BID").alias("bid_rms"), rms("ASK").alias("ask_rms"), F.max("dev").alias("max_deviation"), diff("BID").alias("bid_level_diff"), diff("ASK").alias("ask_level_diff"))
    return out.withColumn("rms", F.sqrt((F.pow("bid_rms", F.lit(2)) + F.pow("ask_rms", F.lit(2))) / 2))


def rank_drift(book: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Sums of absolute price and quantity differences of levels of the same rank, each side as deep as both are."""
    def ranked(df: DataFrame, p: str, q: str) -> DataFrame:
        best = F.when(F.col("side") == "BID", -F.col("price")).otherwise(F.col("price"))
        r = F.row_number().over(Window.partitionBy("symbol", "snap_id", "side").orderBy(best))
        return df.withColumn("rank", r).select("symbol", "snap_id", "side", "rank", F.col("price").alias(p), F.col("quantity").alias(q))

    j = ranked(book, "bp", "bq").join(ranked(snapshot, "sp", "sq"), ["symbol", "snap_id", "side", "rank"])
    return j.groupBy("symbol", "snap_id", "side").agg(F.sum(F.abs(F.col("bp") - F.col("sp"))).alias("price_l1"), F.sum(F.abs(F.col("bq") - F.col("sq"))).alias("quantity_l1"), F.count("*").alias("levels"))


LEVELS = "symbol string, snap_id long, side string, price long, quantity long"


def book_at(deltas: DataFrame, snapshots: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The best ``depth`` levels a side at each snapshot (symbol, snap_id = its update id), from deltas only."""

    def fold(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = [(key[0], n, side, p, q) for n, probe, b, a in _steps(rows) if probe for side, half in (("BID", b), ("ASK", a)) for p, q in half.top(depth)]
        return pd.DataFrame(out, columns=[c.split()[0] for c in LEVELS.split(", ")])

    session.importable(deltas.sparkSession)
    return _folded(deltas, snapshots).groupBy("symbol", "part").applyInPandas(fold, LEVELS)
