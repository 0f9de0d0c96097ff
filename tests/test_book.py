"""The order book: literal cases, the fold against the interval form, and the stream against the batch."""

import random

import pytest
from pyspark.sql import functions as F

from tidebook.operators import book as B
from tidebook.streaming import stateful

SCHEMA = "event_id long, symbol string, origin_time long, update_id long, event_type string, side string, price long, quantity long, bids array<struct<price:long,quantity:long>>, asks array<struct<price:long,quantity:long>>"


def started(bids, asks, **kw):
    b = B.Book(**kw)
    b.snapshot(bids, asks)
    return b


def test_snapshot_trade_and_deltas():
    b = started([(49999, 1), (49998, 2), (49997, 3)], [(50001, 2), (50002, 3)])
    assert (b.bids.best(), b.asks.best()) == (49999, 50001)
    b.trade("BUY", 50001, 1)
    assert b.asks.quantity[50001] == 1
    b.delta("ASK", 50001, 0)
    assert b.asks.best() == 50002
    b.trade("BUY", 50000, 1)  # doesn't reach the ask
    assert b.asks.quantity[50002] == 3


def test_nothing_counts_before_the_first_snapshot():
    b = B.Book()
    b.delta("BID", 1, 1)
    b.trade("BUY", 1, 1)
    assert b.bids.best() is None and b.asks.best() is None


def test_overflow_is_promoted_unless_lossy():
    side, lossy = B.Side(True, 2), B.Side(True, 2, lossy=True)
    for s in (side, lossy):
        for p in (100, 110, 105, 95):
            s.set(p, 1)
        assert list(s.top()) == [110, 105]
        s.set(110, 0)
    assert list(side.top()) == [105, 100] and list(lossy.top()) == [105]


@pytest.mark.parametrize(("book", "snap", "expected"), [({1: 10}, {1: 10}, (0, 0)), ({1: 10}, {1: 11}, (1 / 11, 1 / 11)), ({}, {1: 5}, (1, 1)), ({1: 5}, {}, (1, 1)), ({}, {}, (0, 0))])
def test_drift(book, snap, expected):
    assert B.side_drift(book, snap) == pytest.approx(expected)


def test_drift_reloads_above_the_threshold():
    b = started([(10, 100)], [(11, 100)])
    rms, most, again = b.snapshot([(10, 110)], [(11, 100)])
    assert (round(rms, 4), round(most, 4), again) == (0.0643, 0.0909, True) and b.bids.quantity[10] == 110


def events(n, seed):
    r, out = random.Random(seed), [(0, "A", 0, 0, "BOOK_SNAPSHOT", None, None, None, [], [])]
    for k in range(1, n):
        side = r.choice(["BID", "ASK"])
        price = r.randint(90, 99) if side == "BID" else r.randint(101, 110)
        out.append((k, r.choice("AB"), k, k, "BOOK_DELTA", side, price, r.choice([0, 1, 5, 9]), None, None))
    out.insert(1, (-1, "B", -1, -1, "BOOK_SNAPSHOT", None, None, None, [], []))
    return out


def test_fold_equals_intervals(spark):
    e = spark.createDataFrame(events(400, 1), SCHEMA)
    fold = B.replay(e).filter("event_type = 'BOOK_DELTA'").select("symbol", F.col("event_id").alias("update_id"), "best_bid", "best_ask", "bid_depth", "ask_depth")
    form = B.top_of_book(e.filter("event_type = 'BOOK_DELTA'").withColumnRenamed("quantity", "new_quantity")).select(fold.columns)
    assert sorted(map(tuple, fold.collect()), key=str) == sorted(map(tuple, form.collect()), key=str)


def test_empty_events(spark):
    assert B.replay(spark.createDataFrame([], SCHEMA)).count() == 0


def test_streams_equal_batches_over_a_restart(spark, tmp_path):
    rows = events(200, 2)
    e = spark.createDataFrame(rows, SCHEMA)
    inp, out, check = (str(tmp_path / d) for d in ("in", "out", "check"))
    e.filter("event_id < 100").coalesce(1).write.mode("append").parquet(inp)
    stateful.sink(stateful.replay(stateful.source(spark, inp, e.schema)), out, check).awaitTermination(120)
    e.filter("event_id >= 100").coalesce(1).write.mode("append").parquet(inp)
    stateful.sink(stateful.replay(stateful.source(spark, inp, e.schema)), out, check).awaitTermination(120)
    assert sorted(map(tuple, spark.read.parquet(out).collect()), key=str) == sorted(map(tuple, B.replay(e).collect()), key=str)


def test_stream_gaps(spark, tmp_path):
    d = spark.createDataFrame([("A", 100), ("A", 101), ("A", 105)], "symbol string, update_id long")
    d.filter("update_id < 105").coalesce(1).write.parquet(str(tmp_path / "in"))
    d.filter("update_id = 105").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stateful.sink(stateful.gaps(stateful.source(spark, str(tmp_path / "in"), d.schema)), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(120)
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("A", 102, 105, 3)]
