"""Streams, jobs, sinks and edge cases of the market engine, on literals."""

import json

import pytest
from pyspark.sql import functions as F

from tidebook.functions import scalars as S
from tidebook.operators import book as B
from tidebook.operators import jobs, quality, ranges, recovery, sequence, stats, unify, validators
from tidebook.sources import readers, sinks
from tidebook.streaming import stateful

EVENT = "event_id long, symbol string, origin_time long, update_id long, event_type string, side string, price long, quantity long, bids array<struct<price:long,quantity:long>>, asks array<struct<price:long,quantity:long>>"
LV = [(10, 1)]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_lagged_values_over_ranges_and_null_keys(spark):
    rows = [(k, n, n * 10) for k in ("a", None) for n in (1, 2, 9, 10, 11, 40)]
    got = ranges.lagged(spark.createDataFrame(rows, "k string, n long, v long"), {"was": "v"}, "n", "k", span=4)
    want = [(k, n, v, None if i == 0 else rows[i - 1][2]) for part in (rows[:6], rows[6:]) for i, (k, n, v) in enumerate(part) for rows in (part,)]
    assert rows_of(got) == sorted(want, key=str)


def test_running_sums_and_percentiles(spark):
    rows = [("a", v % 37) for v in range(500)] + [(None, 5), ("b", None)]
    df = spark.createDataFrame(rows, "k string, v long")
    got = {r["k"]: r for r in stats.basic(df, "v", ["k"]).collect()}
    a = sorted(v for k, v in rows if k == "a")
    at = lambda p: a[int(p * 499)] + (p * 499 - int(p * 499)) * (a[min(int(p * 499) + 1, 499)] - a[int(p * 499)])
    assert [got["a"][c] for c in ("q25", "median", "q75")] == pytest.approx([at(p) for p in (0.25, 0.5, 0.75)])
    assert got[None]["median"] == 5 and got["b"]["median"] is None and got["b"]["n"] == 0
    assert stats.drift_summary(spark.createDataFrame([(x / 100,) for x in range(200)], "rms double")).first()["p95"] == 1.89


def test_places_are_global(spark):
    rows = [(k, "ab"[k % 2], 10**12 * (k * 7 % 50), k, "TRADE") for k in range(50)] + [(99, None, None, 1, "TRADE")]
    df = spark.createDataFrame(rows, "event_id long, symbol string, origin_time long, update_id long, event_type string")
    got = {r["event_id"]: r["place"] for r in unify.placed(df, width=3 * 10**12).collect()}
    want = sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0, r[3], r[0]))
    assert [got[r[0]] for r in want] == list(range(1, 52))
    merged = unify.merged([df.filter("symbol = 'a'"), df.filter("symbol = 'b'")], files=4)
    times = [r["origin_time"] for r in merged.collect()]
    assert times == sorted(times)


def test_as_of_breaks_ties_and_passes_ranges(spark):
    left = spark.createDataFrame([("a", 5), ("a", 50), (None, 7), ("b", 1)], "k string, t long")
    right = spark.createDataFrame([("a", 5, 1, 9), ("a", 5, 2, 3), (None, 6, 1, 4), ("b", 2, 1, 1), ("a", 6, 1, None)], "k string, t long, n long, v long")
    got = sequence.as_of(left, right, "k", "t", "v", tie="n", span=10)
    assert rows_of(got) == rows_of(spark.createDataFrame([("a", 5, 3), ("a", 50, 3), (None, 7, 4), ("b", 1, None)], "k string, t long, v long"))


def test_hours_and_mids_at_borders(spark):
    nanos = [1704412799999999990, 1704412800000000000, 1704412799999999999, -1, 0, 1704416399999999999]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in nanos], "n long").select(S.hour_path(F.col("n"))).collect()]
    assert got == ["2024/01/04/23", "2024/01/05/00", "2024/01/04/23", "1969/12/31/23", "1970/01/01/00", "2024/01/05/00"]
    df = spark.createDataFrame([(2**60 + 1, 2**60), (-3, 0), (1, None)], "a long, b long")
    assert [r[0] for r in df.select(S.mid_price(F.col("a"), F.col("b"))).collect()] == [2**60, -2, None]
    d = spark.sql("select cast('0.00000000500000000' as decimal(38,18)) as x, cast('0.000000004999999999' as decimal(38,18)) as y, cast('1.000000015' as decimal(38,18)) as z")
    assert tuple(d.select(*[S.decimal_to_scaled(F.col(c)) for c in "xyz"]).first()) == (0, 0, 100000002)


def test_a_null_symbol_keeps_its_book(spark):
    rows = [(0, None, 0, 0, "BOOK_SNAPSHOT", None, None, None, LV, [(12, 1)])] + [(k, None, k, k, "BOOK_DELTA", "BID", 11, k, None, None) for k in range(1, 2500)]
    got = B.replay(spark.createDataFrame(rows, EVENT)).orderBy("event_id").collect()
    assert len(got) == 2500 and got[-1]["best_bid"] == 11 and got[-1]["best_ask"] == 12


@pytest.mark.parametrize("prices", [512, 0])
def test_ranges_fold_like_one_book(spark, monkeypatch, prices):
    """With arrays and with heaps."""
    monkeypatch.setattr(B, "SPAN", 16)
    if not prices:
        monkeypatch.setattr(B, "_filled", lambda *a: None)
    rows = [(s, n, side, price, q) for s in ("a", None) for n, (side, price, q) in enumerate([("BID", 5, 1), ("ASK", 9, 2), ("BID", 6, 4), ("BID", 6, 0), ("ASK", 9, 0), ("ASK", 8, 3), (None, 1, 1), ("BID", None, 1)] * 12)]
    deltas = spark.createDataFrame(rows, "symbol string, update_id long, side string, price long, new_quantity long")
    got = {(r["symbol"], r["update_id"]): tuple(r)[2:] for r in B.top_of_book(deltas).collect()}
    for s in ("a", None):
        bids, asks = {}, {}
        for _, n, side, price, q in (r for r in rows if r[0] == s):
            if side and price is not None:
                level = bids if side == "BID" else asks
                level.pop(price, None)
                if q > 0:
                    level[price] = q
            assert got[s, n] == (max(bids, default=None), min(asks, default=None), len(bids), len(asks), sum(bids.values()), sum(asks.values()))
    probes = spark.createDataFrame([("a", 90), ("a", 3)], "symbol string, update_id long")
    assert {r["snap_id"] for r in B.book_at(deltas, probes).collect()} == {90, 3}


def test_waiting_deltas_apply_at_the_snapshot():
    b = B.Book(queue=True)
    for n, price in ((5, 9), (7, 8)):
        b.delta("BID", price, 1, n)
    b.snapshot(LV, [(12, 1)], 6)
    assert b.bids.quantity == {10: 1, 8: 1} and b.waiting == []


def test_the_feed_carries_its_state(spark, tmp_path):
    schema = "symbol string, update_id long, reset boolean"
    parts = [[("A", 100, False), ("A", 101, False), (None, 1, False)], [("A", 105, False), ("A", 103, False), ("A", 105, False), (None, None, False)], [("A", 5000, False)], [("A", 7, True), ("A", 8, False)]]
    out = []
    for k, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        df = stateful.source(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, 10)
        stateful.sink(stateful.feed(df), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(120)
    out = {(r["symbol"], r["received"]): r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    a = [out["A", n] for n in range(1, 9)]
    assert [r["update_id"] for r in a] == [100, 101, 103, 105, 105, 5000, 7, 8]
    assert [r["gap"] for r in a] == [None, 0, 1, 1, -1, 4894, None, 0] and [r["needs_recovery"] for r in a] == [False] * 5 + [True, False, False]
    assert (a[-1]["gaps"], a[-1]["largest_gap"]) == (3, 4894) and out[None, 2]["late"] and [r["late"] for r in a] == [False] * 4 + [True] + [False] * 3


def test_stored_manifest_and_streamed_batches(spark, tmp_path):
    rows = [(k, "S", 1_700_000_000_000_000_000 + k * 10**12, k, "TRADE", 5, "BUY", 1) for k in range(20)]
    e = unify.normalised(spark.createDataFrame(rows, "event_id long, symbol string, origin_time long, trade_id long, event_type string, price long, side string, quantity long"))
    e.coalesce(1).write.parquet(str(tmp_path / "in"))
    source = stateful.source(spark, str(tmp_path / "in"), e.schema)
    stateful.manifest_sink(source, str(tmp_path / "events"), str(tmp_path / "manifest"), str(tmp_path / "check")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "events")).count() == 20
    table = sinks.compact_manifest(spark, str(tmp_path / "manifest"), str(tmp_path / "compact"))
    assert table.agg(F.sum("row_count")).first()[0] == 20
    inside = sinks.read_range(spark, str(tmp_path / "events"), rows[3][2], rows[7][2])
    assert inside.count() == 5


def test_jobs_write_their_outputs_and_go_on(spark, tmp_path):
    d = [(k, "A", k, k, "BOOK_DELTA", "BID", 5 + k % 3, k, None, None) for k in range(2, 30)]
    e = [(0, "A", 0, 0, "BOOK_SNAPSHOT", None, None, None, LV, [(12, 1)]), (30, "A", 30, 30, "BOOK_SNAPSHOT", None, None, None, LV, [(12, 1)])]
    events = spark.createDataFrame(d + e, EVENT)
    s = jobs.replay_job(events, str(tmp_path / "replay")).first()
    assert (s["events"], s["measured"]) == (30, 1) and spark.read.parquet(str(tmp_path / "replay/drift")).count() == 1
    deltas = events.filter("event_type = 'BOOK_DELTA'").withColumnRenamed("quantity", "new_quantity")
    first = jobs.enrich_job(deltas.filter("update_id < 10"), str(tmp_path / "enriched")).persist()
    assert first.first()["update_id"] == 9
    done = spark.createDataFrame(first.collect(), first.schema)
    jobs.enrich_job(deltas, str(tmp_path / "enriched"), done)
    ids = sorted(r["update_id"] for r in spark.read.parquet(str(tmp_path / "enriched")).collect())
    assert ids == list(range(2, 30))
    with pytest.raises(ValueError, match="depth"):
        jobs.replay_job(events, str(tmp_path / "x"), jobs.ReplayConfig(depth=0))
    assert all(not c.problems() for c in jobs.PRESETS.values())


def test_files_and_reports(spark, tmp_path):
    df = spark.createDataFrame([("A", 1, "BID")], "symbol string, update_id long, side string")
    df.coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    assert quality.schema_problems(df) == ["origin_time: missing"] and quality.schema_problems(df.limit(0), {"side": ("string",)}) == ["no rows"]
    assert quality.file_problems(spark, str(tmp_path / "t.parquet"), ["side", "price"]) == ["price: missing"]
    assert quality.file_problems(spark, str(tmp_path / "none"), [])[0].startswith("missing")
    assert len(readers.listed(spark, str(tmp_path))) == 1 and readers.peek(spark, str(tmp_path / "t.parquet"))[0][0] == ("symbol", "string")
    assert json.loads(sinks.session_metadata(spark, str(tmp_path / "t.parquet")))["file_count"] >= 1
    text, marked = sinks.report(df, "Title")
    assert json.loads(text)["rows"] == [{"symbol": "A", "update_id": 1, "side": "BID"}] and "| A | 1 | BID |" in marked
    with pytest.raises(ValueError, match="columns differ"):
        readers.stacked(df, df.drop("side"))
    assert readers.stacked(df, df).count() == 2 and readers.level_count(["bid_0_price", "bid_0_size", "bid_1_price"], "bid") == 1
    d, s = readers.synthetic_market(spark, 3000)
    assert d.count() == 3000 and all(len(r["bids"]) == 10 for r in s.collect())


def test_a_failing_validator_fails_alone(spark):
    df = spark.createDataFrame([("A", 1, 5), ("A", 2, 6)], "symbol string, event_id long, capture_ns long")

    class Broken(validators.Validator):
        name = "broken"

        def metrics(self, golden, other):
            return golden.agg(F.max(F.assert_true(F.lit(False)).isNull()).alias("passed"))

    got = {r["validator"]: r for r in validators.run(spark, [Broken(), validators.Chronology()], df, df).collect()}
    assert got["chronology"]["passed"] and not got["broken"]["passed"] and got["broken"]["error"]


def test_recovery_statuses(spark):
    c = spark.createDataFrame([("a", 10), ("b", 10), ("c", 10), ("d", 10), (None, 10)], "symbol string, checkpoint long")
    u = spark.createDataFrame([("a", 11), ("b", 2000), ("c", 9), ("c", 11), (None, 12)], "symbol string, update_id long")
    got = {r["symbol"]: (r["gap"], r["duplicates"], r["status"]) for r in recovery.continuity(c, u).collect()}
    assert got == {"a": (0, 0, "ok"), "b": (1989, 0, "failed"), "c": (0, 1, "duplicates"), "d": (None, 0, "no_updates"), None: (1, 0, "ok")}
