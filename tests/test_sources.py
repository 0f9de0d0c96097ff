"""Scans, adapters, sinks and scalar functions on literal rows."""

import json

import pytest
from pyspark.sql import functions as F

from tidebook.functions import scalars as S
from tidebook.operators import quality, sequence, stats, unify
from tidebook.sources import readers, sinks


def test_missing_columns_are_named(spark, tmp_path):
    spark.createDataFrame([(1, 2.0)], "origin_time long, price double").write.parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError, match="quantity"):
        readers.events(spark, str(tmp_path / "t"), "TRADE")


def test_vendor_spellings(spark):
    d = readers.vendor(spark.createDataFrame([(5, True, 1.0, 2.0)], "sequence_number long, side_is_bid boolean, price double, size double"), "BOOK_DELTA")
    assert d.select("update_id", "side", "new_quantity").first() == (5, "BID", 2.0)
    w = spark.createDataFrame([(1, 9.0, 1.0, 8.0, 2.0, 10.0, 3.0)], "sequence_number long, bid_0_price double, bid_0_size double, bid_1_price double, bid_1_size double, ask_price_0 double, ask_quantity_0 double")
    r = readers.vendor(w, "BOOK_SNAPSHOT").first()
    assert [tuple(x) for x in r["bids"]] == [(9.0, 1.0), (8.0, 2.0)] and [tuple(x) for x in r["asks"]] == [(10.0, 3.0)]
    assert readers.kind_of(w.columns) == "BOOK_SNAPSHOT"


def test_messages(spark, tmp_path):
    lines = [{"capture_ns": 1, "stream": "btcusdt@trade", "data": {"t": 7, "T": 9, "p": "1.5", "q": "2", "m": True, "b": 1, "a": 2}}, {"capture_ns": 2, "stream": "btcusdt@depth@100ms", "data": {"e": "x", "E": 3, "U": 10, "u": 12, "b": [["1.0", "2"]], "a": []}}]
    (tmp_path / "m.jsonl").write_text("\n".join([*map(json.dumps, lines), "{broken", ""]))
    m = readers.messages(spark, str(tmp_path / "m.jsonl"))
    assert m.count() == 2 and {r["stream_type"] for r in readers.type_counts(m).collect()} == {"trade", "depth@100ms"}
    t, d = readers.trade_messages(m).first(), readers.depth_messages(m).first()
    assert (t["symbol"], t["trade_id"], float(t["price"]), t["trade_time"]) == ("BTCUSDT", 7, 1.5, 9)
    assert (d["first_id"], d["final_id"], d["bids"]) == (10, 12, [["1.0", "2"]])
    assert readers.in_time(m, begin=2).count() == 1 and readers.in_time(m, begin=0).count() == 2


def test_scalars(spark):
    df = spark.createDataFrame([(-7, 0, "1.25", "x")], "a long, b long, good string, bad string")
    r = df.select(S.mid_price(F.col("a"), F.col("b")).cast("long"), S.to_decimal(F.col("good")).cast("double"), S.to_decimal(F.col("bad")).cast("double"), S.to_decimal(F.lit(None).cast("string")), S.hour_path(F.lit(1_704_067_200_000_000_000)), S.path_date(F.lit("/a/2024/03/05/x"))).first()
    assert tuple(r)[:5] == (-4, 1.25, 0.0, None, "2024/01/01/00") and str(r[5]) == "2024-03-05"
    assert df.select(S.to_scaled(F.lit(0.000000005)), S.to_pips(F.lit("1.005").cast("decimal(20,10)"), F.lit(100))).first() == (0, 101)


def test_gaps_and_order(spark):
    d = spark.createDataFrame([("A", i, 0) for i in (103, 101, 102, 110, 110)], "symbol string, update_id long, origin_time long")
    assert sorted((r["expected_id"], r["actual_id"], r["gap_size"]) for r in sequence.gap_rows(d).collect()) == [(104, 110, 6), (111, 110, -1)]
    assert sequence.gap_summary(d.limit(0)).count() == 0


def test_sync_point(spark):
    s = spark.createDataFrame([("A", 1000)], "symbol string, update_id long")
    u = lambda *r: spark.createDataFrame([("A", *x) for x in r], "symbol string, first_id long, final_id long")
    assert sequence.sync_points(s, u((999, 1001), (1002, 1005))).first()["first_update"] == 999
    assert sequence.sync_points(s, u((1005, 1010))).count() == 0
    assert sequence.sync_points(s, u((990, 995), (996, 1000), (1000, 1005))).first()["first_update"] == 1000


def test_hourly_sink_reads_back(spark, tmp_path):
    rows = [(1, "A", 1_704_067_200_000_000_000 + k * 1_800_000_000_000, "TRADE", k, "1.5", "2", "buy") for k in range(4)] + [(9, "A", 1_704_067_200_000_000_000, "TRADE", 9, "1.5", "0", "buy")]
    e = unify.normalised(spark.createDataFrame(rows, "event_id long, symbol string, origin_time long, event_type string, trade_id long, price string, quantity string, side string"))
    path, bad = str(tmp_path / "e"), str(tmp_path / "bad")
    sinks.write_events(e, path, bad)
    back = spark.read.parquet(path)
    assert back.count() == 4 and back.select("hour").distinct().count() == 2 and spark.read.parquet(bad).first()["reason"] == "trade_quantity"
    got = sinks.read_range(spark, path, rows[2][2], rows[3][2])
    assert got.count() == 2 and "PartitionFilters" in got._jdf.queryExecution().toString()


def test_statistics(spark):
    df = spark.createDataFrame([(float(x), x % 2) for x in range(1, 101)], "v double, g int")
    assert stats.basic(df, "v").first()["median"] == 50.5
    k = stats.ks_statistic(df, "v", "g = 0").first()
    assert (k["statistic"], k["n1"], k["n2"]) == (0.02, 50, 50) and k["p_value_asymptotic"] == 1.0
    assert stats.power_law_scan(df, "v", [1.0, 50.0]).count() == 2


def test_origin_times(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), (None,), ("0",), ("",), ("2030-01-01 00:00:00",), ("junk",)], "origin_time string")
    r = quality.origin_time_quality(df, "2024-01-01 12:00:00").first()
    assert (r["null_count"], r["zero_count"], r["future_count"], r["invalid_count"], r["bad_rows"], r["reliable"]) == (1, 2, 1, 3, 5, False)
