"""Registered queries of the market-data engine and their DuckDB equivalents."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.functions import scalars as S
from tidebook.operators import book, jobs, quality, recovery, sequence, stats, unify, validators
from tidebook.plans import market as M
from tidebook.sources import readers, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Callable], Callable]:
    """Register a function of the ticks (or, if it takes two arguments, of session and folder) with its SQL."""

    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f if f.__code__.co_argcount == 2 else lambda spark, sf_dir: f(M.ticks(spark, sf_dir))
        if sql:
            ORACLES[f.__name__] = M.SQL + sql if not sql.lstrip().startswith("--plain") else sql
        return f

    return add


def _unified(t: DataFrame) -> DataFrame:
    return unify.unioned(M.trades(t), M.snapshots(t), M.deltas(t))


# ------------------------------------------------------------------ unification


@query("select event_type, count(*) as n from unified group by 1")
def unify_counts(t):
    return _unified(t).groupBy("event_type").agg(F.count("*").alias("n"))


@query("select count(*) as events, min(origin_time) as first, max(origin_time) as last, round((max(origin_time) - min(origin_time)) / 1e9, 6) as seconds, round(count(*) / ((max(origin_time) - min(origin_time)) / 1e9), 9) as events_per_second from unified")
def unify_span(t):
    return unify.span(_unified(t))


@query("select symbol, event_id, event_type, row_number() over (partition by symbol order by origin_time, update_id nulls first, case event_type when 'TRADE' then 0 when 'BOOK_SNAPSHOT' then 1 else 2 end, event_id) as place from unified")
def unify_ordered(t):
    return unify.placed(_unified(t), "symbol").select("symbol", "event_id", "event_type", "place")


@query("select event_id, case when event_type = 'BOOK_SNAPSHOT' then 'BOOK_SNAPSHOT' when trade_id is not null then 'TRADE' else 'BOOK_DELTA' end as label from unified")
def label_events(t):
    u = _unified(t).drop("event_type")
    return u.select("event_id", S.event_label(u.columns).alias("label"))


@query("""select event_id, event_type, origin_time as event_timestamp, trade_id, case when event_type = 'TRADE' then price end as trade_price, case when event_type = 'TRADE' then quantity end as trade_quantity, case when event_type = 'TRADE' then side end as trade_side,
  case when event_type = 'BOOK_DELTA' then side end as delta_side, case when event_type = 'BOOK_DELTA' then price end as delta_price, new_quantity as delta_quantity, case when event_type = 'BOOK_SNAPSHOT' then true end as is_snapshot from unified""")
def normalize_fields(t):
    n = unify.normalised(_unified(t))
    long = lambda c: F.col(c).cast("long").alias(c)
    return n.select("event_id", "event_type", "event_timestamp", "trade_id", long("trade_price"), long("trade_quantity"), "trade_side", "delta_side", long("delta_price"), long("delta_quantity"), "is_snapshot")


@query("""select raw, case when upper(raw) in ('BUY','B','BID') then 'BUY' when upper(raw) in ('SELL','S','ASK','OFFER') then 'SELL' end as trade_side, case when upper(raw) in ('BID','B') then 'BID' when upper(raw) in ('ASK','A','OFFER') then 'ASK' end as book_side, count(*) as n
  from (select (['buy','B','bid','SELL','s','Ask','offer','a','x'])[1 + (event_id % 9)::int] as raw from t) group by all""")
def normalize_sides(t):
    raw = F.element_at(F.array(*map(F.lit, ("buy", "B", "bid", "SELL", "s", "Ask", "offer", "a", "x"))), (F.col("event_id") % 9 + 1).cast("int"))
    return t.select(raw.alias("raw")).select("raw", S.trade_side(F.col("raw")).alias("trade_side"), S.book_side(F.col("raw")).alias("book_side")).groupBy("raw", "trade_side", "book_side").agg(F.count("*").alias("n"))


@query("select event_id, case when x < 1000000000000 then x * 1000000 else x end as event_timestamp from (select event_id, case event_id % 3 when 0 then origin_time when 1 then origin_time // 10000000000 else null end as x from t)")
def normalize_timestamps(t):
    x = t.select("event_id", F.expr("case event_id % 3 when 0 then origin_time when 1 then origin_time div 10000000000 end").alias("origin_time"))
    return x.select("event_id", S.event_nanos(x.columns).alias("event_timestamp"))


@query("select snap_id, side, price, quantity from levels")
def normalize_levels(t):
    raw = M.snapshots(t).select("update_id", "symbol", *[F.transform(c, lambda x: F.array(x["price"], x["quantity"])).alias(c) for c in ("bids", "asks")])
    s = raw.select("symbol", "update_id", S.levels(F.col("bids")).alias("bids"), S.levels(F.col("asks")).alias("asks"))
    return M.levels(s).select("snap_id", "side", "price", "quantity")


@query("""select snap_id, side, price, quantity from (select snap_id, side, price, case when price = 9999 then null when price = 9995 then 7 else quantity end as quantity from levels union all select distinct snap_id, side, 9000, 5 from levels union all select distinct snap_id, 'ASK', 9995, 7 from levels) where quantity is not null""")
def apply_level_updates(t):
    up = F.expr("array(named_struct('price', 9999L, 'quantity', 0L), named_struct('price', 9995L, 'quantity', 3L), named_struct('price', 9000L, 'quantity', 5L), named_struct('price', 9995L, 'quantity', 7L))")
    s = M.snapshots(t).select("symbol", "update_id", *[S.updated_levels(F.col(c), up).alias(c) for c in ("bids", "asks")])
    return M.levels(s).select("snap_id", "side", "price", "quantity")


@query("select coalesce(reason, 'valid') as reason, count(*) as n from (select case when event_type = 'TRADE' and not quantity > 0 then 'trade_quantity' when event_type = 'BOOK_DELTA' and new_quantity < 0 then 'delta_quantity' when event_type = 'TRADE' and event_id % 7 = 0 then 'trade_side' end as reason from unified) group by 1")
def event_validation(t):
    u = _unified(t).withColumn("side", F.when((F.col("event_type") == "TRADE") & (F.col("event_id") % 7 == 0), "?").otherwise(F.col("side")))
    return unify.problems(unify.normalised(u)).groupBy(F.coalesce("reason", F.lit("valid")).alias("reason")).agg(F.count("*").alias("n"))


# --------------------------------------------------------------------- sequence


@query("select symbol, expected_id, update_id as actual_id, gap as gap_size, origin_time from gapped where gap <> 0")
def gap_rows(t):
    return sequence.gap_rows(M.deltas(t))


@query("""select symbol, count(*) as updates, count(*) filter (gap > 0) as gaps, coalesce(sum(gap) filter (gap > 0), 0)::bigint as missing, coalesce(max(gap) filter (gap > 0), 0) as largest, min(update_id) as first_id, max(update_id) as last_id,
  case when max(update_id) > min(update_id) then round(coalesce(sum(gap) filter (gap > 0), 0) * 100.0 / (max(update_id) - min(update_id)), 6) else 0 end::double as missing_percent, round(count(*) filter (gap > 0) / count(*), 6) as gap_ratio from gapped group by 1""")
def gap_summary(t):
    return sequence.gap_summary(M.deltas(t)).withColumn("missing_percent", F.col("missing_percent").cast("double"))


@query("select case when gap <= 10 then '1-10' when gap <= 100 then '11-100' when gap <= 1000 then '101-1000' else '1000+' end as bucket, count(*) as n from gapped where gap > 0 group by 1")
def gap_buckets(t):
    return sequence.gap_histogram(M.deltas(t), bucket=True)


@query("select gap as gap_size, count(*) as n from gapped where gap > 0 group by 1")
def gap_histogram(t):
    return sequence.gap_histogram(M.deltas(t))


@query("select symbol, update_id, coalesce(gap <> 0, false) as after_gap, coalesce(gap > 1000, false) as needs_recovery from gapped")
def after_gap_flag(t):
    return sequence.with_gaps(M.deltas(t)).select("symbol", "update_id", "after_gap", "needs_recovery")


_RANGE = "(select *, lag(u1) over (partition by symbol order by seq) + 1 as expected from ranges)"


@query(f"select symbol, case when u0 > expected then 'gap' else 'out_of_order' end as kind, count(*) as n, sum(abs(u0 - expected))::bigint as size, max(abs(u0 - expected)) as largest from {_RANGE} where u0 <> expected group by all")
def gap_vs_out_of_order(t):
    r = M.ranges(t).select("symbol", "seq", "U", F.col("u_last"))
    return _range_gaps(r).groupBy("symbol", "kind").agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.max("size").alias("largest"))


def _range_gaps(r: DataFrame) -> DataFrame:
    return sequence.range_gaps(r, last="u_last", first="U")


@query(f"select symbol, seq, u0 as first_id, expected, abs(u0 - expected) as size from {_RANGE} where u0 <> expected")
def gap_range_ids(t):
    return _range_gaps(M.ranges(t)).select("symbol", "seq", F.col("U").alias("first_id"), "expected", "size")


@query("""select symbol, count(*) as rows, count(*) filter (back > 0) as out_of_order, coalesce(greatest(max(back), 0), 0) as largest_step_back, count(*) filter (back > 0) = 0 as is_sorted
  from (select upper(split_part(stream, '@', 1)) as symbol, lag(capture_ns) over (partition by upper(split_part(stream, '@', 1)) order by event_id) - capture_ns as back from captured) group by 1""")
def chronology_check(t):
    m = M.messages(t).withColumn("symbol", S.stream_symbol(F.col("stream")))
    return sequence.chronology(m, "capture_ns", "event_id", "symbol")


@query("select file, first_time, last_time, coalesce(first_time < lag(last_time) over (order by file), false) as overlaps from (select event_id // 100 as file, arg_min(capture_ns, event_id) as first_time, arg_max(capture_ns, event_id) as last_time from captured group by 1)")
def cross_file_chronology(t):
    return sequence.across_files(M.messages(t).withColumn("file", F.expr("event_id div 100")), "file", "capture_ns", "event_id")


@query("select symbol, count(*) filter (d > 1) as over_1, count(*) filter (d > 1000) as over_1000 from (select symbol, update_id - lag(update_id) over (partition by symbol order by event_id) as d from t) group by 1")
def id_jumps(t):
    return sequence.jumps(t, "update_id", "event_id", "symbol")


@query("select symbol, last_id, min(u0) as first_update, arg_min(u1, u0) as final_update from (select s.symbol, s.update_id * 3 as last_id, r.u0, r.u1 from snaps s join (select symbol, event_id * 3 as u0, event_id * 3 + 2 as u1 from t) r on r.symbol = s.symbol and r.u0 <= s.update_id * 3 + 1 and s.update_id * 3 + 1 <= r.u1) group by 1, 2")
def sync_point(t):
    s = M.snapshots(t).select("symbol", (F.col("update_id") * 3).alias("update_id"))
    return sequence.sync_points(s, t.select("symbol", (F.col("event_id") * 3).alias("first_id"), (F.col("event_id") * 3 + 2).alias("final_id")))


# ---------------------------------------------------------------------- quality


@query("""select count(*) as total, count(*) filter (origin_time is null) as null_count, count(*) filter (origin_time in ('0', '')) as zero_count, count(*) filter (try_cast(origin_time as timestamp) > timestamp '2025-01-01') as future_count, count(*) filter (origin_time like '-%') as negative_count,
  count(*) filter (origin_time is not null and (event_id % 20) in (1, 2, 3, 5)) as invalid_count, count(*) filter (event_id % 20 < 6) as bad_rows,
  count(*) filter (origin_time is null) + count(*) filter (origin_time in ('0', '')) + count(*) filter (event_id % 20 = 4) + count(*) filter (event_id % 20 = 5) + count(*) filter (event_id % 20 in (1, 2, 3, 5)) as overlapping_count,
  round((count(*) - count(*) filter (event_id % 20 < 6)) * 100.0 / count(*), 6)::double as valid_percent, (count(*) - count(*) filter (event_id % 20 < 6)) * 100.0 / count(*) >= 95 as reliable from texts""")
def origin_time_quality(t):
    return quality.origin_time_quality(M.texts(t), "2025-01-01 00:00:00").withColumn("valid_percent", F.col("valid_percent").cast("double"))


@query("""select symbol, a, b, case when a >= 95 and b >= 95 then 'origin_time' when a >= 95 then 'trades_origin_time' when b >= 95 then 'books_origin_time' when a < 50 and b < 50 then 'arrival_order' else 'mixed' end as strategy
  from (select symbol, round(100.0 * count(*) filter (event_id % 30 <> 0) / count(*), 4)::double as a, round(100.0 * count(*) filter (event_id % 9 <> 0) / count(*), 4)::double as b from t group by 1)""")
def origin_time_recommendation(t):
    share = lambda c: F.round(F.count_if(F.expr(c)) * 100.0 / F.count("*"), 4).cast("double")
    g = t.groupBy("symbol").agg(share("event_id % 30 <> 0").alias("a"), share("event_id % 9 <> 0").alias("b"))
    return g.withColumn("strategy", quality.recommendation(F.col("a"), F.col("b")))


@query("select count(*) as rows, count(*) filter (not coalesce(update_id > 0, false)) as bad_update_id, count(*) filter (not price > 0) as bad_price, count(*) filter (not new_quantity >= 0) as bad_quantity, count(*) filter (new_quantity = 0) as removals, round((count(*) filter (not update_id > 0) + count(*) filter (not price > 0) + count(*) filter (not new_quantity >= 0)) * 100.0 / count(*), 6)::double as bad_percent from deltas")
def delta_quality(t):
    return quality.delta_quality(M.deltas(t)).withColumn("bad_percent", F.col("bad_percent").cast("double"))


@query("select 'null' as \"check\", 'price' as column_name, count(*) filter (price is null) as failed from trades union all select 'null', 'quantity', count(*) filter (quantity is null) from trades union all select 'not_positive', 'quantity', count(*) filter (quantity <= 0) from trades")
def integrity_checks(t):
    return quality.integrity(M.trades(t), ["price", "quantity"], ["quantity"])


_DAYS = "(select distinct ts::date as d from t where extract(day from ts) % 9 <> 0)"


@query(f"select min(d) as first_day, max(d) as last_day, count(*) as present, (max(d) - min(d) + 1)::bigint as expected, (max(d) - min(d) + 1 - count(*))::bigint as missing, round(count(*) * 100.0 / (max(d) - min(d) + 1), 6)::double as present_percent, count(*) * 100.0 / (max(d) - min(d) + 1) >= 95 as continuous from {_DAYS}")
def date_continuity(t):
    return quality.date_continuity(t.filter("day(ts) % 9 <> 0"), "ts").withColumn("present_percent", F.col("present_percent").cast("double"))


@query(f"select d::date as d from (select unnest(generate_series(min(d), max(d), interval 1 day))::date as d from {_DAYS}) where d not in (select d from {_DAYS})")
def missing_days(t):
    return quality.missing_days(t.filter("day(ts) % 9 <> 0"), "ts")


# ------------------------------------------------------------------------- book


@query("""select d.symbol, d.update_id, max(l.price) filter (l.side = 'BID') as best_bid, min(l.price) filter (l.side = 'ASK') as best_ask, count(*) filter (l.side = 'BID') as bid_depth, count(*) filter (l.side = 'ASK') as ask_depth,
  coalesce(sum(l.quantity) filter (l.side = 'BID'), 0)::bigint as bid_volume, coalesce(sum(l.quantity) filter (l.side = 'ASK'), 0)::bigint as ask_volume
  from deltas d left join live l on l.symbol = d.symbol and l.quantity > 0 and l.b <= d.update_id and (l.e is null or d.update_id < l.e) group by 1, 2""")
def top_of_book(t):
    return book.top_of_book(M.deltas(t))


@query("select * from (select symbol, side, row_number() over (partition by symbol, side order by case side when 'BID' then -price else price end) as rank, price, quantity from live where e is null and quantity > 0) where rank <= 5")
def final_book_topn(t):
    return book.final_book(M.deltas(t), 5)


@query("""select symbol, update_id, cast(floor((bb + ba) / 2.0) as bigint) as mid, ba - bb as spread from (select d.symbol, d.update_id, max(l.price) filter (l.side = 'BID') as bb, min(l.price) filter (l.side = 'ASK') as ba from deltas d
  left join live l on l.symbol = d.symbol and l.quantity > 0 and l.b <= d.update_id and (l.e is null or d.update_id < l.e) group by 1, 2)""")
def mid_spread(t):
    return book.top_of_book(M.deltas(t)).select("symbol", "update_id", S.mid_price(F.col("best_bid"), F.col("best_ask")).cast("long").alias("mid"), S.spread(F.col("best_bid"), F.col("best_ask")).alias("spread"))


@query()
def replay_book(t):
    d = M.deltas(t).withColumnRenamed("new_quantity", "quantity")
    return book.replay(unify.unioned(M.trades(t), M.snapshots(t), d))


_BOOKED = """(select symbol, snap_id, side, price, quantity from (select s.symbol, s.update_id as snap_id, l.side, l.price, l.quantity, row_number() over (partition by s.symbol, s.update_id, l.side order by case l.side when 'BID' then -l.price else l.price end) as r
  from snaps s join live l on l.symbol = s.symbol and l.quantity > 0 and l.b <= s.update_id and (l.e is null or s.update_id < l.e)) where r <= 20)"""
_DRIFT = f"""(select symbol, snap_id, coalesce(max(case when side = 'BID' then case when n_s = 0 then 1.0 else rms end end), 0) as bid_rms, coalesce(max(case when side = 'ASK' then case when n_s = 0 then 1.0 else rms end end), 0) as ask_rms, max(dev) as max_deviation, coalesce(max(case when side = 'BID' then abs(n_s - n_r) end), 0) as bid_level_diff, coalesce(max(case when side = 'ASK' then abs(n_s - n_r) end), 0) as ask_level_diff
  from (select symbol, snap_id, side, sqrt(avg(case when s > 0 then ((s - coalesce(r, 0)) / s) ** 2 when r > 0 then 1.0 end)) as rms, max(case when s is null or r is null then 1.0 else abs(r - s) / s end) as dev, count(s) as n_s, count(r) as n_r
  from (select coalesce(a.symbol, b.symbol) as symbol, coalesce(a.snap_id, b.snap_id) as snap_id, coalesce(a.side, b.side) as side, a.quantity as s, b.quantity as r from levels a full join {_BOOKED} b on a.symbol = b.symbol and a.snap_id = b.snap_id and a.side = b.side and a.price = b.price) group by 1, 2, 3) group by 1, 2)"""


def _drift(t: DataFrame) -> DataFrame:
    s = M.snapshots(t)
    return book.snapshot_drift(book.book_at(M.deltas(t), s), M.levels(s))


@query(f"select symbol, snap_id, round(bid_rms, 9) as bid_rms, round(ask_rms, 9) as ask_rms, round(sqrt((bid_rms ** 2 + ask_rms ** 2) / 2), 9) as rms, round(max_deviation, 9) as max_deviation, bid_level_diff, ask_level_diff from {_DRIFT}")
def snapshot_drift(t):
    r = lambda c: F.round(c, 9).alias(c)
    return _drift(t).select("symbol", "snap_id", r("bid_rms"), r("ask_rms"), r("rms"), r("max_deviation"), "bid_level_diff", "ask_level_diff")


@query(f"""select count(*) as snapshots, round(avg(v), 6) as mean, round(max(v), 9) as max, round(min(v), 9) as min, list_sort(list(round(v, 9)))[(0.95 * (count(*) - 1))::decimal(18,4)::double::int64 + 1 - case when (0.95 * (count(*) - 1)) < ((0.95 * (count(*) - 1))::decimal(18,4)::double::int64) then 1 else 0 end] as p95, round(avg((v > 0.05)::int), 9) as resync_rate,
  list_sort(list(round(v, 9)))[floor(0.99 * (count(*) - 1))::int64 + 1] as p99 from (select sqrt((bid_rms ** 2 + ask_rms ** 2) / 2) as v from {_DRIFT})""")
def drift_summary(t):
    return stats.drift_summary(_drift(t).withColumn("rms", F.round("rms", 12))).withColumn("mean", F.round("mean", 6))


@query(f"""select a.symbol, a.snap_id, a.side, sum(abs(a.price - b.price))::bigint as price_l1, sum(abs(a.quantity - b.quantity))::bigint as quantity_l1, count(*) as levels
  from (select *, row_number() over (partition by symbol, snap_id, side order by case side when 'BID' then -price else price end) as k from levels) a join (select *, row_number() over (partition by symbol, snap_id, side order by case side when 'BID' then -price else price end) as k from {_BOOKED}) b
  on a.symbol = b.symbol and a.snap_id = b.snap_id and a.side = b.side and a.k = b.k group by 1, 2, 3""")
def rank_drift(t):
    s = M.snapshots(t)
    return book.rank_drift(book.book_at(M.deltas(t), s), M.levels(s))


@query("select t.symbol, t.event_id, t.price, (select arg_max(d.price, d.update_id) from deltas d where d.symbol = t.symbol and d.origin_time <= t.origin_time) as last_level from trades t")
def as_of_level(t):
    right = M.deltas(t).select("symbol", "origin_time", F.col("price").alias("last_level"), "update_id")
    return sequence.as_of(M.trades(t).select("symbol", "event_id", "price", "origin_time"), right, "symbol", "origin_time", "last_level", tie="update_id").drop("origin_time")


# ------------------------------------------------------------------- statistics


@query("select kind, round(avg(qty), 6) as mean, round(stddev_pop(qty), 6) as std, round(quantile_cont(qty, 0.5), 6) as median, min(qty) as min, max(qty) as max, round(quantile_cont(qty, 0.25), 6) as q25, round(quantile_cont(qty, 0.75), 6) as q75, count(qty) as n from t group by 1")
def basic_stats(t):
    return stats.basic(t, "qty", ["kind"])


def _rel(a: str, b: str) -> str:
    return f"round(abs({a} - {b}) / greatest(abs({a}), 1e-10), 6)"


@query(f"""select *, mean_diff <= 0.01 and std_diff <= 0.05 and median_diff <= 0.01 as passed from (select {_rel('a.m', 'b.m')} as mean_diff, {_rel('a.s', 'b.s')} as std_diff, {_rel('a.d', 'b.d')} as median_diff, a.n as n, b.n as n_2 from
  (select round(avg(qty), 6) as m, round(stddev_pop(qty), 6) as s, quantile_cont(qty, 0.5) as d, count(*) as n from t where kind = 'view') a, (select round(avg(qty), 6) as m, round(stddev_pop(qty), 6) as s, quantile_cont(qty, 0.5) as d, count(*) as n from t where kind = 'click') b)""")
def basic_stats_compare(t):
    return stats.compared(t.filter("kind = 'view'"), t.filter("kind = 'click'"), "qty")


@query("""select round(max(abs(fa - fb)), 9) as statistic, max(na)::bigint as n1, max(nb)::bigint as n2 from (select sum(a) over (order by v) / sum(a) over () as fa, sum(b) over (order by v) / sum(b) over () as fb, sum(a) over () as na, sum(b) over () as nb
  from (select qty as v, count(*) filter (kind = 'view') as a, count(*) filter (kind = 'click') as b from t where kind in ('view', 'click') group by 1))""")
def ks_two_sample(t):
    return stats.ks_statistic(t.filter("kind in ('view', 'click')"), "qty", "kind = 'view'").drop("p_value_asymptotic")


@query("select count(*) as n_tail, round(1 + count(*) / sum(ln(qty / 1000.0)), 6) as alpha, round((count(*) / sum(ln(qty / 1000.0))) / sqrt(count(*)), 6) as sigma, abs(1 + count(*) / sum(ln(qty / 1000.0)) - 2.4) <= 0.1 as near_target from t where qty >= 1000")
def power_law_alpha(t):
    return stats.power_law(t, "qty", 1000.0)


@query("select side, round(avg(price), 6) as mean_price, sum(quantity)::bigint as quantity, count(*) as n, min(price) as low, max(price) as high, round(stddev_samp(quantity), 6) as std from trades group by 1")
def side_aggregates(t):
    return M.trades(t).groupBy("side").agg(F.round(F.avg("price"), 6).alias("mean_price"), F.sum("quantity").alias("quantity"), F.count("*").alias("n"), F.min("price").alias("low"), F.max("price").alias("high"), F.round(F.stddev_samp("quantity"), 6).alias("std"))


@query("select event_id, price * quantity as notional, cast(price * quantity * 1001 as bigint) as notional_with_fee_milli from trades")
def decimal_notional(t):
    d = lambda c: F.col(c).cast("decimal(18,8)")
    return M.trades(t).select("event_id", (d("price") * d("quantity")).cast("long").alias("notional"), (d("price") * d("quantity") * F.lit("1.001").cast("decimal(4,3)") * 1000).cast("long").alias("notional_with_fee_milli"))


@query("select event_id, (price * 100 + quantity % 100)::bigint as pips, ((price * 100 + quantity % 100) / 100.0)::double as back, ((price * 100 + quantity % 100) * 1000000)::bigint as scaled from trades")
def pips_roundtrip(t):
    dec = (F.col("price").cast("decimal(18,4)") + (F.col("quantity") % 100).cast("decimal(18,4)") / F.lit(100).cast("decimal(4,0)")).cast("decimal(20,10)")
    pips = S.to_pips(dec, F.lit(100))
    return M.trades(t).select("event_id", pips.alias("pips"), (pips / F.lit(100.0)).alias("back"), S.decimal_to_scaled(dec).alias("scaled"))


@query("select event_id, cast(qty * 1000000 as bigint) as scaled, qty / 100.0 as back, cast(floor((qty - 5001) / 2.0) as bigint) as mid from t")
def scaled_ints(t):
    s = S.to_scaled(F.col("qty") / F.lit(100.0))
    return t.select("event_id", s.alias("scaled"), F.round(S.from_scaled(s), 6).alias("back"), S.mid_price(F.col("qty"), F.lit(-5001)).cast("long").alias("mid"))


# --------------------------------------------------------- partitions, manifests

_HOURS = "(select symbol, strftime(make_timestamp(origin_time // 1000), '%Y/%m/%d/%H') as partition_path, count(*) as row_count, min(origin_time) as timestamp_min, max(origin_time) as timestamp_max, string_agg(distinct event_type, ',' order by event_type) as event_types from unified group by 1, 2)"


def _manifest(t: DataFrame) -> DataFrame:
    return sinks.manifest(_unified(t), "origin_time")


@query(f"select * from {_HOURS}")
def hour_partitions(t):
    return _manifest(t)


@query(f"select count(*) as partitions, sum(row_count)::bigint as rows, min(timestamp_min) as first, max(timestamp_max) as last from {_HOURS}")
def manifest_stats(t):
    return sinks.manifest_stats(_manifest(t))


@query(f"select symbol, partition_path, row_count from {_HOURS} where timestamp_max >= 1704330000000000000 and timestamp_min <= 1704412799000000000")
def manifest_overlap(t):
    return sinks.overlapping(_manifest(t), 1_704_330_000_000_000_000, 1_704_412_799_000_000_000).select("symbol", "partition_path", "row_count")


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    status = F.when(F.col("o_orderstatus") == "F", "READY").when(F.col("o_orderstatus") == "O", "RAW").otherwise("QUARANTINED")
    kind = F.element_at(F.array(F.lit("trades"), F.lit("book"), F.lit("book_delta_v2")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    return o.select(F.col("o_orderkey").alias("key"), status.alias("status"), kind.alias("data_type"), F.col("o_custkey").alias("size"), F.col("o_orderdate").cast("date").alias("date"))


_FILES = "--plain\nwith files as (select o_orderkey as key, case o_orderstatus when 'F' then 'READY' when 'O' then 'RAW' else 'QUARANTINED' end as status, (['trades', 'book', 'book_delta_v2'])[1 + (o_orderkey % 3)::int] as data_type, o_custkey as size, o_orderdate::date as date from orders) "


@query(_FILES + "select r.data_type, coalesce(count(f.key), 0) as files, coalesce(sum(f.size), 0)::bigint as bytes, min(f.date) as first_date, max(f.date) as last_date, count(f.key) > 0 as ready, case when count(f.key) = 0 then 'no ready files' when count(distinct f.date) < 0.95 * (max(f.date) - min(f.date) + 1) then 'days missing' end as issue from (values ('trades'), ('book'), ('book_delta_v2'), ('funding')) r(data_type) left join files f on f.data_type = r.data_type and f.status = 'READY' group by 1")
def ready_certificate(spark, sf_dir):
    return quality.certificate(_files(spark, sf_dir), ["trades", "book", "book_delta_v2", "funding"])


@query(_FILES + "select status, data_type, count(*) as files, sum(size)::bigint as bytes from files group by 1, 2")
def staging_summary(spark, sf_dir):
    return _files(spark, sf_dir).groupBy("status", "data_type").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))


@query(_FILES + "select key, date from files where status = 'READY' and data_type = 'book' and date >= date '1995-01-01'")
def ready_files(spark, sf_dir):
    return _files(spark, sf_dir).filter("status = 'READY' and data_type = 'book' and date >= date'1995-01-01'").select("key", "date")


# ------------------------------------------------------------- routing, messages


@query("select symbol, count(*) as routed from unified where symbol <> 'S3' group by 1")
def route_counts(t):
    known = ["S0", "S1", "S2"]
    return _unified(t).filter(F.col("symbol").isin(known)).groupBy("symbol").agg(F.count("*").alias("routed"))


@query("select symbol, max(update_id) as checkpoint from snaps where update_id <= 5000 group by 1")
def checkpoint_asof(t):
    return M.snapshots(t).filter("update_id <= 5000").groupBy("symbol").agg(F.max("update_id").alias("checkpoint"))


@query("select symbol, update_id from deltas where update_id > 5000")
def resume_filter(t):
    return M.deltas(t).filter("update_id > 5000").select("symbol", "update_id")


@query("select substr(stream, strpos(stream, '@') + 1) as stream_type, count(*) as n from captured group by 1")
def stream_type_counts(t):
    return readers.type_counts(M.messages(t))


@query("select capture_ns, upper(split_part(stream, '@', 1)) as symbol, event_id as trade_id, (9990 + event_id % 21 + 0.5)::double as price, qty::double as quantity from captured where kind in ('purchase', 'click')")
def parsed_trades(t):
    return readers.trade_messages(M.messages(t)).select("capture_ns", "symbol", "trade_id", F.col("price").cast("double").alias("price"), F.col("quantity").cast("double").alias("quantity"))


@query("select capture_ns, upper(split_part(stream, '@', 1)) as symbol, event_id * 3 as first_id, event_id * 3 + 2 as final_id, cast(9980 + event_id % 20 as varchar) as best_bid from captured where kind not in ('purchase', 'click')")
def parsed_depth(t):
    return readers.depth_messages(M.messages(t)).select("capture_ns", "symbol", "first_id", "final_id", F.col("bids")[0][0].alias("best_bid"))


@query("select upper(split_part(stream, '@', 1)) as symbol, count(*) as n, round(avg(case when kind in ('purchase', 'click') then 9990.5 + event_id % 21 else 9980 + event_id % 20 end), 6) as mean_price from captured group by 1")
def extracted_prices(t):
    return readers.prices(M.messages(t)).groupBy("symbol").agg(F.count("*").alias("n"), F.round(F.avg("price"), 6).alias("mean_price"))


@query("select count(*) as messages, count(*) filter (contains(stream, '@trade')) as trades, round((max(capture_ns) - min(capture_ns)) / 3.6e12, 6) as hours, round(count(*) / ((max(capture_ns) - min(capture_ns)) / 1e9), 9) as per_second from captured")
def session_stats(t):
    span = F.max("capture_ns") - F.min("capture_ns")
    return M.messages(t).agg(F.count("*").alias("messages"), F.count_if(F.col("stream").contains("@trade")).alias("trades"), F.round(span / 3.6e12, 6).alias("hours"), F.round(F.count("*") / (span / 1e9), 9).alias("per_second"))


@query("--plain\nselect s.symbol, k.data_type, d::date as first_day, least(d::date + 6, date '2024-02-10') as last_day from (values ('BTC'), ('ETH')) s(symbol), (values ('trades'), ('book')) k(data_type), generate_series(date '2024-01-01', date '2024-02-10', interval 7 day) g(d)")
def download_tasks(spark, sf_dir):
    return readers.download_tasks(spark, "2024-01-01", "2024-02-10", 7, ["BTC", "ETH"], ["trades", "book"])


@query("select symbol, origin_time // 3600000000000 as bucket, sum(case side when 'BUY' then quantity else -quantity end)::bigint as imbalance, count(*) as n from trades group by 1, 2")
def order_flow_imbalance(t):
    signed = F.when(F.col("side") == "BUY", F.col("quantity")).otherwise(-F.col("quantity"))
    return M.trades(t).groupBy("symbol", F.expr("origin_time div 3600000000000").alias("bucket")).agg(F.sum(signed).alias("imbalance"), F.count("*").alias("n"))


# ------------------------------------------------------------------- validators


@query(f"""select event_id % 3 as regime, count(*) as messages, count(*) filter (u0 > expected) as gaps, round(count(*) filter (u0 > expected) / count(*), 9) as gap_ratio, case when round(count(*) filter (u0 > expected) / count(*), 9) < 0.001 then 'GO' else 'NO-GO' end as decision
  from (select *, seq as event_id, lag(u1) over (partition by symbol order by seq) + 1 as expected from ranges) group by 1""")
def golden_regimes(t):
    r = M.ranges(t).withColumn("regime", F.col("event_id") % 3)
    return validators.regimes(r, "regime", last="u_last", first="U")


_HALF = "(select r.*, t.origin_time, r.seq % 2 as h, lag(t.origin_time) over w as last_time, lag(r.u1) over w + 1 as expected from ranges r join t on t.event_id = r.seq window w as (partition by r.symbol, r.seq % 2 order by r.seq))"


@query(f"""select 'basic_statistics' as validator, dm <= 0.01 and ds <= 0.05 and dd <= 0.01 as passed, dm::double as first_metric from (select {_rel('a.m', 'b.m')} as dm, {_rel('a.s', 'b.s')} as ds, {_rel('a.d', 'b.d')} as dd
  from (select round(avg(qty), 6) as m, round(stddev_pop(qty), 6) as s, quantile_cont(qty, 0.5) as d from t where event_id % 2 = 0) a, (select round(avg(qty), 6) as m, round(stddev_pop(qty), 6) as s, quantile_cont(qty, 0.5) as d from t where event_id % 2 = 1) b)
  union all select 'chronology', count(*) filter (origin_time < last_time) = 0, (count(*) filter (h = 0 and origin_time < last_time))::double from {_HALF}
  union all select 'sequence_gaps', a <= 1e-4 and b <= 1e-4, a from (select round(count(*) filter (h = 0 and u0 <> expected) / count(*) filter (h = 0), 9) as a, round(count(*) filter (h = 1 and u0 <> expected) / count(*) filter (h = 1), 9) as b from {_HALF})""")
def validation_report(t):
    x = M.ranges(t).join(t.select("event_id", "qty", "origin_time"), "event_id")
    v = [validators.BasicStatistics("qty"), validators.Chronology("origin_time"), validators.SequenceGaps(last="u_last", first="U")]
    out = validators.run(t.sparkSession, v, x.filter("event_id % 2 = 0"), x.filter("event_id % 2 = 1"))
    first = F.coalesce(*[F.get_json_object("metrics", f"$.{k}").cast("double") for k in ("mean_diff", "golden_out_of_order", "golden_ratio")])
    return out.select("validator", "passed", first.alias("first_metric"))


@query("select symbol, snap_id, k, max(price) filter (side = 'ASK') - max(price) filter (side = 'BID') as spread from (select *, row_number() over (partition by symbol, snap_id, side order by case side when 'BID' then -price else price end) as k from levels) where k in (1, 3, 5) group by 1, 2, 3")
def level_spreads(t):
    return validators.spreads(M.levels(M.snapshots(t)), [1, 3, 5])


@query("""select symbol, round(regr_slope(change, flow), 9) as kyle_lambda, round(avg(abs(change) / volume), 9) as amihud, count(*) as buckets from (select symbol, flow, volume, close - lag(close) over (partition by symbol order by b) as change
  from (select symbol, origin_time // 3600000000000 as b, sum(case side when 'BUY' then quantity else -quantity end)::double as flow, sum(quantity)::double as volume, arg_max(price, event_id) as close from trades group by 1, 2)) where change is not null group by 1""")
def price_impact(t):
    return validators.impact(M.trades(t), 3_600_000_000_000)


@query("select symbol, round(count(*) / 1000.0 * 12 * 1.5, 6)::double as read_gb, round(count(*) / 1000.0 * 12 * 3.25, 6)::double as written_gb from unified group by 1")
def storage_estimate(t):
    v = _unified(t).groupBy("symbol").agg((F.count("*") / F.lit(1000.0)).alias("gb_per_month"))
    return validators.storage(v, 12, 1.5, 3.25)


@query("select s.symbol, s.snap_id, count(t.event_id) as trades, coalesce(sum(t.quantity), 0)::bigint as volume from (select symbol, update_id as snap_id, origin_time // 600000000000 as w from snaps) s left join trades t on t.symbol = s.symbol and t.origin_time // 600000000000 = s.w group by 1, 2")
def snapshot_windows(t):
    width = 600_000_000_000
    s = M.snapshots(t).select("symbol", F.col("update_id").alias("snap_id"), F.expr(f"origin_time div {width}").alias("w"))
    tr = M.trades(t).select("symbol", F.expr(f"origin_time div {width}").alias("w"), "event_id", "quantity")
    return s.join(tr, ["symbol", "w"], "left").groupBy("symbol", "snap_id").agg(F.count("event_id").alias("trades"), F.coalesce(F.sum("quantity"), F.lit(0)).alias("volume"))


@query()
def hash_routes(t):
    return _unified(t).groupBy(S.route(F.col("symbol"), 3).alias("worker")).agg(F.count("*").alias("n"))


@query("--plain\nselect (id + 1 + (id * 6 // 10000) * ((id * 6 // 10000) + 3) / 2)::bigint as update_id, case when id % 2 = 0 then 'BID' else 'ASK' end as side, (44000 + (id * 37) % 2000)::bigint as price, case when id % 10 = 0 then 0 else (id * 13) % 1000 end::bigint as new_quantity from range(10000) r(id)")
def synthetic_deltas(spark, sf_dir):
    return readers.synthetic_deltas(spark, 10_000).drop("origin_time")


@query("select event_id, symbol, price, quantity, side from trades where symbol = 'S1' and origin_time between 1704200000000000000 and 1704900000000000000")
def selected_trades(t):
    return readers.selected(M.trades(t), "S1", (1_704_200_000_000_000_000, 1_704_900_000_000_000_000)).select("event_id", "symbol", "price", "quantity", "side")


# ------------------------------------------------- global order, stored tables


_ORDER = "order by origin_time, update_id nulls first, case event_type when 'TRADE' then 0 when 'BOOK_SNAPSHOT' then 1 else 2 end, event_id"


@query(f"select event_id, row_number() over ({_ORDER}) as place from unified")
def unify_global_order(t):
    return unify.placed(_unified(t)).select("event_id", "place")


@query(f"select event_id, row_number() over ({_ORDER}) as place from unified where event_type <> 'BOOK_SNAPSHOT'")
def merged_files(t):
    parts = [M.trades(t).filter("event_id % 2 = 0"), M.trades(t).filter("event_id % 2 = 1"), M.deltas(t)]
    return unify.placed(unify.merged(parts)).select("event_id", "place")


def _folder(spark: SparkSession) -> str:
    """A new folder in the warehouse, which the whole cluster sees."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tidebook-{uuid.uuid4().hex}"


@query("select event_type, count(*) as n, sum(price)::bigint as price, sum(quantity)::bigint as quantity, min(origin_time) as first, max(update_id) as last_id from (select event_type, price, coalesce(quantity, new_quantity) as quantity, origin_time, update_id from unified where event_type <> 'BOOK_SNAPSHOT') group by 1")
def read_events(t):
    """Trades and deltas through the scans of files, with their required columns."""
    at, parts = _folder(t.sparkSession), []
    for kind, rows, quantity in (("TRADE", M.trades(t), "quantity"), ("BOOK_DELTA", M.deltas(t), "new_quantity")):
        rows.drop("event_type").write.parquet(f"{at}/{kind}/day=1")
        parts.append(readers.events(t.sparkSession, f"{at}/{kind}", kind).withColumnRenamed(quantity, "amount"))
    g = unify.unioned(*parts).groupBy("event_type")
    return g.agg(F.count("*").alias("n"), F.sum("price").cast("long").alias("price"), F.sum("amount").cast("long").alias("quantity"), F.min("origin_time").alias("first"), F.max("update_id").alias("last_id"))


@query("select snap_id, side, price, quantity from levels")
def read_snapshots(t):
    """Snapshots through the scan of files, from wide columns of levels."""
    at, lv = _folder(t.sparkSession), lambda c, s, k: F.col(c)[k][s]
    wide = [lv(f"{side}s", "price" if n == "price" else "quantity", k).alias(f"{side}_{k}_{n}") for side in ("bid", "ask") for k in range(5) for n in ("price", "size")]
    M.snapshots(t).select("symbol", "origin_time", F.col("update_id").alias("sequence_number"), *wide).write.parquet(at)
    long = lambda c: F.transform(c, lambda x: F.struct(x["price"].cast("long").alias("price"), x["quantity"].cast("long").alias("quantity"))).alias(c)
    s = readers.events(t.sparkSession, at, "BOOK_SNAPSHOT").select("symbol", "update_id", long("bids"), long("asks"))
    return M.levels(s).select("snap_id", "side", "price", "quantity")


@query("select event_type, strftime(make_timestamp(origin_time // 1000), '%Y/%m/%d/%H') as hour, count(*) as n, sum(price)::bigint as price, sum(levels)::bigint as levels from (select event_type, origin_time, case when event_type = 'TRADE' and not quantity > 0 then null else price end as price, case when event_type = 'BOOK_SNAPSHOT' then 10 else 0 end as levels from unified where not (event_type = 'TRADE' and not quantity > 0)) group by 1, 2")
def stored_events(t):
    """Valid events through the hourly sink and back: decimals, levels as JSON, folders by hour."""
    at = _folder(t.sparkSession)
    sinks.write_events(unify.normalised(_unified(t)), at)
    e = sinks.from_file(t.sparkSession.read.parquet(at))
    hour = F.concat_ws("/", *[F.lpad(F.col(c).cast("string"), n, "0") for c, n in (("year", 4), ("month", 2), ("day", 2), ("hour", 2))])
    price = F.coalesce("trade_price", "delta_price")
    return e.groupBy("event_type", hour.alias("hour")).agg(F.count("*").alias("n"), F.sum(price).cast("long").alias("price"), F.sum(F.coalesce(F.size("bids") + F.size("asks"), F.lit(0))).alias("levels"))


@query("select upper(split_part(stream, '@', 1)) as symbol, count(*) as n, min(capture_ns) as first from captured where contains(stream, '@trade') group by 1")
def stored_messages(t):
    """Captured messages through the hourly gzip sink and the filtered scan."""
    at = _folder(t.sparkSession)
    sinks.write_messages(M.messages(t).select("capture_ns", "stream", "data"), at, hourly=True)
    m = readers.messages(t.sparkSession, at, F.col("stream").contains("@trade"))
    return m.groupBy(S.stream_symbol(F.col("stream")).alias("symbol")).agg(F.count("*").alias("n"), F.min("capture_ns").alias("first"))


@query(f"select symbol, partition_path, row_count, timestamp_min, timestamp_max, event_types from {_HOURS}")
def manifest_compacted(t):
    """Manifest rows added in three batches, one of them twice, and compacted."""
    at, u = _folder(t.sparkSession), _unified(t)
    for batch in (0, 1, 1, 2):
        sinks.append_manifest(u.filter(F.col("event_id") % 3 == batch), at, batch, "origin_time")
    return sinks.compact_manifest(t.sparkSession, at, f"{at}-compacted")


@query("select substr(stream, strpos(stream, '@') + 1) as stream_type, count(*) as messages, count(*) filter (event_id % 19 = 0) as errors, false as is_total from captured group by 1 union all select null, count(*), count(*) filter (event_id % 19 = 0), true from captured")
def message_statistics(t):
    broken = M.messages(t).withColumn("data", F.when(F.col("event_id") % 19 == 0, "{broken").otherwise(F.col("data")))
    return readers.message_statistics(broken)


# --------------------------------------------------------- recovery and routing


@query("select t.symbol, t.event_id, (select max(s.update_id) from snaps s where s.symbol = t.symbol and s.update_id <= t.update_id) as checkpoint from trades t")
def checkpoint_lookup(t):
    s = M.snapshots(t).select("symbol", "update_id", F.col("update_id").alias("checkpoint"))
    return sequence.as_of(M.trades(t).select("symbol", "event_id", "update_id"), s, "symbol", "update_id", "checkpoint", span=65_536).drop("update_id")


_CONT = "(select c.symbol, c.checkpoint, min(d.update_id) filter (d.update_id > c.checkpoint) as first_id, count(d.update_id) filter (d.update_id <= c.checkpoint) as duplicates from (select symbol, min(update_id) + 3 as checkpoint from snaps group by 1) c left join deltas d on d.symbol = c.symbol and d.update_id % 2 = 0 group by 1, 2)"


@query(f"select symbol, checkpoint, first_id, first_id - checkpoint - 1 as gap, duplicates, case when first_id is null then 'no_updates' when first_id - checkpoint - 1 > 1000 then 'failed' when duplicates > 0 then 'duplicates' else 'ok' end as status from {_CONT}")
def recovery_continuity(t):
    c = M.snapshots(t).groupBy("symbol").agg((F.min("update_id") + 3).alias("checkpoint"))
    return recovery.continuity(c, M.deltas(t).filter("update_id % 2 = 0"))


_SYNC = """(select symbol, event_id * 3 as u0, event_id * 3 + 2 as u1 from t where event_id % 5 <> 0)"""


@query(f"""select b.symbol, b.attempts, b.synced, b.last_id, b.first_update, count(*) filter (u.u1 <= b.last_id) as stale, min(u.u0) filter (u.u0 > b.first_update and u.u0 <> u.prev + 1) as resync_at from
  (select symbol, coalesce(min(k) filter (first_update is not null), max(k)) as attempts, count(first_update) > 0 as synced, arg_min(last_id, k) filter (first_update is not null) as last_id, arg_min(first_update, k) filter (first_update is not null) as first_update from
    (select s.symbol, s.k, s.last_id, min(u.u0) as first_update from (select symbol, update_id * 3 as last_id, row_number() over (partition by symbol order by update_id) as k from snaps) s left join {_SYNC} u on u.symbol = s.symbol and u.u0 <= s.last_id + 1 and s.last_id + 1 <= u.u1 where s.k <= 5 group by 1, 2, 3) group by 1) b
  join (select *, lag(u1) over (partition by symbol order by u0) as prev from {_SYNC}) u on u.symbol = b.symbol group by all""")
def synchroniser(t):
    s = M.snapshots(t).select("symbol", (F.col("update_id") * 3).alias("update_id"))
    u = t.filter("event_id % 5 <> 0").select("symbol", (F.col("event_id") * 3).alias("first_id"), (F.col("event_id") * 3 + 2).alias("final_id"))
    return recovery.synchronised(s, u, sequence.sync_points(s, u))


@query("select symbol, count(*) as checkpoints, round(avg(d), 3) as mean_interval, min(d) as least_interval, max(d) as largest_interval from (select symbol, origin_time - lag(origin_time) over (partition by symbol order by update_id) as d from snaps) group by 1")
def checkpoint_intervals(t):
    return recovery.intervals(M.snapshots(t), "origin_time", "update_id")


@query("select symbol, case symbol when 'S0' then 0 when 'S1' then 1 when 'S2' then 0 end as worker, count(*) filter (symbol <> 'S3') as routed, count(*) filter (symbol = 'S3') as dropped from unified group by 1, 2")
def routed_and_dropped(t):
    config = t.sparkSession.createDataFrame([("S0", 0), ("S1", 1), ("S2", 0)], "symbol string, worker int")
    return unify.routed(_unified(t), config)


@query("select symbol, update_id, rank from (select symbol, update_id, row_number() over (partition by symbol order by update_id desc) as rank from snaps) where rank <= 3")
def retention_latest(t):
    return sinks.kept_latest(M.snapshots(t).select("symbol", "update_id"), "symbol", "update_id", 3)


@query("select symbol, count(*) filter (gap > 0) as gaps, coalesce(max(gap) filter (gap > 0), 0) as largest, min(expected_id) filter (gap > 0) as first_gap from gapped group by 1")
def first_gap(t):
    pos = F.when(F.col("gap") > 0, F.col("gap"))
    return sequence.with_gaps(M.deltas(t)).groupBy("symbol").agg(F.count(pos).alias("gaps"), F.coalesce(F.max(pos), F.lit(0)).alias("largest"), F.min(F.when(F.col("gap") > 0, F.col("expected_id"))).alias("first_gap"))


# ----------------------------------------------------------- values and formats


@query("select snap_id, side, price, quantity from levels")
def normalize_level_maps(t):
    """Levels as maps in three spellings."""
    names = F.when(F.col("update_id") % 3 == 0, F.array(F.lit("price"), F.lit("quantity"))).when(F.col("update_id") % 3 == 1, F.array(F.lit("p"), F.lit("q"))).otherwise(F.array(F.lit("price"), F.lit("size")))
    raw = M.snapshots(t).withColumn("k", names)
    raw = raw.select("update_id", "symbol", *[F.transform(c, lambda x: F.map_from_arrays(F.col("k"), F.array(x["price"], x["quantity"]))).alias(c) for c in ("bids", "asks")])
    s = raw.select("symbol", "update_id", S.levels_of_maps(F.col("bids")).alias("bids"), S.levels_of_maps(F.col("asks")).alias("asks"))
    return M.levels(s).select("snap_id", "side", "price", "quantity")


@query("select snap_id, sum(price * quantity)::bigint as weighted, count(*) as levels from levels group by 1")
def levels_as_json(t):
    """Levels written as JSON text and read back."""
    kind = "array<struct<price:bigint,quantity:bigint>>"
    s = M.snapshots(t).select("symbol", "update_id", *[F.from_json(F.to_json(c), kind).alias(c) for c in ("bids", "asks")])
    return M.levels(s).groupBy("snap_id").agg(F.sum(F.col("price") * F.col("quantity")).alias("weighted"), F.count("*").alias("levels"))


@query("select symbol, min(make_timestamp(origin_time // 1000)) as first_time, max(make_timestamp(origin_time // 1000)) as last_time, round((max(origin_time) - min(origin_time)) / 3.6e12, 6) as hours, year(min(make_timestamp(origin_time // 1000))) >= 2020 and year(max(make_timestamp(origin_time // 1000))) <= 2030 as plausible from unified group by 1")
def epoch_times(t):
    return quality.within_years(_unified(t), "origin_time", "symbol")


@query("select event_id, cast(round((price + 0.005) * m) as bigint) as price_pips, (quantity * 10)::bigint as quantity_pips, cast(round((price + 0.005) * m) as bigint) / m::double as back from trades join (values ('S0', 100), ('S1', 1000), ('S2', 10), ('S3', 1)) s(sym, m) on sym = symbol")
def symbol_pips(t):
    scale = t.sparkSession.createDataFrame([("S0", 100), ("S1", 1000), ("S2", 10), ("S3", 1)], "symbol string, m int")
    d = M.trades(t).join(F.broadcast(scale), "symbol")
    pips = S.to_pips(F.col("price").cast("decimal(20,10)") + F.lit("0.005").cast("decimal(10,5)"), F.col("m"))
    return d.select("event_id", pips.alias("price_pips"), S.to_pips(F.col("quantity").cast("decimal(20,10)"), F.lit(10)).alias("quantity_pips"), (pips / F.col("m").cast("double")).alias("back"))


@query("--plain\nselect p as nanos, strftime(make_timestamp(p // 1000), '%Y/%m/%d/%H') as hour, (p + 1) // 2 as mid from (select 1704412799999999990 + r.id - 5 * (r.id % 7) as p from range(20) r(id) union all select 1704412800000000000 + 3600000000000 * r.id - 1 from range(30) r(id))")
def hour_borders(spark, sf_dir):
    """Hours of times next to the end of an hour or a day, where doubles would round."""
    a = spark.range(20).select((F.lit(1_704_412_799_999_999_990) + F.col("id") - 5 * (F.col("id") % 7)).alias("nanos"))
    b = spark.range(30).select((F.lit(1_704_412_800_000_000_000) + F.lit(3_600_000_000_000) * F.col("id") - 1).alias("nanos"))
    return a.unionAll(b).select("nanos", S.hour_path(F.col("nanos")).alias("hour"), S.mid_price(F.col("nanos"), F.lit(1)).alias("mid"))


# ------------------------------------------------------- acceptance and reports


@query("""select file, count(*) as messages, count(*) filter (contains(stream, '@trade')) as trades, round((max(capture_ns) - min(capture_ns)) / 3.6e12, 6) as hours, round(count(*) / ((max(capture_ns) - min(capture_ns)) / 1e9), 6) as per_second, count(*) filter (capture_ns < prev) as out_of_order,
  count(*) >= 1 and count(*) filter (capture_ns < prev) <= count(*) * 0.1 and count(*) filter (contains(stream, '@trade')) > 0 as accepted from (select *, event_id // 100 as file, lag(capture_ns) over (partition by event_id // 100 order by event_id) as prev from captured) group by 1 having max(capture_ns) > min(capture_ns)""")
def captured_files(t):
    m = M.messages(t).withColumn("file", F.expr("event_id div 100"))
    return quality.captured_files(m, "file", "event_id").filter("per_second is not null")


@query("select count(*) as files, sum(n)::bigint as messages, round(avg(n), 6) as mean, max(n) as most from (select event_id // 100 as file, count(*) as n from captured group by 1)")
def messages_per_file(t):
    g = M.messages(t).groupBy(F.expr("event_id div 100").alias("file")).agg(F.count("*").alias("n"))
    return g.agg(F.count("*").alias("files"), F.sum("n").alias("messages"), F.round(F.avg("n"), 6).alias("mean"), F.max("n").alias("most"))


@query("select count(*) as checks, sum(r)::bigint as rows, sum(b)::bigint as bad, round((sum(r) - sum(b)) * 100.0 / sum(r), 6)::double as valid_percent from (select kind, count(*) as r, count(*) filter (event_id % 13 = 0) as b from t group by 1)")
def report_summary(t):
    return quality.summed(quality.time_tiers(t, "kind", "event_id % 13 = 0"))


@query("select kind, count(*) as rows, count(*) filter (event_id % 13 = 0) as bad, round(count(*) filter (event_id % 13 = 0) * 100.0 / count(*), 6)::double as bad_percent, case when round(count(*) filter (event_id % 13 = 0) * 100.0 / count(*), 6) <= 5 then 'reliable' when round(count(*) filter (event_id % 13 = 0) * 100.0 / count(*), 6) <= 10 then 'usable' else 'unreliable' end as tier from t group by 1")
def origin_time_tiers(t):
    return quality.time_tiers(t, "kind", "event_id % 13 = 0")


@query("""select symbol, gaps, largest, gap_ratio, case (gap_ratio > 0.001)::int + (largest > 1000)::int when 0 then 'GO' when 1 then 'WARN' else 'NO-GO' end as verdict from
  (select symbol, count(*) filter (gap > 0) as gaps, coalesce(max(gap) filter (gap > 0), 0) as largest, round(count(*) filter (gap > 0) / count(*), 6) as gap_ratio from gapped group by 1)""")
def delta_spike(t):
    return quality.spike(sequence.gap_summary(M.deltas(t))).select("symbol", "gaps", "largest", "gap_ratio", "verdict")


@query("select count(qty) as n, max(qty) as peak, round(avg(qty), 6) as mean, min(qty) as least, list_sort(list(qty))[least(floor(0.95 * count(qty))::bigint, count(qty) - 1) + 1] as p95 from t")
def sample_summary(t):
    return stats.samples(t, "qty")


@query(_FILES + "select coalesce(a.key, b.key) as key, case when b.key is null then 'unlisted' when a.key is null then 'missing' when a.d = b.d then 'ok' else 'mismatch' end as status from (select key, key % 97 as d from files where key % 5 <> 0) a full join (select key, case when key % 7 = 0 then -1 else key % 97 end as d from files where key % 3 <> 0) b on a.key = b.key")
def checksum_lookup(spark, sf_dir):
    f = _files(spark, sf_dir)
    found = f.filter("key % 5 <> 0").select("key", (F.col("key") % 97).alias("sha256"))
    listed = f.filter("key % 3 <> 0").select("key", F.when(F.col("key") % 7 == 0, -1).otherwise(F.col("key") % 97).alias("sha256"))
    return sinks.verified(found, listed, "key")


# ----------------------------------------------------------- more distributions

_TWO = "(select qty as v, count(*) filter (kind = 'view') as a, count(*) filter (kind = 'click') as b, count(*) as h from t where kind in ('view', 'click') group by 1)"
_ECDF = f"(select v, h, sum(a) over w as fa, sum(b) over w as fb, sum(h) over w as fh, sum(a) over () as n, sum(b) over () as m from {_TWO} window w as (order by v))"


@query(f"""select round(d, 9) as statistic, n1, n2, round(case when t < 0.2 then 1.0 else least(1.0, greatest(0.0, 2 * (select sum(power(-1, k - 1) * exp(-2.0 * k * k * t * t)) from range(1, 101) r(k)))) end, 6) as p_value_asymptotic,
  round(case when t < 0.2 then 1.0 else least(1.0, greatest(0.0, 2 * (select sum(power(-1, k - 1) * exp(-2.0 * k * k * t * t)) from range(1, 101) r(k)))) end, 6) > 0.05 as passed
  from (select d, n1, n2, d * sqrt(n1 * n2 / (n1 + n2)) as t from (select max(abs(fa / n - fb / m)) as d, max(n)::bigint as n1, max(m)::bigint as n2 from {_ECDF}))""")
def ks_test(t):
    return stats.ks_statistic(t.filter("kind in ('view', 'click')"), "qty", "kind = 'view'").withColumn("passed", F.col("p_value_asymptotic") > 0.05)


@query(f"select n::bigint as n, m::bigint as m, round(sum(pow(fa / n - fb / m, 2) * h) * n * m / pow(n + m, 2), 6) as cramer_von_mises, round(sum(case when fh < n + m then pow(fa * (n + m) - n * fh, 2) * h / (fh * (n + m - fh)) end) / (n * m), 6) as anderson_darling from (select v, h::double as h, fa::double as fa, fb::double as fb, fh::double as fh, n::double as n, m::double as m from {_ECDF}) group by n, m")
def sample_distances(t):
    return stats.distances(t.filter("kind in ('view', 'click')"), "qty", "kind = 'view'")


@query("""select xmin, round(1 + n / s, 6) as alpha, n as n_tail, round((select max(abs(e.c / y.n - (1 - pow(e.x / y.xmin, 1 - (1 + y.n / y.s))))) from (select q as x, sum(c) over (order by q) as c from (select qty::double as q, count(*) as c from t where qty >= y.xmin group by 1)) e), 6) as distance
  from (select xmin, count(*) as n, sum(ln(qty / xmin)) as s from t, (values (500.0::double), (1000.0::double), (2000.0::double)) c(xmin) where qty >= xmin group by 1) y""")
def power_law_scan(t):
    return stats.power_law_scan(t, "qty", [500.0, 1000.0, 2000.0]).select("xmin", F.round("alpha", 6).alias("alpha"), "n_tail", F.round("distance", 6).alias("distance"))


@query("""select n, round(n * ln(n / s / 1000.0) - (1 + n / s) * s, 3) as power_law, round(n * ln(n / e) - n, 3) as exponential, round(-lx - n / 2 * ln(2 * pi() * v) - n / 2, 3) as lognormal,
  case when n * ln(n / s / 1000.0) - (1 + n / s) * s >= n * ln(n / e) - n and n * ln(n / s / 1000.0) - (1 + n / s) * s >= -lx - n / 2 * ln(2 * pi() * v) - n / 2 then 'power_law' when n * ln(n / e) - n >= -lx - n / 2 * ln(2 * pi() * v) - n / 2 then 'exponential' else 'lognormal' end as best
  from (select count(*) as n, sum(ln(qty / 1000.0)) as s, sum(qty - 1000.0)::double as e, var_pop(ln(qty)) as v, sum(ln(qty)) as lx from t where qty >= 1000)""")
def tail_models(t):
    r = lambda c: F.round(c, 3).alias(c)
    return stats.tail_models(t, "qty", 1000.0).select("n", r("power_law"), r("exponential"), r("lognormal"), "best")


@query("""select symbol, count(*) as states, count(*) filter (coalesce(bb >= ba, false)) as crossed, count(*) filter (bb is null or ba is null) as one_sided, round(count(*) filter (coalesce(bb >= ba, false)) / count(*), 9) as crossed_rate from (select d.symbol, d.update_id, max(l.price) filter (l.side = 'BID') as bb, min(l.price) filter (l.side = 'ASK') as ba from deltas d
  left join live l on l.symbol = d.symbol and l.quantity > 0 and l.b <= d.update_id and (l.e is null or d.update_id < l.e) group by 1, 2) group by 1""")
def crossed_rates(t):
    return validators.crossed(book.top_of_book(M.deltas(t)))


@query("select symbol, count(*) as buckets, round(var_pop(n) / avg(n), 9) as fano from (select symbol, origin_time // 3600000000000 as b, count(*) as n from unified group by 1, 2) group by 1")
def fano_factors(t):
    return validators.bursts(_unified(t), 3_600_000_000_000)


@query("""select symbol, count(*) as changes, count(*) filter (abs(d - m) > 2 * s) as jumps, max(abs(d)) as largest from (select symbol, d, avg(d) over (partition by symbol) as m, stddev_pop(d) over (partition by symbol) as s from
  (select symbol, close - lag(close) over (partition by symbol order by b) as d from (select symbol, origin_time // 3600000000000 as b, arg_max(price, event_id) as close from trades group by 1, 2)) where d is not null) group by 1""")
def price_jumps(t):
    return validators.price_jumps(M.trades(t), 3_600_000_000_000, 2.0)


@query()
def replay_statistics(t):
    """The replay job with its written outputs."""
    d = M.deltas(t).withColumnRenamed("new_quantity", "quantity")
    return jobs.replay_job(unify.unioned(M.trades(t), M.snapshots(t), d), _folder(t.sparkSession))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
