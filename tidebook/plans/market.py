"""Market views over the tables `events` and `lineitem`, in whole numbers so that every engine agrees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, symbol, origin_time (ns), update_id, kind, qty (hundredths), ts."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    nanos = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)") * 1000
    return e.select("event_id", F.concat(F.lit("S"), (F.col("user_id") % 4).cast("string")).alias("symbol"), nanos.alias("origin_time"), F.col("event_id").alias("update_id"), F.col("event_type").alias("kind"), F.round(F.col("value") * 100).cast("long").alias("qty"), "ts", "user_id")


def trades(t: DataFrame) -> DataFrame:
    """Purchases buy, clicks sell, at a price around the middle."""
    side = F.when(F.col("kind") == "purchase", "BUY").otherwise("SELL")
    return t.filter("kind in ('purchase', 'click')").select("event_id", "symbol", "origin_time", "update_id", F.lit("TRADE").alias("event_type"), F.col("event_id").alias("trade_id"), (F.lit(9990) + (F.col("event_id") * 37) % 21).alias("price"), F.col("qty").alias("quantity"), side.alias("side"))


def deltas(t: DataFrame) -> DataFrame:
    """Views set bid levels, errors ask levels; one in ten removes its level."""
    bid = F.col("kind") == "view"
    price = F.when(bid, 9980 + (F.col("event_id") * 37) % 20).otherwise(10001 + (F.col("event_id") * 37) % 20)
    return t.filter("kind in ('view', 'error')").select("event_id", "symbol", "origin_time", "update_id", F.lit("BOOK_DELTA").alias("event_type"), F.when(bid, "BID").otherwise("ASK").alias("side"), price.alias("price"), F.when(F.col("event_id") % 10 == 0, 0).otherwise(F.col("qty")).cast("long").alias("new_quantity"))


def snapshots(t: DataFrame) -> DataFrame:
    """Sign-ups are snapshots of five levels a side."""
    lv = lambda base, sign: F.expr(f"transform(sequence(0, 4), k -> named_struct('price', {base} {sign} k * 2, 'quantity', (event_id % 7 + 1 + k) * 100))")
    return t.filter("kind = 'signup'").select("event_id", "symbol", "origin_time", "update_id", F.lit("BOOK_SNAPSHOT").alias("event_type"), lv("9999L", "-").alias("bids"), lv("10001L", "+").alias("asks"))


def levels(s: DataFrame) -> DataFrame:
    """Snapshots as one row a level: symbol, snap_id, side, price, quantity."""
    side = lambda c, n: s.select("symbol", F.col("update_id").alias("snap_id"), F.lit(n).alias("side"), F.inline(c))
    return side("bids", "BID").unionByName(side("asks", "ASK"))


def ranges(t: DataFrame) -> DataFrame:
    """Updates with first and last id of each symbol in arrival order; a prime pattern makes gaps and disorder."""
    return t.select("symbol", "event_id", F.col("event_id").alias("seq"), (F.col("event_id") * 3 + F.when(F.col("event_id") % 11 == 0, 2).otherwise(0) - F.when(F.col("event_id") % 13 == 0, 4).otherwise(0)).alias("U"), (F.col("event_id") * 3 + 11).alias("u_last"))


def messages(t: DataFrame) -> DataFrame:
    """Captured messages with JSON text, as a capture process writes them."""
    trade = F.format_string('{"e":"trade","E":%d,"t":%d,"p":"%d.5","q":"%d","T":%d,"m":true}', F.expr("origin_time div 1000000"), "event_id", F.lit(9990) + F.col("event_id") % 21, "qty", F.expr("origin_time div 1000000"))
    depth = F.format_string('{"e":"depthUpdate","E":%d,"U":%d,"u":%d,"b":[["%d","1.0"]],"a":[]}', F.expr("origin_time div 1000000"), F.col("event_id") * 3, F.col("event_id") * 3 + 2, F.lit(9980) + F.col("event_id") % 20)
    is_trade = F.col("kind").isin("purchase", "click")
    return t.select((F.col("origin_time") - F.when(F.col("event_id") % 17 == 0, 600_000_000_000).otherwise(0)).alias("capture_ns"), F.concat(F.lower("symbol"), F.when(is_trade, "@trade").otherwise("@depth@100ms")).alias("stream"), F.when(is_trade, trade).otherwise(depth).alias("data"), "event_id")


def texts(t: DataFrame) -> DataFrame:
    """Origin times as text, some of them null, zero, future or broken."""
    k = F.col("event_id") % 20
    text = F.when(k == 0, F.lit(None)).when(k == 1, "0").when(k == 2, "").when(k == 3, "not a date").when(k == 4, "2031-01-01 00:00:00").when(k == 5, "-5").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return t.select("event_id", text.cast("string").alias("origin_time"))


#: DuckDB SQL of the same views.
SQL = """
with t as (select event_id, 'S' || (user_id % 4) as symbol, epoch_us(ts) * 1000 as origin_time, event_id as update_id, event_type as kind, cast(round(value * 100) as bigint) as qty, ts, user_id from events),
trades as (select event_id, symbol, origin_time, update_id, 'TRADE' as event_type, event_id as trade_id, 9990 + (event_id * 37) % 21 as price, qty as quantity, case when kind = 'purchase' then 'BUY' else 'SELL' end as side from t where kind in ('purchase', 'click')),
deltas as (select event_id, symbol, origin_time, update_id, 'BOOK_DELTA' as event_type, case when kind = 'view' then 'BID' else 'ASK' end as side,
  case when kind = 'view' then 9980 + (event_id * 37) % 20 else 10001 + (event_id * 37) % 20 end as price, case when event_id % 10 = 0 then 0 else qty end as new_quantity from t where kind in ('view', 'error')),
snaps as (select event_id, symbol, origin_time, update_id from t where kind = 'signup'),
levels as (select symbol, update_id as snap_id, s.side, case s.side when 'BID' then 9999 - k * 2 else 10001 + k * 2 end as price, (event_id % 7 + 1 + k) * 100 as quantity from snaps, (values ('BID'), ('ASK')) s(side), range(5) r(k)),
unified as (select event_id, symbol, origin_time, update_id, event_type, trade_id, price, quantity, side, null::bigint as new_quantity from trades union all select event_id, symbol, origin_time, update_id, event_type, null, price, null, side, new_quantity from deltas
  union all select event_id, symbol, origin_time, update_id, 'BOOK_SNAPSHOT', null, null, null, null, null from snaps),
gapped as (select *, update_id - (lag(update_id) over (partition by symbol order by update_id) + 1) as gap, lag(update_id) over (partition by symbol order by update_id) + 1 as expected_id from deltas),
ranges as (select symbol, event_id as seq, event_id * 3 + case when event_id % 11 = 0 then 2 else 0 end - case when event_id % 13 = 0 then 4 else 0 end as u0, event_id * 3 + 11 as u1 from t),
texts as (select event_id, case event_id % 20 when 0 then null when 1 then '0' when 2 then '' when 3 then 'not a date' when 4 then '2031-01-01 00:00:00' when 5 then '-5' else strftime(ts, '%Y-%m-%d %H:%M:%S') end as origin_time from t),
captured as (select event_id, origin_time - case when event_id % 17 = 0 then 600000000000 else 0 end as capture_ns, lower(symbol) || case when kind in ('purchase', 'click') then '@trade' else '@depth@100ms' end as stream, kind, qty from t),
live as (select symbol, side, price, new_quantity as quantity, update_id as b, lead(update_id) over (partition by symbol, side, price order by update_id) as e from deltas)
"""
