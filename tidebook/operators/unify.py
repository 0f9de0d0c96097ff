"""Normalise trades, snapshots and deltas and merge them into one ordered stream of events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.functions import scalars as S
from tidebook.operators import ranges

#: Order of sources whose events fall on one nanosecond.
RANK = {"TRADE": 0, "BOOK_SNAPSHOT": 1, "BOOK_DELTA": 2}


def unioned(*parts: DataFrame) -> DataFrame:
    """All rows of all parts; columns that a part lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def order_key(time: str = "origin_time") -> list[Column]:
    """A total order of events: time, update id (nulls first), source, identity."""
    rank = F.coalesce(*[F.when(F.col("event_type") == k, v) for k, v in RANK.items()], F.lit(9))
    return [F.col(time).asc_nulls_first(), F.col("update_id").asc_nulls_first(), rank.asc(), F.col("event_id").asc()]


def placed(events: DataFrame, key: str | None = None, time: str = "origin_time", width: int = 3_600_000_000_000) -> DataFrame:
    """Events with their ``place`` (from 1) in the total order, of each ``key`` or of all events.

    Each stretch of ``width`` nanoseconds is numbered on its own and continues from the
    count of those before, so neither a busy symbol nor the global order binds one task.
    """
    return ranges.placed(events, order_key(time), f"`{time}` div {width}", key)


def merged(parts: list[DataFrame], time: str = "origin_time", files: int = 64) -> DataFrame:
    """Sorted parts as one globally sorted table: ranges of time, each sorted, in the order of the output's partitions."""
    every = unioned(*parts)
    return every.repartitionByRange(files, *order_key(time)).sortWithinPartitions(*order_key(time))


def normalised(events: DataFrame) -> DataFrame:
    """The unified fields of mixed events, each only for its own type; unknown types keep the core fields."""
    c = events.columns
    kind = F.col("event_type") if "event_type" in c else S.event_label(c)
    on = lambda name, v: F.when(kind == name, v)
    dec = lambda names: S.to_decimal(S.first_of(names, c).cast("string"))
    side = F.col("side") if "side" in c else F.lit(None).cast("string")
    return events.select(
        *[F.col(x) for x in c if x in ("event_id", "symbol")],
        S.event_nanos(c).alias("event_timestamp"), kind.alias("event_type"), S.first_of(["update_id"], c).cast("long").alias("update_id"),
        on("TRADE", S.first_of(["trade_id", "id", "exec_id"], c).cast("long")).alias("trade_id"),
        on("TRADE", dec(["trade_price", "price", "exec_price"])).alias("trade_price"),
        on("TRADE", dec(["trade_quantity", "quantity", "exec_quantity", "amount"])).alias("trade_quantity"),
        on("TRADE", S.trade_side(side)).alias("trade_side"),
        on("BOOK_SNAPSHOT", S.first_of(["bids"], c)).alias("bids"), on("BOOK_SNAPSHOT", S.first_of(["asks"], c)).alias("asks"), on("BOOK_SNAPSHOT", F.lit(True)).alias("is_snapshot"),
        on("BOOK_DELTA", S.book_side(side)).alias("delta_side"), on("BOOK_DELTA", dec(["delta_price", "price"])).alias("delta_price"),
        on("BOOK_DELTA", dec(["delta_quantity", "new_quantity", "quantity"])).alias("delta_quantity"),
    )


def problems(events: DataFrame) -> DataFrame:
    """Unified events with the first reason why an event is invalid; null for valid ones."""
    positive = lambda c: F.coalesce(F.col(c) > 0, F.lit(False))
    t = F.col("event_type")
    reason = (
        F.when(F.col("event_timestamp").isNull(), "no_timestamp").when(t.isNull() | ~t.isin(*RANK), "unknown_type")
        .when((t == "TRADE") & ~positive("trade_price"), "trade_price").when((t == "TRADE") & ~positive("trade_quantity"), "trade_quantity").when((t == "TRADE") & F.col("trade_side").isNull(), "trade_side")
        .when((t == "BOOK_DELTA") & F.col("delta_side").isNull(), "delta_side").when((t == "BOOK_DELTA") & ~positive("delta_price"), "delta_price")
        .when((t == "BOOK_DELTA") & ~F.coalesce(F.col("delta_quantity") >= 0, F.lit(False)), "delta_quantity")
        .when((t == "BOOK_SNAPSHOT") & (F.col("bids").isNull() | F.col("asks").isNull()), "levels")
    )
    return events.withColumn("reason", reason)


def span(events: DataFrame, time: str = "origin_time") -> DataFrame:
    """Events, first and last time, seconds between them and events a second."""
    g = events.agg(F.count("*").alias("events"), F.min(time).alias("first"), F.max(time).alias("last"))
    sec = (F.col("last") - F.col("first")) / F.lit(1e9)
    return g.withColumn("seconds", F.round(sec, 6)).withColumn("events_per_second", F.round(F.when(sec > 0, F.col("events") / sec), 9))


def routed(events: DataFrame, config: DataFrame) -> DataFrame:
    """Per symbol: its worker by ``config`` (symbol, worker), events routed to it, and events dropped because no worker takes the symbol."""
    g = events.groupBy("symbol").agg(F.count("*").alias("n"))
    j = g.join(F.broadcast(config), "symbol", "left")
    return j.select("symbol", "worker", F.when(F.col("worker").isNotNull(), F.col("n")).otherwise(0).alias("routed"), F.when(F.col("worker").isNull(), F.col("n")).otherwise(0).alias("dropped"))
