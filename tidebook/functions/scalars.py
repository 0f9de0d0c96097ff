"""Column expressions for prices, sides, timestamps, levels and paths; all stay inside the JVM.

Prices and quantities are decimals at rest and longs scaled by 1e8 where they are
computed with. Timestamps are nanoseconds since the epoch in a long.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 100_000_000
DECIMAL = "decimal(38,18)"


def to_scaled(value: Column) -> Column:
    """A double as a long scaled by 1e8, rounded half to even."""
    return F.bround(value * F.lit(float(SCALE))).cast("long")


def from_scaled(value: Column) -> Column:
    return value / F.lit(float(SCALE))


def scaled_to_decimal(value: Column) -> Column:
    """A scaled long as an exact decimal."""
    return (value.cast("decimal(20,0)") / F.lit(SCALE).cast("decimal(10,0)")).cast(DECIMAL)


def decimal_to_scaled(value: Column) -> Column:
    """A decimal as a scaled long; digits beyond the eighth are rounded half to even."""
    return (F.bround(value.cast(DECIMAL), 8).cast("decimal(28,8)") * F.lit(SCALE).cast("decimal(10,0)")).cast("long")


def mid_price(bid: Column, ask: Column) -> Column:
    """Floor of the mean of two longs (rounds down for negative sums too); null if a side is missing."""
    return F.shiftright((bid + ask).cast("long"), 1)


def spread(bid: Column, ask: Column) -> Column:
    """Ask minus bid; negative for a crossed book, null if a side is missing."""
    return ask - bid


def to_pips(value: Column, multiplier: Column) -> Column:
    """A decimal price or quantity as whole pips, rounded half up."""
    return F.round(value.cast("decimal(20,10)") * multiplier.cast("decimal(12,0)"), 0).cast("long")


def to_decimal(text: Column) -> Column:
    """A string as a decimal: null stays null, what is no number is 0."""
    return F.when(text.isNotNull(), F.coalesce(text.try_cast(DECIMAL), F.lit(0).cast(DECIMAL)))


def first_of(columns: list[str], present: list[str]) -> Column:
    """The first non-null of those columns that exist."""
    have = [F.col(c) for c in columns if c in present]
    return F.coalesce(*have) if have else F.lit(None)


def event_nanos(columns: list[str]) -> Column:
    """Event time: the first non-null of origin_time, event_timestamp and timestamp; below 1e12 it counts milliseconds."""
    t = first_of(["origin_time", "event_timestamp", "timestamp"], columns).cast("long")
    return F.when(t < 1_000_000_000_000, t * 1_000_000).otherwise(t)


#: Spellings of sides.
BUYS, SELLS = ("BUY", "B", "BID"), ("SELL", "S", "ASK", "OFFER")
BIDS, ASKS = ("BID", "B"), ("ASK", "A", "OFFER")


def trade_side(side: Column) -> Column:
    """BUY or SELL; null for anything else."""
    s = F.upper(side)
    return F.when(s.isin(*BUYS), "BUY").when(s.isin(*SELLS), "SELL")


def book_side(side: Column) -> Column:
    """BID or ASK; null for anything else."""
    s = F.upper(side)
    return F.when(s.isin(*BIDS), "BID").when(s.isin(*ASKS), "ASK")


def event_label(columns: list[str]) -> Column:
    """BOOK_SNAPSHOT before TRADE before BOOK_DELTA, by which fields are set."""
    have = lambda c: F.col(c).isNotNull() if c in columns else F.lit(False)
    snap = F.coalesce(F.col("is_snapshot"), F.lit(False)) if "is_snapshot" in columns else have("bids") & have("asks")
    return F.when(snap, "BOOK_SNAPSHOT").when(have("trade_id") | have("trade_price"), "TRADE").otherwise("BOOK_DELTA")


def levels(raw: Column) -> Column:
    """Levels given as arrays [price, quantity] in one element type become structs."""
    return F.transform(raw, lambda x: F.struct(F.get(x, F.lit(0)).alias("price"), F.get(x, F.lit(1)).alias("quantity")))


def levels_of_maps(raw: Column) -> Column:
    """Levels given as maps with price or p and quantity, q or size become structs."""
    first = lambda x, *names: F.coalesce(*[F.try_element_at(x, F.lit(n)) for n in names])
    return F.transform(raw, lambda x: F.struct(first(x, "price", "p").alias("price"), first(x, "quantity", "q", "size").alias("quantity")))


def epoch_timestamp(nanos: Column) -> Column:
    """A time in nanoseconds as a timestamp, to the microsecond (rounded down)."""
    return F.timestamp_micros(((nanos - F.pmod(nanos, F.lit(1000))) / F.lit(1000)).cast("long"))


def wide_levels(columns: list[str], side: str) -> Column:
    """Levels from wide columns, in any of the spellings bid_0_price/_size, bid_0_price/_amount and bid_price_0/bid_quantity_0."""
    out = []
    for i in range(len(columns)):
        for price, size in ((f"{side}_{i}_price", f"{side}_{i}_size"), (f"{side}_{i}_price", f"{side}_{i}_amount"), (f"{side}_price_{i}", f"{side}_quantity_{i}")):
            if price in columns and size in columns:
                out.append(F.struct(F.col(price).cast("double").alias("price"), F.col(size).cast("double").alias("quantity")))
                break
    return F.filter(F.array(*out), lambda x: x["price"].isNotNull()) if out else F.expr("cast(array() as array<struct<price:double,quantity:double>>)")


def updated_levels(base: Column, updates: Column) -> Column:
    """Levels after updates (quantity 0 deletes, the last update of a price counts), by ascending price."""
    keep = F.filter(base, lambda b: ~F.exists(updates, lambda u: u["price"] == b["price"]))
    n = F.size(updates)
    last = F.filter(F.transform(updates, lambda u, i: F.struct(u["price"].alias("price"), u["quantity"].alias("quantity"), i.alias("i"))), lambda u: ~F.exists(F.slice(updates, u["i"] + 2, F.greatest(n, F.lit(1))), lambda v: v["price"] == u["price"]) & (u["quantity"] != 0))
    new = F.transform(last, lambda u: F.struct(u["price"].alias("price"), u["quantity"].alias("quantity")))
    return F.array_sort(F.concat(keep, new))


def gap_bucket(gap: Column) -> Column:
    """Size class of a sequence gap."""
    return F.when(gap <= 10, "1-10").when(gap <= 100, "11-100").when(gap <= 1000, "101-1000").otherwise("1000+")


def stream_symbol(stream: Column) -> Column:
    return F.upper(F.substring_index(stream, "@", 1))


def stream_type(stream: Column) -> Column:
    """Everything after the first @."""
    return F.when(F.contains(stream, F.lit("@")), F.substr(stream, F.instr(stream, "@") + F.lit(1)))


def relative_difference(a: Column, b: Column) -> Column:
    return F.abs(a - b) / F.greatest(F.abs(a), F.lit(1e-10))


def path_date(path: Column) -> Column:
    """Date in a path, as YYYY-MM-DD or YYYY/MM/DD; null without one."""
    parts = [F.regexp_extract(path, r"(\d{4})[-/](\d{2})[-/](\d{2})", k) for k in (1, 2, 3)]
    return F.when(parts[0] != "", F.concat_ws("-", *parts).try_cast("date"))


def hour_path(nanos: Column) -> Column:
    """UTC hour of a time in nanoseconds, as YYYY/MM/DD/HH."""
    day, hour_ = F.lit(86_400_000_000_000), F.lit(3_600_000_000_000)
    within = F.pmod(nanos.cast("long"), day)
    # multiples of a day and remainders below one are exact as doubles; nanoseconds since the epoch are not
    days = F.date_add(F.lit("1970-01-01").cast("date"), ((nanos - within) / day).cast("int"))
    hour = ((within - F.pmod(within, hour_)) / hour_).cast("int")
    return F.concat(F.date_format(days, "yyyy/MM/dd/"), F.lpad(hour.cast("string"), 2, "0"))


def route(symbol: Column, workers: int) -> Column:
    """Worker of a symbol: by its hash, so that a symbol's order holds."""
    return F.pmod(F.crc32(symbol.cast("binary")), F.lit(workers))
