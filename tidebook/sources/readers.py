"""Scans of trades, snapshots, deltas, captured messages and manifests; filters and columns reach the Parquet scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.functions import scalars as S

#: Columns that a file of each kind must have.
REQUIRED = {
    "TRADE": ("origin_time", "price", "quantity", "side"),
    "BOOK_SNAPSHOT": ("origin_time", "bids", "asks", "update_id"),
    "BOOK_DELTA": ("origin_time", "update_id", "side", "price", "new_quantity"),
}


def checked(df: DataFrame, kind: str) -> DataFrame:
    """``df``, or a ValueError that names the missing columns."""
    if missing := [c for c in REQUIRED[kind] if c not in df.columns]:
        raise ValueError(f"{kind}: missing columns {missing}")
    return df


def events(spark: SparkSession, path: str | list[str], kind: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet files of one kind, recursively, with event_type; amounts become decimals."""
    paths = [path] if isinstance(path, str) else path
    df = checked(vendor(spark.read.option("recursiveFileLookup", "true").parquet(*paths), kind), kind)
    for c in ("price", "quantity", "new_quantity"):
        if c in df.columns:
            df = df.withColumn(c, F.col(c).cast(S.DECIMAL))
    df = df.withColumn("event_type", F.lit(kind))
    return df.select(*columns) if columns else df


def vendor(df: DataFrame, kind: str) -> DataFrame:
    """Known vendor spellings under the engine's names: side_is_bid, size, sequence_number and wide level columns."""
    c = df.columns
    if kind == "BOOK_DELTA":
        if "side_is_bid" in c:
            df = df.withColumn("side", F.when(F.col("side_is_bid"), "BID").otherwise("ASK")).drop("side_is_bid")
        if "new_quantity" not in c and "size" in c:
            df = df.withColumnRenamed("size", "new_quantity")
    if kind in ("BOOK_DELTA", "BOOK_SNAPSHOT") and "update_id" not in c and "sequence_number" in c:
        df = df.withColumnRenamed("sequence_number", "update_id")
    if kind == "BOOK_SNAPSHOT" and "bids" not in c and any(x.startswith("bid_") for x in c):
        wide = [x for x in c if x.startswith(("bid_", "ask_"))]
        df = df.withColumn("bids", S.wide_levels(c, "bid")).withColumn("asks", S.wide_levels(c, "ask")).drop(*wide)
    return df


def kind_of(columns: list[str]) -> str:
    """The kind of a file by its columns."""
    c = set(columns)
    if {"bids", "asks"} <= c or any(x.startswith(("bid_0_", "bid_price_0")) for x in c):
        return "BOOK_SNAPSHOT"
    if "new_quantity" in c or "side_is_bid" in c:
        return "BOOK_DELTA"
    return "TRADE"


def table(spark: SparkSession, path: str, symbol: str | None = None, dates: tuple[str, str] | None = None) -> DataFrame:
    """A CSV or Parquet table, of one symbol and of an inclusive range of origin_time texts if asked."""
    df = spark.read.option("header", "true").csv(path) if path.endswith((".csv", ".csv.gz")) else spark.read.parquet(path)
    return selected(df, symbol, dates)


def selected(df: DataFrame, symbol: str | None = None, dates: tuple[str, str] | None = None) -> DataFrame:
    """Rows of a symbol and a range of origin_time; a column that doesn't exist filters nothing."""
    if symbol is not None and "symbol" in df.columns:
        df = df.filter(F.col("symbol") == symbol)
    if dates and "origin_time" in df.columns:
        df = df.filter(F.col("origin_time").between(*dates))
    return df


def tables(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several Parquet files as one; unreadable ones are skipped, an error if there are none."""
    good = []
    for p in paths:
        try:
            good.append(spark.read.option("ignoreCorruptFiles", "true").parquet(p))
        except Exception as e:  # noqa: BLE001
            print(f"skipped {p}: {type(e).__name__}")
    if not good:
        raise ValueError("no file could be read")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), good)


def stacked(*parts: DataFrame) -> DataFrame:
    """Rows of tables with the same columns and types, strictly: a ValueError names the first difference."""
    for p in parts[1:]:
        if dict(p.dtypes) != dict(parts[0].dtypes):
            raise ValueError(f"columns differ: {sorted(set(parts[0].dtypes) ^ set(p.dtypes))}")
    return reduce(DataFrame.unionByName, parts)


def listed(spark: SparkSession, path: str) -> list[str]:
    """Data files to read: the lines of a manifest file (.txt), one file, or all Parquet files below a folder, sorted."""
    if path.endswith(".txt"):
        return [r[0].strip() for r in spark.read.text(path).collect() if r[0].strip()]  # one line a file
    if path.endswith(".parquet"):
        return [path]
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path")
    return sorted(r[0] for r in found.collect())


def peek(spark: SparkSession, path: str, n: int = 10) -> tuple[list[tuple[str, str]], list]:
    """Column types and the first ``n`` rows of a Parquet table."""
    df = spark.read.parquet(path)
    return df.dtypes, df.limit(n).collect()


def level_count(columns: list[str], side: str) -> int:
    """How many levels of a side a wide book table has."""
    return sum(1 for i in range(len(columns)) if any(a in columns and b in columns for a, b in ((f"{side}_{i}_price", f"{side}_{i}_size"), (f"{side}_{i}_price", f"{side}_{i}_amount"), (f"{side}_price_{i}", f"{side}_quantity_{i}"))))


def message_statistics(df: DataFrame) -> DataFrame:
    """One row a stream type with its messages and those whose data are no JSON object; the row without a type is the total."""
    broken = F.coalesce(F.get_json_object("data", "$").isNull() | ~F.col("data").startswith("{"), F.lit(True))
    rolled = df.select(S.stream_type(F.col("stream")).alias("stream_type"), broken.alias("broken")).rollup("stream_type")
    return rolled.agg(F.count("*").alias("messages"), F.count_if("broken").alias("errors"), F.grouping("stream_type").alias("total")).select("stream_type", "messages", "errors", (F.col("total") == 1).alias("is_total"))


def messages(spark: SparkSession, path: str, keep: Column | None = None) -> DataFrame:
    """Captured messages (JSON lines, plain or gzip): capture_ns, stream, data as its JSON text; broken lines are left out."""
    schema = "capture_ns long, stream string, data string, _corrupt string"
    df = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    df = df.filter("_corrupt is null and stream is not null").drop("_corrupt")
    return df.filter(keep) if keep is not None else df


def in_time(df: DataFrame, begin: int | None = None, end: int | None = None) -> DataFrame:
    """Messages captured within bounds; a bound of 0 or None holds nothing back."""
    df = df.filter(F.col("capture_ns") >= begin) if begin else df
    return df.filter(F.col("capture_ns") <= end) if end else df


def _json(path: str) -> Column:
    return F.get_json_object("data", path)


def trade_messages(df: DataFrame) -> DataFrame:
    """Trades of captured messages, typed; keys that differ by case are told apart."""
    t = df.filter(F.col("stream").contains("@trade"))
    return t.select(
        "capture_ns", S.stream_symbol(F.col("stream")).alias("symbol"), _json("$.t").try_cast("long").alias("trade_id"), _json("$.p").try_cast(S.DECIMAL).alias("price"), _json("$.q").try_cast(S.DECIMAL).alias("quantity"),
        _json("$.b").try_cast("long").alias("buyer_order_id"), _json("$.a").try_cast("long").alias("seller_order_id"), _json("$.T").try_cast("long").alias("trade_time"), _json("$.m").try_cast("boolean").alias("is_buyer_maker"),
    )


def depth_messages(df: DataFrame) -> DataFrame:
    """Depth updates of captured messages: ids U and u, event time, levels as arrays of texts."""
    d = df.filter(F.col("stream").contains("@depth"))
    lv = lambda p: F.from_json(_json(p), "array<array<string>>")
    # columns that differ by case only would clash, so the ids get names
    return d.select("capture_ns", S.stream_symbol(F.col("stream")).alias("symbol"), _json("$.E").try_cast("long").alias("event_time"), _json("$.U").try_cast("long").alias("first_id"), _json("$.u").try_cast("long").alias("final_id"), lv("$.b").alias("bids"), lv("$.a").alias("asks"))


def trade_sizes(df: DataFrame) -> DataFrame:
    return trade_messages(df).filter("quantity > 0").select("capture_ns", "symbol", F.col("quantity").cast("double").alias("size"))


def prices(df: DataFrame) -> DataFrame:
    """Trade prices and best bids, whichever a message has."""
    p = F.coalesce(_json("$.p").try_cast("double"), F.get(F.get(F.from_json(_json("$.b"), "array<array<string>>"), F.lit(0)), F.lit(0)).try_cast("double"))
    return df.select("capture_ns", S.stream_symbol(F.col("stream")).alias("symbol"), p.alias("price")).filter("price is not null")


def type_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(S.stream_type(F.col("stream")).alias("stream_type")).agg(F.count("*").alias("n"))


def download_tasks(spark: SparkSession, start: str, end: str, days: int, symbols: list[str], kinds: list[str]) -> DataFrame:
    """Date chunks of at most ``days`` days for each symbol and kind."""
    s, k = (spark.createDataFrame([(x,) for x in v], "v string") for v in (symbols, kinds))
    d = spark.sql(f"select explode(sequence(date'{start}', date'{end}', interval {days} days)) as first_day")
    d = d.withColumn("last_day", F.least(F.date_add("first_day", days - 1), F.lit(end).cast("date")))
    return d.join(F.broadcast(s.select(F.col("v").alias("symbol")))).join(F.broadcast(k.select(F.col("v").alias("data_type")))).select("symbol", "data_type", "first_day", "last_day")


def synthetic_market(spark: SparkSession, n: int, every: int = 1000) -> tuple[DataFrame, DataFrame]:
    """Deterministic deltas and snapshots of ten levels a side, one snapshot after ``every`` deltas."""
    d = synthetic_deltas(spark, n)
    side = lambda sign: F.transform(F.sequence(F.lit(0), F.lit(9)), lambda k: F.struct((45_000 + sign * (k + 1)).cast("long").alias("price"), ((F.col("update_id") + k) % 1000 + 1).alias("quantity")))
    s = d.filter(F.col("update_id") % every == 0).select("update_id", "origin_time", side(-1).alias("bids"), side(1).alias("asks"))
    return d, s


def synthetic_deltas(spark: SparkSession, n: int) -> DataFrame:
    """Deterministic deltas: a removal in ten, five gaps of 2 to 20 ids."""
    gap = F.expr(f"cast(id * 6 div {max(n, 1)} as long)")
    return spark.range(n).select(
        (F.col("id") + 1 + gap * (gap + 3) / 2).cast("long").alias("update_id"), (F.lit(1_700_000_000_000_000_000) + F.col("id") * 1_000_000).alias("origin_time"), F.when(F.col("id") % 2 == 0, "BID").otherwise("ASK").alias("side"),
        (44_000 + (F.col("id") * 37) % 2000).alias("price"), F.when(F.col("id") % 10 == 0, 0).otherwise((F.col("id") * 13) % 1000).cast("long").alias("new_quantity"),
    )
