"""Structured Streaming forms: gap detection and book replay with keyed state, watermarked windows and deduplication."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidebook.functions import session
from tidebook.operators import book as B
from tidebook.sources import sinks


def source(spark: SparkSession, path: str, schema, files: int = 1) -> DataFrame:
    """A stream of Parquet files, so many a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


FEED = "symbol string, update_id long, expected_id long, gap long, after_gap boolean, needs_recovery boolean, late boolean, received long, gaps long, largest_gap long"


def feed(deltas: DataFrame, recovery: int = 1000) -> DataFrame:
    """Each delta with what the feed knows by then: expected id, gap, recovery signal, and totals of its symbol.

    State is the symbol's last id and totals; it carries over micro-batches and restarts. Ids
    are ordered within a micro-batch. An id not beyond the last is late and moves nothing; it has
    no gap, unless it repeats the last id (gap -1). A null id is late. Where a boolean column
    ``reset`` is true, the sequence begins anew with that row.
    """
    has_reset = "reset" in deltas.columns

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, received, gaps_, largest = state.get if state.exists else (None, 0, 0, 0)
        out = []
        for n, anew in sorted(((n, bool(r)) for part in parts for n, r in zip(part["update_id"], part["reset"] if has_reset else [False] * len(part), strict=True)), key=lambda x: (pd.notna(x[0]), x[0] if pd.notna(x[0]) else 0)):
            received += 1
            if pd.isna(n):
                out.append((key[0], None, None, None, False, False, True, received, gaps_, largest))
                continue
            n, before = int(n), None if anew else last
            expected = None if before is None else before + 1
            late = before is not None and n <= before
            gap = None if expected is None or n < before else n - expected
            if gap is not None and gap > 0:
                gaps_, largest = gaps_ + 1, max(largest, gap)
            out.append((key[0], n, expected, gap, bool(gap), gap is not None and gap > recovery, late, received, gaps_, largest))
            last = n if anew or last is None else max(last, n)
        state.update((last, received, gaps_, largest))
        frame = pd.DataFrame(out, columns=[c.split()[0] for c in FEED.split(", ")])
        yield frame.astype({c: "Int64" for c in ("update_id", "expected_id", "gap")})

    session.importable(deltas.sparkSession)
    rows = deltas.select("symbol", "update_id", *(["reset"] if has_reset else []))
    return rows.groupBy("symbol").applyInPandasWithState(step, FEED, "last long, received long, gaps long, largest long", "append", GroupStateTimeout.NoTimeout)


def gaps(deltas: DataFrame) -> DataFrame:
    """Gaps of each symbol across micro-batches: symbol, expected_id, actual_id, gap_size; late ids have none, a repeated id has -1."""
    return feed(deltas).filter("after_gap").select("symbol", "expected_id", F.col("update_id").alias("actual_id"), F.col("gap").alias("gap_size"))


_BOOK = "started boolean, bid_prices array<long>, bid_quantities array<long>, ask_prices array<long>, ask_quantities array<long>"


def _stored(book: B.Book) -> tuple:
    """A book as typed state, which later versions of the code can read."""
    return (book.started, *[x for side in (book.bids, book.asks) for x in ([int(p) for p in side.quantity], [int(q) for q in side.quantity.values()])])


def _restored(book: B.Book, stored: tuple) -> B.Book:
    book.started = bool(stored[0])
    for side, prices, quantities in ((book.bids, stored[1], stored[2]), (book.asks, stored[3], stored[4])):
        side.load([(int(p), int(q)) for p, q in zip(prices, quantities, strict=True)])
    return book


def replay(events: DataFrame, depth: int = B.DEPTH, threshold: float = 0.05) -> DataFrame:
    """The book after each event; state is the book's levels. Events of a micro-batch are ordered by (origin_time, update_id, event_id)."""

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        book = B.Book(depth, threshold=threshold)
        if state.exists:
            _restored(book, state.get)
        rows = pd.concat(parts).sort_values(["origin_time", "update_id", "event_id"], na_position="first", kind="stable")
        yield B.replayed_rows(book, rows)
        state.update(_stored(book))

    session.importable(events.sparkSession)
    return events.groupBy("symbol").applyInPandasWithState(step, B.REPLAYED, _BOOK, "append", GroupStateTimeout.NoTimeout)


def manifest_sink(events: DataFrame, path: str, manifest: str, checkpoint: str):
    """Valid events of each micro-batch by hour, and their manifest rows appended once a batch; a repeated batch repeats its rows under the same batch number."""

    def batch(part: DataFrame, number: int) -> None:
        sinks.write_events(part, path)
        sinks.append_manifest(part, manifest, number)

    return events.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(events: DataFrame, time: str, width: str, late: str) -> DataFrame:
    """Events of each symbol and type in tumbling windows; what is later than ``late`` is dropped by the watermark."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), "symbol", "event_type").count()


def distinct_events(events: DataFrame, time: str, late: str, keys: list[str]) -> DataFrame:
    """Each event once within the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def sink(df: DataFrame, path: str, checkpoint: str):
    """Write what is available as Parquet and end; offsets and state stay in ``checkpoint``, so a restart goes on from there."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
