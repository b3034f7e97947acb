"""Registered queries over the event stream.

The event table is landed the way a feed would deliver it: in slices by time of arrival, where every seventh
event is a day and a half late and every eleventh is delivered again a slice later. After each slice the stream
runs over what is new and stops, so each query also goes through its checkpoint several times.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientbook.config import EVENT_CONFIG
from clientbook.operators.staging import shared_folder
from clientbook.plans.portfolio import Portfolio
from clientbook.sources import events as source
from clientbook.streaming import activity_stream, cliff_stream
from clientbook.streaming.batch_table import BatchTable

SLICES = 2
DELAY_HOURS = 36
LATENESS = "15 days"
"""Covers a slice and the delay: nothing of the landed feed comes too late."""


def arrivals(events: DataFrame) -> DataFrame:
    """Events with ``arrival``: late ones after their time, some of them a second time."""
    draw = F.crc32(F.col("event_id").cast("string").cast("binary"))
    hours = F.when(draw % 7 == 0, DELAY_HOURS).otherwise(0)
    times = F.when(draw % 11 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        events.withColumn("again", F.explode(times))
        .withColumn("arrival", F.timestamp_add("HOUR", hours + F.col("again") * 24 * 7, F.col("ts")))
        .drop("again")
    )


def landed(events: DataFrame, path: str, slices: int = SLICES) -> Iterator[int]:
    """Write the next slice of arrivals into ``path``, and give its number, once per slice."""
    arriving = arrivals(events)
    first, last = arriving.agg(F.min("arrival"), F.max("arrival")).first()
    if first is None:
        arriving.drop("arrival").write.mode("append").parquet(path)
        yield 0
        return
    step = (last - first) / slices + dt.timedelta(microseconds=1)
    for i in range(slices):
        begin, end = (F.lit(str(first + n * step)).cast("timestamp_ntz") for n in (i, i + 1))
        mine = (F.col("arrival") >= begin) & (F.col("arrival") < end)
        arriving.filter(mine).drop("arrival").write.mode("append").parquet(path)
        yield i


def _folder(spark: SparkSession) -> str:
    return os.path.join(shared_folder(spark), f"stream-{uuid.uuid4().hex}")


def _streamed(
    spark: SparkSession,
    folder: str,
    build: Callable[[DataFrame], DataFrame],
    sink: Callable[[str, DataFrame], Callable[[DataFrame, int], None]],
) -> None:
    """Land the events slice by slice and run the stream after each."""
    root, write = _folder(spark), None
    feed = os.path.join(root, "feed")
    for _ in landed(source.read_events(spark, folder), feed):
        updates = build(activity_stream.open_events(spark, feed))
        write = write or sink(root, updates)
        activity_stream.run_available(updates, write, os.path.join(root, "checkpoint"))


def stream_daily_activity(spark: SparkSession, folder: str) -> DataFrame:
    """Daily activity per customer and channel, from the stream."""
    tables: list[BatchTable] = []

    def sink(root: str, updates: DataFrame):
        tables.append(activity_stream.daily_table(spark, os.path.join(root, "days"), updates))
        return tables[0].write

    _streamed(spark, folder, lambda events: activity_stream.daily_updates(events, LATENESS), sink)
    return tables[0].current().select("customer_id", "channel", "day", "txns", "fee_pennies")


def _streamed_book(spark: SparkSession, folder: str) -> Portfolio:
    books: list[activity_stream.StreamedBook] = []
    people = source.customers(source.read_events(spark, folder))

    def sink(root: str, updates: DataFrame):
        books.append(activity_stream.StreamedBook(people, root, EVENT_CONFIG, updates))
        books[0].start()
        return books[0].write

    _streamed(spark, folder, lambda events: activity_stream.daily_updates(events, LATENESS), sink)
    return books[0].served()


def stream_customer_360(spark: SparkSession, folder: str) -> DataFrame:
    """The customer fact of the book that the stream keeps."""
    return _streamed_book(spark, folder).customer_360()


def stream_activity_cliff(spark: SparkSession, folder: str) -> DataFrame:
    """Customers whose cliff alert fires on the last day, from sliding windows."""
    tables: list[BatchTable] = []

    def sink(root: str, updates: DataFrame):
        tables.append(BatchTable(spark, os.path.join(root, "cliffs"), updates.schema, cliff_stream.KEYS))
        return tables[0].write

    _streamed(spark, folder, lambda events: cliff_stream.cliff_updates(events, EVENT_CONFIG, LATENESS), sink)
    found = tables[0].current().filter(F.col("fires") & (F.col("snapshot_date") == F.lit(EVENT_CONFIG.snapshot_date)))
    return found.select("customer_id", "snapshot_date", "txn_count_90d", "txn_count_prior_90d", "txn_delta_pct")


QUERIES = {
    "stream_daily_activity": stream_daily_activity,
    "stream_customer_360": stream_customer_360,
    "stream_activity_cliff": stream_activity_cliff,
}
