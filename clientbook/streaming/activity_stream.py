"""Events into daily activity and into a published book, exactly once and in any order.

Late events are counted as long as they are no later than the lateness that is asked for; an event that is
delivered twice within it counts once. Aggregates are written in update mode: a batch holds the new totals of
the days it touches, so open days are served as well and nothing waits for the watermark. State is dropped as the
watermark passes a day.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clientbook.config import PortfolioConfig
from clientbook.operators import daily
from clientbook.plans.portfolio import Portfolio, scored_book
from clientbook.sources import events as source
from clientbook.streaming.batch_table import BatchTable


def open_events(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The events of a folder that files are added to."""
    reader = spark.readStream.schema(source.COLUMNS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def once(events: DataFrame, lateness: str) -> DataFrame:
    """Each event once, with a watermark ``lateness`` behind the latest event."""
    timed = events.withColumn("event_time", source.event_time(F.col("ts")))
    return timed.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(["event_id"])


def daily_updates(events: DataFrame, lateness: str) -> DataFrame:
    """Rows of :func:`daily.roll_up` for the days and customers of a batch, with their totals so far."""
    facts = source.transactions(once(events, lateness))
    return (
        facts.groupBy(F.window("event_time", "1 day"), "customer_id", "channel")
        .agg(
            F.count(F.lit(1)).alias("txns"),
            F.sum("fee_pennies").alias("fee_pennies"),
            F.sum("value_pennies").alias("value_pennies"),
        )
        .select(
            "customer_id",
            F.lit(None).cast("string").alias("product_id"),
            "channel",
            source.day_of(F.col("window.start")).alias("day"),
            *daily.AMOUNTS,
        )
    )


def run_available(updates: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Process what is there and stop; the next run goes on from the checkpoint."""
    query = (
        updates.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def too_late(query: StreamingQuery) -> int:
    """Rows a finished run left out because they came later than the lateness allows."""
    return sum(
        int(operator["numRowsDroppedByWatermark"])
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def daily_table(spark: SparkSession, path: str, updates: DataFrame) -> BatchTable:
    return BatchTable(spark, path, updates.schema, daily.KEYS)


class StreamedBook:
    """The scored book of a snapshot date, kept up to date by a stream of events.

    Each batch stores its daily rows, and then the book rows of the customers it touches, worked out from
    their daily rows alone. Both tables are keyed by the batch, so a batch can be repeated at any point.
    """

    def __init__(self, customers: DataFrame, root: str, cfg: PortfolioConfig, updates: DataFrame):
        self.spark, self.customers, self.cfg = customers.sparkSession, customers, cfg
        self.days = daily_table(self.spark, os.path.join(root, "days"), updates)
        empty = scored_book(customers, daily.measures(self.days.current(), cfg), cfg)
        self.book = BatchTable(self.spark, os.path.join(root, "book"), empty.schema, ("customer_id",))
        self._empty = empty

    def start(self) -> None:
        """Every listed customer has a row before the first event arrives."""
        self.book.write(self._empty, -1)

    def write(self, updates: DataFrame, batch_id: int) -> None:
        self.days.write(updates, batch_id)
        written = self.days.of_batch(batch_id)
        if written.isEmpty():  # the batches that only move the watermark
            return
        touched = written.select("customer_id").distinct()
        facts = self.days.current().join(touched, "customer_id", "left_semi")
        listed = self.customers.join(touched, "customer_id", "left_semi")
        self.book.write(scored_book(listed, daily.measures(facts, self.cfg), self.cfg), batch_id)

    def served(self) -> Portfolio:
        return Portfolio.from_book(self.book.current(), self.cfg)
