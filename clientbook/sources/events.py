"""Binding of an event table to the customer and transaction frames.

An event is a transaction of its user: its type is the channel, its value the fee. Events have no product.
The same functions serve a table and a stream.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientbook.functions.money import whole

COLUMNS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"


def event_time(ts: Column) -> Column:
    """Wall-clock time as an instant of the same reading in UTC, whatever the session's time zone.

    Watermarks need an instant; days must not move with the zone of the session that counts them.
    """
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts))


def day_of(instant: Column) -> Column:
    """The date such an instant reads."""
    return F.date_from_unix_date(F.floor(F.unix_micros(instant) / 86_400_000_000).cast("int"))


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(COLUMNS).parquet(os.path.join(folder, "events.parquet"))


def transactions(events: DataFrame) -> DataFrame:
    """One transaction per event; a missing value earns nothing. ``event_time`` is kept where there is one."""
    pennies = F.coalesce(whole(F.col("value") * 100), F.lit(0)).cast("bigint")
    return events.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        F.lit(None).cast("string").alias("product_id"),
        *[name for name in ("event_time",) if name in events.columns],
        F.col("ts").cast("date").alias("transaction_date"),
        F.col("event_type").alias("channel"),
        pennies.alias("value_pennies"),
        pennies.alias("fee_pennies"),
    )


def customers(events: DataFrame) -> DataFrame:
    """Everybody who ever sent an event, as a customer list."""
    users = events.filter("user_id IS NOT NULL").select(F.col("user_id").alias("customer_id")).distinct()
    manager = F.concat(F.lit("RM"), F.lpad((F.col("customer_id") % 25).cast("string"), 3, "0"))
    return users.select(
        "customer_id",
        F.concat(F.lit("User "), F.col("customer_id").cast("string")).alias("customer_name"),
        F.lit(None).cast("string").alias("customer_type"),
        F.lit(None).cast("date").alias("onboarding_date"),
        manager.alias("relationship_manager"),
        F.lit(None).cast("string").alias("region"),
        F.lit(1).alias("is_active"),
    )
