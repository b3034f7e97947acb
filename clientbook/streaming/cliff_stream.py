"""Activity cliffs as events arrive: sliding windows over the current and the prior period.

Each event counts in the windows of two periods that end on the days after it, one window per day. A
window's row has the same measures as a snapshot of its last day, so the rules of the snapshot alert decide
whether it fires, also for customers who only fell silent. A window leaves the state once the watermark has
passed its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientbook.config import PortfolioConfig
from clientbook.functions.money import from_pennies, sum_where
from clientbook.operators import exceptions, profile
from clientbook.sources import events as source
from clientbook.streaming.activity_stream import once

ALERT = "ACTIVITY CLIFF"
KEYS = ("customer_id", "snapshot_date")


def cliff_updates(events: DataFrame, cfg: PortfolioConfig, lateness: str) -> DataFrame:
    """(customer_id, snapshot_date, counts, change, health category, fires) of the windows of a batch.

    ``fires`` may go back to false as more of a day arrives; a keyed table holds the last word.
    """
    length = cfg.window_days
    facts = source.transactions(once(events, lateness))
    slid = facts.withColumn("span", F.window("event_time", f"{2 * length} days", "1 day"))
    now = F.col("event_time") >= F.col("span.start") + F.expr(f"INTERVAL '{length}' DAY")
    one = F.lit(1).cast("bigint")
    digital = F.col("channel").isin(*cfg.digital_channels)
    windows = slid.groupBy("span", "customer_id").agg(
        sum_where(now, one).alias("txn_count_90d"),
        sum_where(~now, one).alias("txn_count_prior_90d"),
        sum_where(now, F.col("fee_pennies")).alias("current_pennies"),
        sum_where(~now, F.col("fee_pennies")).alias("prior_pennies"),
        sum_where(now & digital, one).alias("digital_txns"),
        F.max("event_time").alias("last_time"),
    )
    df = windows.select(
        "customer_id",
        F.date_sub(source.day_of(F.col("span.end")), 1).alias("snapshot_date"),
        "txn_count_90d",
        "txn_count_prior_90d",
        from_pennies(F.col("current_pennies")).alias("revenue_90d"),
        from_pennies(F.col("prior_pennies")).alias("revenue_prior_90d"),
        "digital_txns",
        F.lit(0).cast("bigint").alias("products_active"),
        source.day_of(F.col("last_time")).alias("last_txn_date"),
    )
    df = profile.with_engagement(profile.with_changes(df), cfg)
    df = profile.with_health(profile.with_recency(df, cfg, F.col("snapshot_date")), cfg)
    return df.select(
        *KEYS,
        "txn_count_90d",
        "txn_count_prior_90d",
        "txn_delta_pct",
        "health_category",
        exceptions.raises(cfg, ALERT).alias("fires"),
    )
