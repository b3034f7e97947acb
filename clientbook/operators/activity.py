"""Per-customer measures straight from the transactions: the only pass over the big table.

Two forms, because their cost differs:

* :func:`period_totals` needs sums, counts and a maximum only: one partial aggregate in
  front of one shuffle.
* :func:`customer_measures` adds the number of distinct products and the favourite channel.
  A distinct count and a mode in the same ``groupBy`` would push the raw rows through an
  object-hash aggregate (which falls back to sorting them). Here the first, fully
  code-generated aggregate collapses each customer's rows to one per product/channel pair
  used in the current period, plus one for everything older; the rest works on those few.

A customer who owns a large part of all rows is harmless in both: every map task shrinks
that customer to a handful of rows before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clientbook.config import PortfolioConfig
from clientbook.functions.money import sum_where, to_pennies
from clientbook.functions.periods import in_any, in_current, in_ltm, in_prior, known_by

_ADDITIVE = (
    "ltm_pennies",
    "ltm_txns",
    "current_pennies",
    "prior_pennies",
    "volume_pennies",
    "txn_count_90d",
    "txn_count_prior_90d",
)


def _totals(cfg: PortfolioConfig) -> list[Column]:
    day, fee, value = F.col("transaction_date"), F.col("fee_pennies"), F.col("value_pennies")
    current, prior, ltm = in_current(cfg, day), in_prior(cfg, day), in_ltm(cfg, day)
    return [
        sum_where(ltm, fee).alias("ltm_pennies"),
        F.count_if(ltm).alias("ltm_txns"),
        sum_where(current, fee).alias("current_pennies"),
        sum_where(prior, fee).alias("prior_pennies"),
        sum_where(current, value).alias("volume_pennies"),
        F.count_if(current).alias("txn_count_90d"),
        F.count_if(prior).alias("txn_count_prior_90d"),
        F.max(day).alias("last_txn_date"),
    ]


def in_pennies(transactions: DataFrame) -> DataFrame:
    """A source that can count pennies itself spares every row the way through a decimal."""
    if {"fee_pennies", "value_pennies"} <= set(transactions.columns):
        return transactions
    return transactions.withColumns(
        {
            "fee_pennies": to_pennies(F.col("fee_revenue")),
            "value_pennies": to_pennies(F.col("transaction_value")),
        }
    )


def period_totals(
    transactions: DataFrame, cfg: PortfolioConfig, periods_only: bool = False
) -> DataFrame:
    """Revenue, volume and counts per customer and period, and the last transaction date.

    With ``periods_only`` the scan is limited to the days the periods cover. Customers with
    older activity only are then absent, so it suits callers that need no recency.
    """
    window = in_any if periods_only else known_by
    return (
        in_pennies(transactions.filter(window(cfg, F.col("transaction_date"))))
        .groupBy("customer_id")
        .agg(*_totals(cfg))
    )


def customer_measures(transactions: DataFrame, cfg: PortfolioConfig, colocated: bool = False) -> DataFrame:
    """:func:`period_totals` plus ``products_active``, ``digital_txns`` and ``primary_channel``.

    ``colocated`` transactions are stored in buckets by customer and need no shuffle.
    """
    day = F.col("transaction_date")
    current = in_current(cfg, day)
    by_usage = (
        in_pennies(transactions.filter(known_by(cfg, day)))
        .groupBy(
            "customer_id",
            F.when(current, F.col("product_id")).alias("product_id"),
            F.when(current, F.col("channel")).alias("channel"),
        )
        .agg(*_totals(cfg))
    )
    return roll_up_usage(by_usage, cfg, colocated)


def product_count(transactions: DataFrame, cfg: PortfolioConfig) -> DataFrame:
    """Number of products in use in the current period; customers without any activity in it are absent."""
    now = transactions.filter(in_current(cfg, F.col("transaction_date")))
    per_product = now.groupBy("customer_id", "product_id").agg(F.lit(1).alias("used"))
    return per_product.groupBy("customer_id").agg(F.count_if(F.col("product_id").isNotNull()).alias("products_active"))


def channel_mix(transactions: DataFrame, cfg: PortfolioConfig) -> DataFrame:
    """Counts by channel in the current period, no product needed; customers without activity in it are absent."""
    now = transactions.filter(in_current(cfg, F.col("transaction_date")))
    per_channel = now.groupBy("customer_id", "channel").agg(F.count(F.lit(1)).alias("txns"))
    channel = F.col("channel")
    favourite = F.min(F.when(channel.isNotNull(), F.struct((-F.col("txns")).alias("order"), channel.alias("channel"))))
    return per_channel.groupBy("customer_id").agg(
        F.sum("txns").alias("txn_count_90d"),
        sum_where(channel.isin(*cfg.digital_channels), F.col("txns")).alias("digital_txns"),
        favourite.getField("channel").alias("primary_channel"),
    )


def roll_up_usage(by_usage: DataFrame, cfg: PortfolioConfig, colocated: bool = False) -> DataFrame:
    """One row per customer from rows per customer, product and channel.

    Both windows and the final aggregate run inside one hash partitioning on the customer;
    a customer has at most products x channels rows here, however many transactions.
    """
    per_channel = Window.partitionBy("customer_id", "channel")
    per_product = Window.partitionBy("customer_id", "product_id").orderBy("channel")
    ranked = (
        (by_usage if colocated else by_usage.repartition("customer_id"))
        .withColumn("channel_txns", F.sum("txn_count_90d").over(per_channel))
        .withColumn("nth_of_product", F.row_number().over(per_product))
    )
    channel = F.col("channel")
    # Most used channel; the alphabetically first one on a tie.
    favourite = F.min(
        F.when(
            channel.isNotNull(),
            F.struct((-F.col("channel_txns")).alias("order"), channel.alias("channel")),
        )
    )
    return ranked.groupBy("customer_id").agg(
        *[F.sum(name).alias(name) for name in _ADDITIVE],
        F.max("last_txn_date").alias("last_txn_date"),
        F.count_if((F.col("nth_of_product") == 1) & F.col("product_id").isNotNull()).alias(
            "products_active"
        ),
        sum_where(channel.isin(*cfg.digital_channels), F.col("txn_count_90d")).alias(
            "digital_txns"
        ),
        favourite.getField("channel").alias("primary_channel"),
    )
