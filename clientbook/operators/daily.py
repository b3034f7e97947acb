"""Transactions rolled up to one row per customer, product, channel and day.

Every measure of a snapshot can be had from these rows, for any date: a stream keeps them up to date,
and a refresh reads them instead of the transactions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientbook.config import PortfolioConfig
from clientbook.functions.money import sum_where
from clientbook.functions.periods import in_current, in_ltm, in_prior, known_by
from clientbook.operators.activity import in_pennies, roll_up_usage

KEYS = ("customer_id", "product_id", "channel", "day")
AMOUNTS = ("txns", "fee_pennies", "value_pennies")


def roll_up(transactions: DataFrame) -> DataFrame:
    """KEYS and AMOUNTS. Map tasks shrink a customer to the days, products and channels in use."""
    return (
        in_pennies(transactions)
        .groupBy("customer_id", "product_id", "channel", F.col("transaction_date").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("txns"),
            F.sum("fee_pennies").alias("fee_pennies"),
            F.sum("value_pennies").alias("value_pennies"),
        )
    )


def measures(days: DataFrame, cfg: PortfolioConfig) -> DataFrame:
    """What :func:`activity.customer_measures` makes of the transactions, from rolled-up rows."""
    day, n, fee, value = (F.col(name) for name in ("day", *AMOUNTS))
    current, prior, ltm = in_current(cfg, day), in_prior(cfg, day), in_ltm(cfg, day)
    by_usage = (
        days.filter(known_by(cfg, day))
        .groupBy(
            "customer_id",
            F.when(current, F.col("product_id")).alias("product_id"),
            F.when(current, F.col("channel")).alias("channel"),
        )
        .agg(
            sum_where(ltm, fee).alias("ltm_pennies"),
            sum_where(ltm, n).alias("ltm_txns"),
            sum_where(current, fee).alias("current_pennies"),
            sum_where(prior, fee).alias("prior_pennies"),
            sum_where(current, value).alias("volume_pennies"),
            sum_where(current, n).alias("txn_count_90d"),
            sum_where(prior, n).alias("txn_count_prior_90d"),
            F.max(day).alias("last_txn_date"),
        )
    )
    return roll_up_usage(by_usage, cfg)
