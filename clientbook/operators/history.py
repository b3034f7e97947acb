"""The customer book on many dates from one pass over the transactions.

All period bounds of all dates cut the calendar into slots. One aggregate collapses the transactions to a row per
customer, product and slot. Every period is a range of slots, so each such row is summed straight into the dates it
counts for; a further date costs a row per customer in memory, and no further look at the transactions. Map
tasks shrink even a customer with a third of all rows to products x slots rows before anything is shuffled.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clientbook.config import PortfolioConfig
from clientbook.operators import profile
from clientbook.operators.activity import in_pennies
from clientbook.operators.partitioning import by_key, stored_bytes

_AMOUNTS = ("txns", "fee_pennies", "value_pennies", "digital_txns")


def month_ends(last: dt.date, months: int) -> list[dt.date]:
    """``last`` and the same day of the months before, at most the last day of each."""
    found = []
    for back in range(months):
        year, month = divmod(last.year * 12 + last.month - 1 - back, 12)
        after = dt.date(year + (month == 11), (month + 1) % 12 + 1, 1)
        found.append(min(dt.date(year, month + 1, 1) + dt.timedelta(days=last.day - 1), after - dt.timedelta(days=1)))
    return sorted(found)


def _bounds(cfg: PortfolioConfig, dates: Sequence[dt.date]) -> list[dt.date]:
    """Last days of the slots: where a period of some date ends or the day before it begins."""
    day, found = dt.timedelta(days=1), set()
    for at in dates:
        c = cfg.at(at)
        found |= {at, c.current_start - day, c.prior_start - day, c.prior_end, c.ltm_start - day}
    return sorted(found)


def _slot(day: Column, bounds: list[dt.date], first: int = 0) -> Column:
    """Index of the first bound not before ``day``; halving keeps the comparisons few."""
    if len(bounds) == 1:
        return F.lit(first)
    middle = len(bounds) // 2
    return F.when(day <= F.lit(bounds[middle - 1]), _slot(day, bounds[:middle], first)).otherwise(
        _slot(day, bounds[middle:], first + middle)
    )


def slot_totals(customers: DataFrame, transactions: DataFrame, cfg: PortfolioConfig, bounds: list[dt.date]) -> DataFrame:
    """Amounts per customer, product and slot, all rows of a customer in one partition, partitions growing with the input.

    A listed customer adds a row without amounts, which marks the customer and stands in for activity.
    """
    day = F.col("transaction_date")
    digital = F.coalesce(F.col("channel").isin(*cfg.digital_channels), F.lit(False))
    active = (
        in_pennies(transactions.filter(day <= F.lit(bounds[-1])))
        .groupBy("customer_id", "product_id", _slot(day, bounds).alias("slot"))
        .agg(
            F.count(F.lit(1)).alias("txns"),
            F.sum("fee_pennies").alias("fee_pennies"),
            F.sum("value_pennies").alias("value_pennies"),
            F.count_if(digital).alias("digital_txns"),
            F.max(day).alias("last_day"),
        )
        .withColumn("listed", F.lit(0))
    )
    nothing = F.lit(0).cast("bigint")
    listed = customers.select(
        "customer_id",
        F.lit(None).cast(active.schema["product_id"].dataType).alias("product_id"),
        F.lit(0).alias("slot"),
        *[nothing.alias(name) for name in _AMOUNTS],
        F.lit(None).cast("date").alias("last_day"),
        F.lit(1).alias("listed"),
    )
    return by_key(active.unionByName(listed), stored_bytes(transactions), "customer_id")


def _spine(cfg: PortfolioConfig, dates: Sequence[dt.date], bounds: list[dt.date]) -> Column:
    """Per date the slots of its periods: ``now`` is the last slot of the date, ``prior_to`` that of the prior period.

    A period begins after the slot ``current``, ``prior`` or ``ltm``.
    """
    place, day = {bound: i for i, bound in enumerate(bounds)}, dt.timedelta(days=1)
    spine = []
    for date in dates:
        c = cfg.at(date)
        slots = {
            "now": date,
            "current": c.current_start - day,
            "prior": c.prior_start - day,
            "prior_to": c.prior_end,
            "ltm": c.ltm_start - day,
        }
        spine.append(F.struct(F.lit(date).alias("date"), *[F.lit(place[bound]).alias(name) for name, bound in slots.items()]))
    return F.array(*spine)


def measures_on(
    customers: DataFrame, transactions: DataFrame, cfg: PortfolioConfig, dates: Sequence[dt.date]
) -> DataFrame:
    """The measures of each listed customer on each date: customer_id, snapshot_date and amounts.

    Each row of a customer, product and slot counts in the periods of the dates it is known on. A product is
    active on a date if its last slot known by then is in the current period, so one look at a product's next slot
    tells which of its rows stands for it. A customer has a row per date from there on, whatever the number of
    products. The window and the aggregate run inside the partitioning by customer.
    """
    bounds = _bounds(cfg, dates)
    following = F.lead("slot").over(Window.partitionBy("customer_id", "product_id").orderBy("slot"))
    known = (
        slot_totals(customers, transactions, cfg, bounds)
        .withColumn("following", following)
        .select("*", F.inline(_spine(cfg, dates, bounds)))
        .filter("slot <= now")
    )
    slot = F.col("slot")
    periods = {
        "ltm": slot > F.col("ltm"),
        "current": slot > F.col("current"),
        "prior": (slot > F.col("prior")) & (slot <= F.col("prior_to")),
    }

    def over(period: str, name: str) -> Column:
        return F.sum(F.when(periods[period], F.col(name)).otherwise(0))

    last_known = F.col("following").isNull() | (F.col("following") > F.col("now"))
    per_date = known.groupBy("customer_id", F.col("date").alias("snapshot_date")).agg(
        over("ltm", "fee_pennies").alias("ltm_pennies"),
        over("ltm", "txns").alias("ltm_txns"),
        over("current", "fee_pennies").alias("current_pennies"),
        over("prior", "fee_pennies").alias("prior_pennies"),
        over("current", "value_pennies").alias("volume_pennies"),
        over("current", "txns").alias("txn_count_90d"),
        over("prior", "txns").alias("txn_count_prior_90d"),
        over("current", "digital_txns").alias("digital_txns"),
        F.count_if(periods["current"] & last_known & F.col("product_id").isNotNull()).alias("products_active"),
        F.max("last_day").alias("last_txn_date"),
        F.max("listed").alias("listed"),
    )
    return per_date.filter("listed = 1").drop("listed")


def book_history(customers: DataFrame, transactions: DataFrame, cfg: PortfolioConfig, dates: Sequence[dt.date]) -> DataFrame:
    """Segments and health of every listed customer on every date; one row per customer and date."""
    df = measures_on(customers, transactions, cfg, dates)
    df = profile.with_changes(profile.with_money(df))
    df = profile.with_engagement(df, cfg)
    df = profile.with_recency(df, cfg, F.col("snapshot_date"))
    df = profile.with_activity_trend(df, cfg)
    df = profile.with_segments(df, cfg)
    return profile.with_health(df, cfg)
