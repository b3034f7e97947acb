"""Analyses quoted in management reporting, each one aggregate over the customer rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clientbook import config as c
from clientbook.functions.money import from_pennies, share_pct, to_pennies
from clientbook.functions.rules import on_scale, position
from clientbook.operators import exceptions, ranking
from clientbook.plans.portfolio import Portfolio


def _mean(column: str, digits: int, kind: str) -> Column:
    total = F.sum(F.col(column)).cast("decimal(24,4)")
    return F.round(total / F.count(column), digits).cast(kind)


def rank_cliff(book: Portfolio, depth: int | None = None) -> DataFrame:
    """How far revenue drops from each rank to the next, down to rank ``depth`` if one is given."""
    ranked = ranking.rank_and_accumulate(
        book.ltm_revenue(), "revenue_ltm", "customer_id", is_stored=book.is_stored, following="next_revenue"
    ).filter(F.col("next_revenue").isNotNull())
    upper = ranked if depth is None else ranked.filter(F.col("revenue_rank") <= depth)
    return (
        upper.select(
            "revenue_rank",
            "customer_id",
            "revenue_ltm",
            "next_revenue",
            F.round(F.col("revenue_ltm") / F.nullif("next_revenue", F.lit(0)), 2)
            .cast("decimal(18,2)")
            .alias("drop_factor"),
        )
        .orderBy("revenue_rank")
    )


def dormancy_tiers(book: Portfolio) -> DataFrame:
    """Dormant customers by how long they have been silent, with what they still brought in."""
    never = F.col("days_since_last_txn") == c.NEVER_TRANSACTED_DAYS
    tier = F.when(never, F.lit(c.NEVER_ACTIVE)).otherwise(on_scale(F.col("days_since_last_txn"), book.cfg.dormancy_tier))
    return (
        book.profile.filter(F.col("segment") == c.DORMANT)
        .groupBy(tier.alias("tier"))
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.min("days_since_last_txn").alias("least_days"),
            F.max("days_since_last_txn").alias("most_days"),
            from_pennies(F.sum(to_pennies(F.col("revenue_ltm")))).alias("revenue_ltm"),
        )
        .orderBy(position(F.col("tier"), c.DORMANCY_TIERS))
    )


def revenue_rank(book: Portfolio) -> DataFrame:
    """Rank of every earner by exact revenue, however many there are."""
    ranked = ranking.rank_and_accumulate(
        book.ltm_revenue(), "revenue_ltm", "customer_id", is_stored=book.is_stored
    )
    return ranked.select("revenue_rank", "customer_id", "revenue_ltm").orderBy("revenue_rank")


def decline_by_segment(book: Portfolio) -> DataFrame:
    """Customers whose revenue fell by the alert threshold or more."""
    change = F.col("revenue_delta_pct")
    return (
        book.movement.filter(change <= book.cfg.revenue_decline_pct)
        .groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            _mean("revenue_delta_pct", 1, "decimal(18,1)").alias("avg_decline_pct"),
            F.round(F.min(change), 1).cast("decimal(18,1)").alias("worst_decline_pct"),
        )
        .orderBy(position(F.col("segment"), c.SEGMENTS))
    )


def health_by_segment(book: Portfolio) -> DataFrame:
    return (
        book.profile.groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            _mean("health_score", 1, "decimal(5,1)").alias("avg_health_score"),
            F.count_if(F.col("health_trend") == c.DETERIORATING).alias("deteriorating"),
        )
        .orderBy(position(F.col("segment"), c.SEGMENTS))
    )


def early_warning(book: Portfolio) -> DataFrame:
    """Customers still healthy but already deteriorating."""
    slipping = (F.col("health_category") == c.HEALTHY) & (F.col("health_trend") == c.DETERIORATING)
    return (
        book.profile.filter(slipping)
        .groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            _mean("revenue_ltm", 0, "decimal(15,0)").alias("avg_revenue_ltm"),
        )
        .orderBy(position(F.col("segment"), c.SEGMENTS))
    )


def _with_share(counted: DataFrame) -> DataFrame:
    # At most |segments| x |segments| aggregated rows meet in this window.
    everyone = F.sum("customers").over(Window.partitionBy(F.lit(1)))
    share = share_pct(F.col("customers"), everyone).cast("decimal(5,1)")
    return counted.withColumn("pct_of_customers", share)


def segment_transitions(book: Portfolio) -> DataFrame:
    flows = (
        book.movement.groupBy("prior_segment", "segment", "segment_change")
        .agg(F.count(F.lit(1)).alias("customers"))
    )
    return _with_share(flows).orderBy(
        position(F.col("prior_segment"), c.SEGMENTS), position(F.col("segment"), c.SEGMENTS)
    )


def segment_change_summary(book: Portfolio) -> DataFrame:
    changes = book.movement.groupBy("segment_change").agg(F.count(F.lit(1)).alias("customers"))
    return _with_share(changes).orderBy("segment_change")


def trend_shares(book: Portfolio) -> DataFrame:
    trends = book.profile.groupBy("health_trend").agg(F.count(F.lit(1)).alias("customers"))
    return _with_share(trends).orderBy(position(F.col("health_trend"), c.HEALTH_TRENDS))


def p1_shortfall(book: Portfolio) -> DataFrame:
    """Revenue lost with the customers behind the most severe alerts."""
    urgent = book.profile.filter(exceptions.raises(book.cfg, severity=c.P1))
    now, before = F.col("revenue_90d"), F.col("revenue_prior_90d")
    sums = urgent.agg(
        F.count(F.lit(1)).alias("customers"),
        from_pennies(F.coalesce(F.sum(to_pennies(now)), F.lit(0))).alias("revenue_current"),
        from_pennies(F.coalesce(F.sum(to_pennies(before)), F.lit(0))).alias("revenue_prior"),
    )
    gap = (F.col("revenue_current") - F.col("revenue_prior")).cast("decimal(15,2)")
    return sums.withColumn("change", gap).withColumn(
        "change_pct", share_pct(F.col("change"), F.col("revenue_prior")).cast("decimal(18,1)")
    )
