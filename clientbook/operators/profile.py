"""The customer row: measures joined to the customer list, then scored column by column.

Everything after the single join is a projection. Segment, health and action come from the
same row, so no score is ever joined back to another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientbook import config as c
from clientbook.config import PortfolioConfig
from clientbook.functions.money import change_pct, from_pennies
from clientbook.functions.rules import evaluate_once, first_match, lookup, on_scale

_NO_MEASURES = {
    "ltm_pennies": 0,
    "ltm_txns": 0,
    "current_pennies": 0,
    "prior_pennies": 0,
    "volume_pennies": 0,
    "txn_count_90d": 0,
    "txn_count_prior_90d": 0,
    "products_active": 0,
    "digital_txns": 0,
    "primary_channel": c.NO_CHANNEL,
}


def open_book(customers: DataFrame, measures: DataFrame) -> DataFrame:
    """Customers and measures side by side, keeping what only one side knows.

    Concentration counts revenue of customer ids missing from the customer list, the profile
    must not. ``is_listed`` tells them apart; filtering on it turns the full outer join
    into a left one, so callers who want listed customers only do not pay for the rest.
    """
    listed = customers.withColumn("is_listed", F.lit(True))
    defaults = {k: v for k, v in _NO_MEASURES.items() if k in measures.columns}
    return listed.join(measures, "customer_id", "full").fillna(defaults)


def with_money(book: DataFrame) -> DataFrame:
    return book.withColumns(
        {
            "revenue_ltm": from_pennies(F.col("ltm_pennies")),
            "revenue_90d": from_pennies(F.col("current_pennies")),
            "revenue_prior_90d": from_pennies(F.col("prior_pennies")),
            "txn_volume_90d": from_pennies(F.col("volume_pennies")),
        }
    )


def with_changes(book: DataFrame) -> DataFrame:
    """Period-over-period change of revenue and activity."""
    return book.withColumns(
        {
            "revenue_delta_pct": change_pct(F.col("revenue_90d"), F.col("revenue_prior_90d")),
            "txn_delta_pct": change_pct(F.col("txn_count_90d"), F.col("txn_count_prior_90d")),
        }
    )


def with_engagement(book: DataFrame, cfg: PortfolioConfig) -> DataFrame:
    """How much of the catalogue and of the digital channels a customer uses."""
    total = F.col("txn_count_90d")
    depth = F.col("products_active").cast("decimal(10,0)") * 100 / F.lit(cfg.products_total)
    digital = F.col("digital_txns").cast("decimal(18,0)") * 100 / total.cast("decimal(18,0)")
    return book.withColumns(
        {
            "products_total": F.lit(cfg.products_total),
            "product_depth_pct": F.round(depth, 1).cast("decimal(5,2)"),
            "digital_txn_pct": F.when(total == 0, F.lit(0))
            .otherwise(F.round(digital, 1))
            .cast("decimal(5,2)"),
        }
    )


def with_recency(book: DataFrame, cfg: PortfolioConfig, day: Column | None = None) -> DataFrame:
    """Days since the last transaction, on the snapshot date or on a date of each row."""
    days = F.date_diff(F.lit(cfg.snapshot_date) if day is None else day, F.col("last_txn_date"))
    return book.withColumn(
        "days_since_last_txn", F.coalesce(days, F.lit(c.NEVER_TRANSACTED_DAYS))
    )


def with_activity_trend(book: DataFrame, cfg: PortfolioConfig) -> DataFrame:
    now, before = F.col("txn_count_90d"), F.col("txn_count_prior_90d")
    trend = first_match(
        [
            (now == 0, c.INACTIVE),
            (before == 0, c.NEW),
            (now >= before * F.lit(cfg.growing_ratio), c.GROWING),
            (
                (now <= before * F.lit(cfg.declining_ratio))
                & (before >= cfg.declining_min_prior),
                c.DECLINING,
            ),
        ],
        c.STABLE,
    )
    return book.withColumn("activity_trend", trend)


def with_rfm(book: DataFrame, cfg: PortfolioConfig) -> DataFrame:
    return book.withColumns(
        {
            "rfm_recency_score": on_scale(F.col("days_since_last_txn"), cfg.recency_score),
            "rfm_frequency_score": on_scale(F.col("txn_count_90d"), c.FREQUENCY_SCORE),
            "rfm_monetary_score": on_scale(F.col("revenue_ltm"), c.MONETARY_SCORE),
        }
    )


def with_segments(book: DataFrame, cfg: PortfolioConfig) -> DataFrame:
    """Segment now, segment a period ago, and the direction of the move."""
    now, before = F.col("txn_count_90d"), F.col("txn_count_prior_90d")
    ltm, trend = F.col("revenue_ltm"), F.col("activity_trend")
    segment = first_match(
        [
            (now == 0, c.DORMANT),
            ((now >= cfg.vip_txns) & (ltm >= cfg.vip_revenue), c.VIP),
            (trend.isin(c.DECLINING, c.INACTIVE) & (before >= cfg.at_risk_min_prior), c.AT_RISK),
            ((trend == c.GROWING) & (ltm >= cfg.growth_revenue), c.GROWTH),
        ],
        c.REGULAR,
    )
    annualised = F.col("revenue_prior_90d") * F.lit(cfg.prior_annualiser)
    prior = first_match(
        [
            (before == 0, c.DORMANT),
            ((before >= cfg.vip_txns) & (annualised >= cfg.vip_revenue), c.VIP),
            (before.between(*cfg.prior_at_risk_txns), c.AT_RISK),
        ],
        c.REGULAR,
    )
    level = lookup(F.col("segment"), c.SEGMENT_LEVEL)
    prior_level = lookup(F.col("prior_segment"), c.SEGMENT_LEVEL)
    change = first_match(
        [(level > prior_level, c.UPGRADED), (level < prior_level, c.DOWNGRADED)], c.STABLE
    )
    both = evaluate_once(book, {"segment": segment, "prior_segment": prior})
    return both.withColumn("segment_change", change)


def with_health(book: DataFrame, cfg: PortfolioConfig) -> DataFrame:
    """Four dimension scores, their weighted composite, its category and its trend.

    The prior composite uses the same scales on the prior period; recency is then judged by
    how busy that period was, and engagement is taken as unchanged.
    """
    weights = {name: F.lit(weight) for name, weight in c.HEALTH_WEIGHTS.items()}

    def composite(activity, revenue, recency):
        parts = {
            "activity": activity,
            "revenue": revenue,
            "recency": recency,
            "engagement": "engagement_health",
        }
        total = sum((F.col(column) * weights[name] for name, column in parts.items()), F.lit(0))
        return F.round(total, 1).cast("decimal(5,2)")

    engagement = (F.col("product_depth_pct") + F.col("digital_txn_pct")) / F.lit(2)
    dimensions = book.withColumns(
        {
            "activity_health": on_scale(F.col("txn_count_90d"), c.ACTIVITY_HEALTH),
            "revenue_health": on_scale(F.col("revenue_90d"), c.REVENUE_HEALTH),
            "recency_health": on_scale(F.col("days_since_last_txn"), cfg.recency_health),
            "engagement_health": F.round(engagement, 1).cast("decimal(5,2)"),
            "prior_activity_health": on_scale(F.col("txn_count_prior_90d"), c.ACTIVITY_HEALTH),
            "prior_revenue_health": on_scale(F.col("revenue_prior_90d"), c.REVENUE_HEALTH),
            "prior_recency_health": on_scale(
                F.col("txn_count_prior_90d"), c.PRIOR_RECENCY_HEALTH
            ),
        }
    )
    scored = evaluate_once(
        dimensions,
        {
            "health_score": composite("activity_health", "revenue_health", "recency_health"),
            "prior_health_score": composite(
                "prior_activity_health", "prior_revenue_health", "prior_recency_health"
            ),
        },
    )
    shift = F.col("health_score") - F.col("prior_health_score")
    trend = first_match(
        [
            (shift >= c.HEALTH_TREND_POINTS, c.IMPROVING),
            (shift <= -c.HEALTH_TREND_POINTS, c.DETERIORATING),
        ],
        c.STABLE,
    )
    return scored.withColumns(
        {
            "health_category": on_scale(F.col("health_score"), c.HEALTH_CATEGORY),
            "health_trend": trend,
        }
    )
