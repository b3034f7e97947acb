"""The five serving views. All read the wide customer row, so none needs a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clientbook import config as c
from clientbook.functions.money import from_pennies, share_pct, to_pennies
from clientbook.functions.rules import position
from clientbook.operators import concentration
from clientbook.plans.portfolio import Portfolio

# The views' names; their columns below are fixed as well, in name and order.
VIEW_NAMES = (
    "v_executive_summary",
    "v_customer_watchlist",
    "v_concentration_ladder",
    "v_health_heatmap",
    "v_exception_feed",
)


def pounds(name: str) -> Column:
    return F.round(name, 0).cast("decimal(15,0)").alias(name)


def one_decimal(name: str) -> Column:
    return F.round(name, 1).cast("decimal(18,1)").alias(name)


def _by_urgency(level: str) -> list[Column]:
    # The exact revenue decides the order, the whole-pound one is shown.
    return [
        position(F.col(level), c.PRIORITIES),
        F.col("exact_revenue_ltm").desc(),
        F.col("customer_id").asc(),
    ]


def executive_summary(book: Portfolio) -> DataFrame:
    return book.executive_summary()


def watchlist_rows(book: Portfolio) -> DataFrame:
    """Customers with something to do, not sorted yet."""
    return book.profile.filter(F.col("action_type") != c.MONITOR).select(
        "priority",
        "sla_days",
        "action_type",
        "customer_name",
        "customer_id",
        "segment",
        "health_category",
        "health_trend",
        F.round("health_score", 0).cast("decimal(5,0)").alias("health_score"),
        pounds("revenue_ltm"),
        pounds("revenue_90d"),
        one_decimal("revenue_delta_pct"),
        "txn_count_90d",
        "action_description",
        "assigned_rm",
        "region",
        F.col("revenue_ltm").alias("exact_revenue_ltm"),
    )


def customer_watchlist(book: Portfolio) -> DataFrame:
    return watchlist_rows(book).orderBy(*_by_urgency("priority")).drop("exact_revenue_ltm")


def ladder_source(book: Portfolio) -> DataFrame:
    """What the ladder shows of a customer, before ranking."""
    return book.book.select(
        "customer_id",
        "customer_name",
        "is_listed",
        "segment",
        "health_category",
        "health_trend",
        "ltm_txns",
        "revenue_ltm",
        "txn_count_90d",
        "products_active",
    )


def _ladder_layout(ranked: DataFrame) -> DataFrame:
    """Unlisted ids take their rank and share but are not shown."""
    return (
        ranked.filter("is_listed")
        .select(
            "revenue_rank",
            "customer_name",
            "customer_id",
            "segment",
            "health_category",
            "health_trend",
            "revenue_ltm",
            F.col("pct_of_portfolio").cast("decimal(5,2)").alias("pct_of_portfolio"),
            F.col("cumulative_pct").cast("decimal(5,1)").alias("cumulative_pct"),
            "txn_count_90d",
            "products_active",
        )
        .orderBy("revenue_rank")
    )


def concentration_ladder(book: Portfolio, slices: int | None = None) -> DataFrame:
    """All earners by rank with their own and the cumulative share."""
    return _ladder_layout(concentration.ladder(ladder_source(book), slices, book.is_stored))


def top_of_ladder(book: Portfolio, n: int) -> DataFrame:
    """The first ``n`` listed customers of the same ladder, with their ranks among all earners."""
    return _ladder_layout(concentration.top_of_ladder(ladder_source(book), n, book.is_stored)).limit(n)


def health_heatmap(book: Portfolio) -> DataFrame:
    """Segment by category and trend; the window only sees the aggregated rows."""
    cells = book.profile.groupBy("segment", "health_category", "health_trend").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum(F.col("health_score")).alias("score_sum"),
        F.sum(to_pennies(F.col("revenue_ltm"))).alias("pennies"),
    )
    in_segment = F.sum("customer_count").over(Window.partitionBy("segment"))
    return cells.select(
        "segment",
        "health_category",
        "health_trend",
        "customer_count",
        share_pct(F.col("customer_count"), in_segment).cast("decimal(5,1)").alias("pct_of_segment"),
        F.round(F.col("score_sum").cast("decimal(20,2)") / F.col("customer_count"), 1)
        .cast("decimal(5,1)")
        .alias("avg_health_score"),
        F.round(from_pennies(F.col("pennies")), 0).cast("decimal(15,0)").alias("segment_revenue"),
    ).orderBy(
        position(F.col("segment"), c.SEGMENTS),
        position(F.col("health_category"), c.HEALTH_CATEGORIES),
        position(F.col("health_trend"), c.HEALTH_TRENDS),
    )


def feed_rows(book: Portfolio) -> DataFrame:
    return book.alerts.filter(F.col("status") == c.OPEN).select(
        "severity",
        "exception_type",
        "customer_id",
        "customer_name",
        "segment",
        "health_category",
        "health_trend",
        pounds("revenue_ltm"),
        pounds("revenue_90d"),
        one_decimal("revenue_delta_pct"),
        "description",
        "recommended_action",
        "assigned_rm",
        "detected_date",
        "status",
        F.col("revenue_ltm").alias("exact_revenue_ltm"),
    )


def exception_feed(book: Portfolio) -> DataFrame:
    ordered = feed_rows(book).orderBy(*_by_urgency("severity"), "exception_type")
    return ordered.drop("exact_revenue_ltm")


def register_views(book: Portfolio) -> None:
    """Make the five views available to ``spark.sql``."""
    builders = (
        executive_summary,
        customer_watchlist,
        concentration_ladder,
        health_heatmap,
        exception_feed,
    )
    for name, build in zip(VIEW_NAMES, builders):
        build(book).createOrReplaceTempView(name)
