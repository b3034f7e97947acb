"""Queries behind the report pages: distributions, filtered lists and breakdowns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from clientbook import config as c
from clientbook.functions.money import share_pct
from clientbook.functions.rules import optional_filters, position
from clientbook.operators import concentration, exceptions, ranking
from clientbook.plans import views
from clientbook.plans.portfolio import Portfolio

Choice = Iterable[str] | None


# Columns and their order in the table of each page.
PAGE_COLUMNS = {
    "explorer": (
        "customer_name",
        "segment",
        "health_category",
        "health_trend",
        "health_score",
        "revenue_ltm",
        "revenue_qoq_pct",
        "txn_count_90d",
        "products_active",
        "action_type",
        "priority",
        "assigned_rm",
    ),
    "feed": (
        "severity",
        "exception_type",
        "customer_name",
        "segment",
        "health_category",
        "revenue_ltm",
        "revenue_delta_pct",
        "description",
        "recommended_action",
        "assigned_rm",
    ),
    "workbook": (
        "priority",
        "sla_days",
        "customer_name",
        "segment",
        "health_category",
        "health_trend",
        "revenue_ltm",
        "revenue_delta_pct",
        "action_type",
        "action_description",
        "assigned_rm",
    ),
}


def page_table(rows: DataFrame, page: str) -> DataFrame:
    """The columns a page shows, in its order."""
    return rows.select(*PAGE_COLUMNS[page])


# -- single rows -----------------------------------------------------------------------


def first_row(df: DataFrame) -> dict:
    """A one-row result as a dict, empty if there is no row."""
    row: Row | None = df.first()
    return row.asDict() if row else {}


def portfolio_headline(book: Portfolio) -> DataFrame:
    """Top-10 share, what remains for everybody else, and the dependency score."""
    return book.concentration().select(
        "snapshot_date",
        "top_10_pct",
        (F.lit(100) - F.col("top_10_pct")).cast("decimal(5,2)").alias("remaining_pct"),
        "revenue_dependency_score",
    )


# -- distributions ---------------------------------------------------------------------


def _distribution(df: DataFrame, column: str, order: tuple[str, ...]) -> DataFrame:
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(position(F.col(column), order))


def health_distribution(book: Portfolio) -> DataFrame:
    return _distribution(book.profile, "health_category", c.HEALTH_CATEGORIES)


def trend_distribution(book: Portfolio) -> DataFrame:
    return _distribution(book.profile, "health_trend", c.HEALTH_TRENDS)


def segment_distribution(book: Portfolio) -> DataFrame:
    return _distribution(book.customer_segments(), "segment", c.SEGMENTS)


def health_heatmap_pivot(book: Portfolio) -> DataFrame:
    """Segments by health category, 0 where nobody is; segments without customers included."""
    counted = (
        book.profile.groupBy("segment")
        .pivot("health_category", list(c.HEALTH_CATEGORIES))
        .agg(F.count(F.lit(1)))
    )
    rows = book.spark.range(1).select(
        F.explode(F.array(*[F.lit(name) for name in c.SEGMENTS])).alias("segment")
    )
    return (
        rows.join(counted, "segment", "left")
        .na.fill(0, list(c.HEALTH_CATEGORIES))
        .orderBy(position(F.col("segment"), c.SEGMENTS))
    )


# -- top customers ---------------------------------------------------------------------


def top_customers(book: Portfolio, n: int = 20) -> DataFrame:
    """The top of the concentration ladder, with shares."""
    return views.top_of_ladder(book, n)


def top_customers_chart(book: Portfolio, n: int = 10, label_chars: int = 28) -> DataFrame:
    """The ``n`` largest listed customers in ascending order, ready to draw as bars.

    The label is the beginning of the name, ``label_chars`` long at most.
    """
    ranked = concentration.top_of_ladder(views.ladder_source(book), n, book.is_stored)
    return (
        ranked.filter("is_listed")
        .orderBy("revenue_rank")
        .limit(n)
        .select(
            F.col("revenue_rank").cast("int").alias("revenue_rank"),
            F.substring("customer_name", 1, label_chars).alias("label"),
            "revenue_ltm",
            "health_category",
        )
        .orderBy(F.col("revenue_rank").desc())
    )


# -- customer explorer -----------------------------------------------------------------


def explorer_rows(book: Portfolio) -> DataFrame:
    return book.profile.select(
        "customer_name",
        "customer_id",
        "segment",
        "health_category",
        "health_trend",
        F.round("health_score", 0).cast("decimal(5,0)").alias("health_score"),
        views.pounds("revenue_ltm"),
        views.pounds("revenue_90d"),
        F.round("revenue_delta_pct", 1).cast("decimal(18,1)").alias("revenue_qoq_pct"),
        "txn_count_90d",
        "products_active",
        "action_type",
        "priority",
        "assigned_rm",
        "region",
        "segment_change",
        F.col("revenue_ltm").alias("exact_revenue_ltm"),
    )


def customer_explorer(
    book: Portfolio,
    segments: Choice = None,
    health_categories: Choice = None,
    health_trends: Choice = None,
    action_types: Choice = None,
    managers: Choice = None,
) -> DataFrame:
    """All customers matching the optional choices, largest long-window revenue first."""
    chosen = optional_filters(
        segment=segments,
        health_category=health_categories,
        health_trend=health_trends,
        action_type=action_types,
        assigned_rm=managers,
    )
    ordered = (
        explorer_rows(book)
        .filter(chosen)
        .orderBy(F.col("exact_revenue_ltm").desc(), F.col("customer_id").asc())
    )
    return ordered.drop("exact_revenue_ltm")


def explorer_kpis(
    book: Portfolio,
    segments: Choice = None,
    health_categories: Choice = None,
    health_trends: Choice = None,
    action_types: Choice = None,
    managers: Choice = None,
) -> DataFrame:
    """Headline figures of a filtered set against the whole portfolio, in one pass."""
    chosen = optional_filters(
        segment=segments,
        health_category=health_categories,
        health_trend=health_trends,
        action_type=action_types,
        assigned_rm=managers,
    )
    everyone = F.count(F.lit(1))
    picked = F.count_if(chosen)
    revenue = F.col("revenue_ltm").cast("bigint")
    total = F.sum(revenue)
    picked_total = F.coalesce(F.sum(F.when(chosen, revenue)), F.lit(0))
    worse = F.col("health_trend") == c.DETERIORATING
    score = F.col("health_score").cast("bigint")
    return explorer_rows(book).agg(
        picked.alias("customers"),
        share_pct(picked, everyone).cast("decimal(5,1)").alias("pct_of_customers"),
        F.round(
            F.coalesce(F.sum(F.when(chosen, score)), F.lit(0)).cast("decimal(18,0)")
            / F.greatest(picked, F.lit(1)).cast("decimal(18,0)"),
            1,
        )
        .cast("decimal(5,1)")
        .alias("avg_health_score"),
        picked_total.alias("total_revenue"),
        share_pct(picked_total, total).cast("decimal(5,1)").alias("pct_of_revenue"),
        F.coalesce(share_pct(F.count_if(chosen & worse), picked), F.lit(0))
        .cast("decimal(5,1)")
        .alias("deteriorating_pct"),
        share_pct(F.count_if(worse), everyone).cast("decimal(5,1)").alias("portfolio_deteriorating_pct"),
        F.count_if(chosen & (F.col("action_type") == c.RETAIN)).alias("retain_customers"),
    )


# -- exceptions ------------------------------------------------------------------------


def exception_feed(
    book: Portfolio, severities: Choice = None, exception_types: Choice = None, managers: Choice = None
) -> DataFrame:
    chosen = optional_filters(severity=severities, exception_type=exception_types, assigned_rm=managers)
    return views.exception_feed(book).filter(chosen)


def exception_breakdown(book: Portfolio) -> DataFrame:
    return (
        book.alerts.filter(F.col("status") == c.OPEN)
        .groupBy("exception_type", "severity")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("severity", "exception_type")
    )


def severity_counts(book: Portfolio) -> DataFrame:
    return _distribution(book.alerts.filter(F.col("status") == c.OPEN), "severity", c.SEVERITIES)


def exception_types(book: Portfolio) -> DataFrame:
    return book.alerts.select("exception_type").distinct().orderBy("exception_type")


# -- actions ---------------------------------------------------------------------------


def rm_workbook(
    book: Portfolio,
    priorities: Choice = None,
    action_types: Choice = None,
    managers: Choice = None,
    segments: Choice = None,
) -> DataFrame:
    """The watchlist narrowed by any combination of choices, most urgent first."""
    chosen = optional_filters(
        priority=priorities, action_type=action_types, assigned_rm=managers, segment=segments
    )
    return views.customer_watchlist(book).filter(chosen)


def workbook_counts(book: Portfolio, priorities: Choice = None) -> DataFrame:
    """Actions per type in the narrowed workbook, most frequent first."""
    return (
        views.watchlist_rows(book)
        .filter(optional_filters(priority=priorities))
        .groupBy("action_type")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "action_type")
    )


def action_breakdown(book: Portfolio) -> DataFrame:
    return (
        book.profile.filter(F.col("status") == c.OPEN)
        .groupBy("action_type", "priority")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("action_type", "priority")
    )


def priority_counts(book: Portfolio) -> DataFrame:
    """Totals per priority from the breakdown."""
    return (
        action_breakdown(book)
        .groupBy("priority")
        .agg(F.sum("n").alias("n"))
        .orderBy("priority")
    )


def action_matrix(book: Portfolio) -> DataFrame:
    """Action types by priority, 0 where empty, least frequent type first."""
    return (
        book.profile.filter(F.col("status") == c.OPEN)
        .groupBy("action_type")
        .pivot("priority", list(c.PRIORITIES))
        .agg(F.count(F.lit(1)))
        .na.fill(0, list(c.PRIORITIES))
        .withColumn("total", sum((F.col(p) for p in c.PRIORITIES), F.lit(0)))
        .orderBy("total", "action_type")
    )


def priority_agenda(book: Portfolio) -> DataFrame:
    """What to do first and for how many customers: one aggregate, laid out as rows.

    The lines' order and owners are fixed values.
    """
    action, priority = F.col("action_type"), F.col("priority")
    items = [
        (c.P1, c.RETAIN, "Senior RM", (action == c.RETAIN) & (priority == c.P1)),
        (c.P2, c.RETAIN, "RM Team", (action == c.RETAIN) & (priority == c.P2)),
        (c.P2, "Exceptions", "RM Ops", exceptions.raises(book.cfg, "SEGMENT DOWNGRADE")),
        (c.P3, c.REACTIVATE, "RM Team", action == c.REACTIVATE),
        (c.P3, c.REVIEW, "RM Team", action == c.REVIEW),
        (c.P3, c.CROSS_SELL, "RM Team", action == c.CROSS_SELL),
    ]
    counted = book.profile.agg(
        *[F.count_if(condition).alias(f"item_{i}") for i, (*_, condition) in enumerate(items)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(priority_).alias("priority"),
                F.lit(c.SLA_DAYS[priority_]).alias("sla_days"),
                F.lit(action_).alias("action"),
                F.col(f"item_{i}").alias("customers"),
                F.lit(owner).alias("owner"),
            )
            for i, (priority_, action_, owner, _) in enumerate(items)
        ]
    )
    return counted.select(F.inline(rows)).orderBy("position")
