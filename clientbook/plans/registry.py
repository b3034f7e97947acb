"""Named queries over a folder of star-schema tables."""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientbook import config as c
from clientbook.config import STAR_SCHEMA_CONFIG, PortfolioConfig
from clientbook.operators.staging import shared_folder
from clientbook.plans import findings, history, quality, releases, serving, snapshot, stream_queries, views
from clientbook.plans.portfolio import Portfolio
from clientbook.schemas import KEYS, TRANSACTIONS, conform
from clientbook.sources import csv_files, layout, star_schema

Query = Callable[[SparkSession, str], DataFrame]

BAD_EVERY = 97
"""One order, and one customer, in so many has a value that does not fit its column, where inputs are tried as CSV."""


def plain(df: DataFrame) -> DataFrame:
    """Types every engine renders alike: bigint, double, text. For comparing results only."""

    def column(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.IntegerType):
            return F.col(field.name).cast("bigint").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)

    return df.select(*[column(field) for field in df.schema.fields])


def open_star_schema(
    spark: SparkSession,
    folder: str,
    cfg: PortfolioConfig = STAR_SCHEMA_CONFIG,
    with_product: bool = True,
    with_region: bool = True,
) -> Portfolio:
    return Portfolio(
        star_schema.customers(spark, folder, with_region=with_region),
        star_schema.transactions(spark, folder, with_product),
        cfg,
    )


def _columns(*names: str) -> Callable[[Portfolio], DataFrame]:
    return lambda book: book.profile.select("customer_id", *names)


def _inputs(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "dim_relationship_managers": star_schema.relationship_managers(spark, folder),
        "dim_products": star_schema.products(spark, folder),
        "dim_customers": star_schema.customers(spark, folder),
        "stg_transactions": star_schema.transactions(spark, folder, with_product=False),
    }


def _built(spark: SparkSession, folder: str) -> tuple[str, PortfolioConfig]:
    """Publish every fact into a fresh folder; returns the folder."""
    root = os.path.join(shared_folder(spark), f"snapshot-{uuid.uuid4().hex}")
    book = open_star_schema(spark, folder)
    snapshot.run_snapshot(book, root)
    return root, book.cfg


def _released(spark: SparkSession, folder: str) -> releases.Release:
    return releases.publish(open_star_schema(spark, folder), os.path.join(shared_folder(spark), f"releases-{uuid.uuid4().hex}"))


def _key_check(spark: SparkSession, folder: str) -> DataFrame:
    release = _released(spark, folder)
    tables = _inputs(spark, folder) | {name: release.read(spark, name) for name in snapshot.FACTS}
    return quality.primary_keys({name: (df, KEYS[name]) for name, df in tables.items()})


def _non_empty(spark: SparkSession, folder: str) -> DataFrame:
    return quality.non_empty_release(spark, _released(spark, folder))


def _summary(spark: SparkSession, folder: str) -> DataFrame:
    book = open_star_schema(spark, folder, with_product=False, with_region=False)
    return quality.release_summary(book, _released(spark, folder))


def _rerun(spark: SparkSession, folder: str) -> DataFrame:
    """The fact that is served while a second run of the date, over other settings, has died before its end."""
    first = _released(spark, folder)
    other = open_star_schema(spark, folder, replace(STAR_SCHEMA_CONFIG, window_days=30))
    died = releases.Run(spark, first.root, other.cfg)
    died.write(snapshot.BOOK, other.book)
    served = releases.latest(spark, first.root, STAR_SCHEMA_CONFIG)
    return releases.open_release(spark, served, STAR_SCHEMA_CONFIG).customer_360()


def _refreshed(spark: SparkSession, folder: str) -> DataFrame:
    """Publish without the last two months of transactions, then refresh the customers they belong to."""
    whole = open_star_schema(spark, folder)
    cut = F.lit(whole.cfg.snapshot_date - dt.timedelta(days=60))
    early = Portfolio(whole.customers, whole.transactions.filter(F.col("transaction_date") <= cut), whole.cfg)
    root = os.path.join(shared_folder(spark), f"releases-{uuid.uuid4().hex}")
    first = releases.publish(early, root)
    new = whole.transactions.filter(F.col("transaction_date") > cut)
    release = releases.refresh(first, whole, releases.changed_customers(new))
    return release.read(spark, "fct_customer_360")


def _published(spark: SparkSession, folder: str) -> DataFrame:
    """Publish, find the date finished the second time, and read the customer fact back."""
    root, cfg = _built(spark, folder)
    book = open_star_schema(spark, folder)
    snapshot.run_snapshot(book, root, overwrite=False)
    stored = snapshot.read_fact(spark, root, "fct_customer_360", cfg)
    return stored.select(*[field.name for field in book.customer_360().schema.fields])


def _bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The customer fact from inputs stored in buckets by customer."""
    name = f"book_{uuid.uuid4().hex}"
    root = os.path.join(shared_folder(spark), name)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    book = open_star_schema(spark, folder, with_region=False)
    return layout.store_inputs(book, name, root, buckets).customer_360()


def _csv_paths(spark: SparkSession, folder: str) -> dict[str, str]:
    """The inputs as CSV files with bad records in them: dates, amounts and flags that are none."""
    root = os.path.join(shared_folder(spark), f"landing-{uuid.uuid4().hex}")
    tables = _inputs(spark, folder)
    tables["stg_transactions"] = conform(star_schema.transactions(spark, folder), TRANSACTIONS)
    order = F.split("transaction_id", "-")[0].cast("bigint") % BAD_EVERY
    tables["stg_transactions"] = tables["stg_transactions"].withColumns(
        {
            "transaction_date": F.when(order == 0, F.lit("soon")).otherwise(F.col("transaction_date").cast("string")),
            "fee_revenue": F.when(order == 1, F.lit("n/a")).otherwise(F.col("fee_revenue").cast("string")),
        }
    )
    flag = F.when(F.col("customer_id") % BAD_EVERY == 2, F.lit("maybe")).otherwise(F.col("is_active").cast("string"))
    tables["dim_customers"] = tables["dim_customers"].withColumn("is_active", flag)
    paths = {name: os.path.join(root, name) for name in csv_files.INPUTS}
    for name, path in paths.items():
        names = [field.name for field in csv_files.INPUTS[name]]
        tables[name].select(*names).write.option("header", True).csv(path)
    return paths


def _from_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The transactions that a load from CSV accepts."""
    tables, _ = csv_files.load_or_reject(spark, _csv_paths(spark, folder))
    return tables["stg_transactions"].withColumn("customer_id", F.col("customer_id").cast("bigint"))


def _csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Rejected records per table and fault."""
    _, rejects = csv_files.load_or_reject(spark, _csv_paths(spark, folder))
    faults = rejects.select("table_name", F.explode("faults").alias("fault"))
    return faults.groupBy("table_name", "fault").agg(F.count(F.lit(1)).alias("records"))


def _validated(spark: SparkSession, folder: str) -> DataFrame:
    """Presence and rows of the input files; one that nobody has delivered is looked for as well."""
    paths = {name: os.path.join(folder, f"{name}.parquet") for name in (*star_schema.COLUMNS, "campaign")}
    found = csv_files.presence(spark, paths).select("table_name", "is_present")
    there = [name for name, path in paths.items() if csv_files.path_exists(spark, path)]
    counts = quality.row_counts({name: star_schema.read_table(spark, folder, name) for name in there})
    return found.join(counts, "table_name", "left").fillna(0, ["row_count"])


MANAGERS = ["RM003", "RM007"]


def _with_early_warning(book: Portfolio) -> Portfolio:
    return Portfolio(book.customers, book.transactions, replace(book.cfg, early_warning=True))


_PROFILE_QUERIES: dict[str, Callable[[Portfolio], DataFrame]] = {
    "customer_360": Portfolio.customer_360,
    "product_usage": Portfolio.product_usage,
    "engagement_inputs": _columns(
        "products_active", "product_depth_pct", "primary_channel", "digital_txn_pct"
    ),
    "customer_health": Portfolio.customer_health,
    "prior_health": _columns("prior_health_score"),
    "concentration": Portfolio.concentration,
    "exit_scenarios": Portfolio.exit_scenarios,
    "portfolio_headline": serving.portfolio_headline,
    "concentration_ladder": views.concentration_ladder,
    "top_customers": serving.top_customers,
    "top_customers_chart": serving.top_customers_chart,
    "rm_actions": Portfolio.rm_actions,
    "customer_watchlist": views.customer_watchlist,
    "rm_workbook": lambda book: serving.rm_workbook(
        book,
        priorities=[c.P1, c.P2, c.P3],
        action_types=[c.RETAIN, c.REVIEW],
        segments=[c.VIP, c.GROWTH, c.AT_RISK],
    ),
    "rm_workbook_by_manager": lambda book: serving.rm_workbook(book, managers=["RM003", "RM007"]),
    "workbook_counts": lambda book: serving.workbook_counts(book, [c.P1, c.P2, c.P3]),
    "action_breakdown": serving.action_breakdown,
    "priority_counts": serving.priority_counts,
    "action_matrix": serving.action_matrix,
    "priority_agenda": serving.priority_agenda,
    "exceptions": Portfolio.exceptions,
    "exc_critical": lambda book: book.exceptions_of("CRITICAL CUSTOMER"),
    "exc_vip_deteriorating": lambda book: book.exceptions_of("VIP DETERIORATING"),
    "exc_revenue_decline": lambda book: book.exceptions_of("REVENUE DECLINE"),
    "exc_activity_cliff": lambda book: book.exceptions_of("ACTIVITY CLIFF"),
    "exc_segment_downgrade": lambda book: book.exceptions_of("SEGMENT DOWNGRADE"),
    "exception_feed": views.exception_feed,
    "exception_feed_p1": lambda book: serving.exception_feed(book, severities=[c.P1]),
    "exception_feed_filtered": lambda book: serving.exception_feed(
        book,
        severities=[c.P2, c.P3],
        exception_types=["REVENUE DECLINE", "ACTIVITY CLIFF"],
    ),
    "exception_breakdown": serving.exception_breakdown,
    "severity_counts": serving.severity_counts,
    "exception_types": serving.exception_types,
    "executive_kpis": Portfolio.executive_kpis,
    "executive_summary": views.executive_summary,
    "health_distribution": serving.health_distribution,
    "trend_distribution": serving.trend_distribution,
    "health_heatmap": views.health_heatmap,
    "health_heatmap_pivot": serving.health_heatmap_pivot,
    "customer_explorer": serving.customer_explorer,
    "customer_explorer_filtered": lambda book: serving.customer_explorer(
        book,
        segments=[c.VIP, c.GROWTH],
        health_categories=[c.HEALTHY, c.WATCHLIST],
        health_trends=[c.IMPROVING, c.DETERIORATING],
        action_types=[c.RETAIN, c.CROSS_SELL],
    ),
    "explorer_table": lambda book: serving.page_table(serving.customer_explorer(book), "explorer"),
    "feed_table": lambda book: serving.page_table(serving.exception_feed(book), "feed"),
    "workbook_table": lambda book: serving.page_table(
        serving.rm_workbook(book, priorities=[c.P1, c.P2, c.P3]), "workbook"
    ),
    "explorer_kpis": serving.explorer_kpis,
    "explorer_kpis_filtered": lambda book: serving.explorer_kpis(book, segments=[c.VIP, c.GROWTH]),
    "health_by_segment": findings.health_by_segment,
    "early_warning": findings.early_warning,
    "trend_shares": findings.trend_shares,
    "p1_shortfall": findings.p1_shortfall,
    "dormancy_tiers": findings.dormancy_tiers,
    "exc_healthy_deteriorating": lambda book: _with_early_warning(book).exceptions_of(c.EARLY_WARNING),
    "exceptions_with_early_warning": lambda book: _with_early_warning(book).exceptions(),
    "explorer_by_manager": lambda book: serving.customer_explorer(book, managers=MANAGERS),
    "explorer_kpis_by_manager": lambda book: serving.explorer_kpis(book, managers=MANAGERS),
    "feed_by_manager": lambda book: serving.exception_feed(book, managers=MANAGERS),
    "health_history": history.health_history,
    "health_trend_6m": history.health_trend,
}

# These need no product: the transactions are read without the join to the parts.
_MOVEMENT_QUERIES: dict[str, Callable[[Portfolio], DataFrame]] = {
    "revenue_by_period": Portfolio.revenue_by_period,
    "activity_by_period": Portfolio.activity_by_period,
    "channel_usage": Portfolio.channel_usage,
    "rfm_scores": lambda book: book.rfm().select(
        "customer_id", "rfm_recency_score", "rfm_frequency_score", "rfm_monetary_score"
    ),
    "recency": lambda book: book.rfm().select("customer_id", "days_since_last_txn"),
    "period_deltas": lambda book: book.movement.select(
        "customer_id", "revenue_delta_pct", "txn_delta_pct"
    ),
    "activity_trend": lambda book: book.movement.select("customer_id", "activity_trend"),
    "customer_segments": Portfolio.customer_segments,
    "segment_distribution": serving.segment_distribution,
    "ltm_revenue": Portfolio.ltm_revenue,
    "revenue_rank": findings.revenue_rank,
    "rank_cliff": findings.rank_cliff,
    "decline_by_segment": findings.decline_by_segment,
    "segment_transitions": findings.segment_transitions,
    "segment_change_summary": findings.segment_change_summary,
}

_TABLE_QUERIES: dict[str, Query] = {
    "ingest_customers": lambda spark, folder: star_schema.customers(
        spark, folder, with_onboarding=True
    ),
    "ingest_transactions": lambda spark, folder: conform(
        star_schema.transactions(spark, folder), TRANSACTIONS, keep_key_type="customer_id"
    ),
    "ingest_products": lambda spark, folder: star_schema.products(spark, folder).drop(
        "product_category"
    ),
    "ingest_relationship_managers": lambda spark, folder: star_schema.relationship_managers(
        spark, folder
    ).drop("rm_grade"),
    "validate_inputs": lambda spark, folder: quality.row_counts(_inputs(spark, folder)),
    "input_presence": _validated,
    "ingest_csv": _from_csv,
    "ingest_rejects": _csv_rejects,
    "bucketed_customer_360": _bucketed,
    "dq_primary_keys": _key_check,
    "dq_non_empty": _non_empty,
    "pipeline_summary": _summary,
    "publish": _published,
    "publish_rerun": _rerun,
    "publish_incremental": _refreshed,
    **stream_queries.QUERIES,
}


# Of the queries over a portfolio, these alone go through views that show the region; the others open customers without it.
_REGION_QUERIES = {
    "customer_watchlist",
    "rm_workbook",
    "rm_workbook_by_manager",
    "customer_explorer",
    "customer_explorer_filtered",
    "explorer_kpis",
    "explorer_kpis_filtered",
    "explorer_by_manager",
    "explorer_kpis_by_manager",
    "explorer_table",
    "workbook_counts",
    "workbook_table",
}


def _over_portfolio(name: str, build: Callable[[Portfolio], DataFrame], with_product: bool) -> Query:
    return lambda spark, folder: plain(
        build(
            open_star_schema(
                spark, folder, with_product=with_product, with_region=name in _REGION_QUERIES
            )
        )
    )


def _over_tables(build: Query) -> Query:
    return lambda spark, folder: plain(build(spark, folder))


def queries() -> dict[str, Query]:
    return {
        **{name: _over_tables(build) for name, build in _TABLE_QUERIES.items()},
        **{name: _over_portfolio(name, build, True) for name, build in _PROFILE_QUERIES.items()},
        **{name: _over_portfolio(name, build, False) for name, build in _MOVEMENT_QUERIES.items()},
    }
