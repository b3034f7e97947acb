from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from clientbook import Portfolio, PortfolioConfig  # noqa: E402
from clientbook import schemas as s  # noqa: E402

CFG = PortfolioConfig()
DAY = CFG.snapshot_date
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("clientbook-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def ago(days: int) -> dt.date:
    """The date ``days`` before the snapshot."""
    return DAY - dt.timedelta(days=days)


def txn(customer, days_ago, fee="1.00", product="P001", channel="Branch", value="10.00", copies=1):
    """``copies`` equal transactions; transaction ids are filled in by :func:`portfolio`."""
    row = (customer, product, ago(days_ago), channel, Decimal(value), Decimal(fee))
    return [row] * copies


def portfolio(spark, transactions, customers=None, cfg=CFG) -> Portfolio:
    """A portfolio from (customer, product, date, channel, value, fee) rows.

    Customers default to the ids seen in the transactions.
    """
    names = sorted({row[0] for row in transactions}) if customers is None else customers
    people = [(n, f"Name {n}", "Retail", dt.date(2020, 1, 1), "RM001", "North", 1) for n in names]
    rows = [
        (f"T{i}", cust, product, day, "Debit", channel, value, fee)
        for i, (cust, product, day, channel, value, fee) in enumerate(transactions)
    ]
    return Portfolio(
        spark.createDataFrame(people, s.CUSTOMERS),
        spark.createDataFrame(rows, s.TRANSACTIONS),
        cfg,
    )


def by_customer(df, *columns):
    """Collected rows keyed by customer id: single values, or tuples for several columns."""
    rows = df.select("customer_id", *columns).collect()
    return {r[0]: r[1] if len(columns) == 1 else tuple(r[1:]) for r in rows}


SCORED_COLUMNS = {
    "customer_id": ("string", "C"),
    "customer_name": ("string", "Name"),
    "relationship_manager": ("string", "RM001"),
    "region": ("string", "North"),
    "is_listed": ("boolean", True),
    "ltm_txns": ("bigint", 5),
    "revenue_ltm": ("decimal(15,2)", Decimal("1000.00")),
    "revenue_90d": ("decimal(15,2)", Decimal("100.00")),
    "revenue_prior_90d": ("decimal(15,2)", Decimal("100.00")),
    "revenue_delta_pct": ("decimal(18,4)", Decimal("0")),
    "txn_count_90d": ("bigint", 5),
    "txn_count_prior_90d": ("bigint", 5),
    "txn_delta_pct": ("decimal(18,4)", Decimal("0")),
    "products_active": ("bigint", 1),
    "segment": ("string", "Regular"),
    "prior_segment": ("string", "Regular"),
    "segment_change": ("string", "Stable"),
    "health_score": ("decimal(5,2)", Decimal("60.0")),
    "health_category": ("string", "Watchlist"),
    "health_trend": ("string", "Stable"),
}


def scored(spark, rows):
    """A scored customer frame from dicts; what a row leaves out takes an unremarkable value."""
    schema = ", ".join(f"{name} {kind}" for name, (kind, _) in SCORED_COLUMNS.items())
    data = [
        tuple(row.get(name, default) for name, (_, default) in SCORED_COLUMNS.items())
        for row in rows
    ]
    return spark.createDataFrame(data, schema)
