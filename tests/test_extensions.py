"""Dormancy tiers, the early-warning alert, managers, stored books, short top lists, stages."""

from __future__ import annotations

import os
import random
from dataclasses import replace

import pytest

from clientbook import Portfolio
from clientbook import config as c
from clientbook.operators import staging
from clientbook.plans import findings, serving, snapshot, views
from tests.conftest import CFG, ago, portfolio, txn


def plain(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize(
    "days,tier",
    [(90, c.NEWLY_DORMANT), (119, c.NEWLY_DORMANT), (120, c.RECENTLY_DORMANT), (179, c.RECENTLY_DORMANT), (180, c.LONG_DORMANT), (None, c.NEVER_ACTIVE)],
)
def test_dormancy_tiers(spark, days, tier):
    rows = txn("busy", 3) + (txn("a", days, fee="7.50") if days is not None else [])
    (row,) = findings.dormancy_tiers(portfolio(spark, rows, ["busy", "a"])).collect()
    assert (row.tier, row.customers, row.least_days) == (tier, 1, 999 if days is None else days)
    assert str(row.revenue_ltm) == ("0.00" if days is None else "7.50")


def fading(name, fee):
    """Healthy, but far less so than in the prior period."""
    return txn(name, 3, fee=fee, product="P1", channel="Online", copies=26) + txn(name, 120, fee="45.00", copies=60)


def test_early_warning_is_an_alert_of_its_own(spark):
    rows = fading("rich", "60.00") + fading("poor", "1.00") + txn("calm", 3, fee="50.00", copies=30) + txn("calm", 100, fee="50.00", copies=30)
    book = portfolio(spark, rows)
    warned = Portfolio(book.customers, book.transactions, replace(CFG, early_warning=True))
    healthy = {r.customer_id: r for r in warned.profile.collect() if (r.health_category, r.health_trend) == (c.HEALTHY, c.DETERIORATING)}
    assert healthy
    found = {r.customer_id: r for r in warned.exceptions_of(c.EARLY_WARNING).collect()}
    assert set(found) == set(healthy)
    for name, row in found.items():
        profile = healthy[name]
        worth_it = profile.segment in (c.VIP, c.GROWTH) or profile.revenue_ltm >= CFG.early_warning_revenue
        assert row.severity == (c.P2 if worth_it else c.P3) and row.exception_id == f"EXC_HLTDET_{name}"
        assert row.description.startswith(f"Health score {profile.health_score.quantize(row_scale())}")
    # Nothing else changes, and without the setting nothing does.
    others = [r for r in plain(warned.exceptions()) if c.EARLY_WARNING not in r]
    assert others == plain(book.exceptions()) and len(plain(warned.exceptions())) == len(others) + len(found)
    assert not any(c.EARLY_WARNING in r for r in plain(book.exceptions()))


def row_scale():
    from decimal import Decimal

    return Decimal("0.1")


@pytest.fixture(scope="module")
def mixed(spark):
    draw, rows = random.Random(8), []
    for i in range(60):
        name = f"c{i:02d}"
        for _ in range(draw.randint(0, 25)):
            rows += txn(name, draw.randint(0, 400), fee=f"{draw.randint(0, 20)}.{draw.randint(10, 99)}", product=f"P{draw.randint(1, 4)}", channel=draw.choice(["Online", "Branch"]))
    rows += txn("ghost1", 9, fee="400.00") + txn("ghost2", 9, fee="55.00") + txn("old", 390)
    return portfolio(spark, rows, [f"c{i:02d}" for i in range(60)] + ["old"])


@pytest.fixture(scope="module")
def stored(mixed, tmp_path_factory):
    return snapshot.run_snapshot(mixed, str(tmp_path_factory.mktemp("stored")))


@pytest.mark.parametrize("operator", ["revenue_by_period", "activity_by_period", "product_usage", "channel_usage", "ltm_revenue"])
def test_a_stored_book_serves_every_operator(mixed, stored, operator):
    assert plain(getattr(stored, operator)()) == plain(getattr(mixed, operator)())


def test_a_stored_book_serves_scores(mixed, stored):
    names = ("customer_id", "days_since_last_txn", "rfm_recency_score", "rfm_frequency_score", "rfm_monetary_score")
    assert plain(stored.rfm().select(*names)) == plain(mixed.rfm().select(*names)) == plain(mixed.profile.select(*names))


@pytest.mark.parametrize("n", [1, 7, 20, 500])
def test_top_lists_are_the_top_of_the_whole_ladder(mixed, n):
    whole = views.concentration_ladder(mixed).collect()
    assert serving.top_customers(mixed, n).collect() == whole[:n]
    assert [r.revenue_rank for r in serving.top_customers_chart(mixed, n).collect()] == [r.revenue_rank for r in whole[:n]][::-1]


def test_rank_cliff_over_many_slices(spark, mixed):
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = findings.rank_cliff(mixed).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    earners = sorted(((-r.revenue_ltm, r.customer_id) for r in mixed.ltm_revenue().collect()))
    assert [(r.revenue_rank, r.customer_id, -r.revenue_ltm) for r in found] == [(i + 1, name, v) for i, (v, name) in enumerate(earners[:-1])]
    assert [-r.next_revenue for r in found] == [v for v, _ in earners[1:]]


def test_managers_narrow_every_page(spark, mixed):
    people = mixed.customers
    two = people.withColumn("relationship_manager", people.customer_id.substr(3, 1))
    book = Portfolio(two, mixed.transactions, CFG)
    for build, column in ((serving.customer_explorer, "assigned_rm"), (serving.exception_feed, "assigned_rm")):
        whole = build(book).collect()
        assert build(book, managers=["3", "7"]).collect() == [r for r in whole if r[column] in ("3", "7")]
    assert serving.explorer_kpis(book, managers=["3"]).first().customers == 6


def test_inputs_of_other_types_are_cast(spark):
    book = portfolio(spark, txn("a", 5, fee="2.50") + txn("a", 100), ["a"])
    loose = book.transactions.selectExpr("* EXCEPT (transaction_date, fee_revenue)", "CAST(transaction_date AS timestamp) AS transaction_date", "CAST(fee_revenue AS double) AS fee_revenue")
    again = Portfolio(book.customers.withColumn("is_active", book.customers.is_active.cast("bigint")), loose, CFG)
    assert plain(again.customer_360()) == plain(book.customer_360())


def test_stages_can_be_removed(spark):
    frame = staging.staged(spark.range(3).toDF("n"))
    (path,) = {os.path.dirname(f.removeprefix("file://")) for f in frame.inputFiles()}
    assert frame.count() == 3 and os.path.isdir(path)
    assert staging.close_stages(spark) >= 1
    assert not os.path.isdir(path) and staging.close_stages(spark) == 0
