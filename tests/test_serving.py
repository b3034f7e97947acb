"""Invariants between facts, views and breakdowns on the given tables."""

import os

import pytest
from pyspark.sql import functions as F

from clientbook import config as c
from clientbook.operators.staging import staged
from clientbook.plans import findings, serving, views
from clientbook.plans.portfolio import Portfolio
from clientbook.plans.registry import open_star_schema
from tests.conftest import CFG, DATA, scored
from tests.test_concentration import scored_with_action

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables not present")


@pytest.fixture(scope="module")
def book(spark):
    raw = open_star_schema(spark, DATA)
    return Portfolio.from_book(staged(raw.book), raw.cfg)


def test_every_label_of_the_model_occurs(book):
    for column, labels in (
        ("segment", c.SEGMENTS),
        ("health_category", c.HEALTH_CATEGORIES),
        ("health_trend", c.HEALTH_TRENDS),
        ("activity_trend", c.ACTIVITY_TRENDS),
        ("action_type", c.ACTION_TYPES),
        ("priority", c.PRIORITIES),
    ):
        assert {r[0] for r in book.profile.select(column).distinct().collect()} == set(labels)


def test_counts_add_up(book):
    kpis = book.executive_kpis().first()
    n = book.profile.count()
    assert kpis.total_customers == n == book.rm_actions().count()
    assert kpis.active_customers + kpis.dormant_customers == n
    for distribution in (
        serving.health_distribution,
        serving.trend_distribution,
        serving.segment_distribution,
    ):
        assert sum(r.n for r in distribution(book).collect()) == n
    actions = {r.action_type: r.total for r in serving.action_matrix(book).collect()}
    assert sum(actions.values()) == n
    assert kpis.open_retain_actions == actions[c.RETAIN]
    assert sum(r.n for r in serving.priority_counts(book).collect()) == n
    alerts = serving.exception_breakdown(book).collect()
    assert sum(r.n for r in alerts) == kpis.open_exceptions == views.exception_feed(book).count()
    assert sum(r.n for r in alerts if r.severity == "P1") == kpis.open_p1_exceptions
    assert sum(r.n for r in serving.severity_counts(book).collect()) == kpis.open_exceptions
    assert sum(r.customer_count for r in views.health_heatmap(book).collect()) == n
    assert sum(r.customers for r in findings.segment_transitions(book).collect()) == n


def test_tiers_are_nested(book):
    row = book.concentration().first()
    assert row.top_10_revenue <= row.top_20_revenue <= row.top_50_revenue <= row.total_portfolio_revenue


def test_orders(book):
    watch = views.customer_watchlist(book).collect()
    assert [r.priority for r in watch] == sorted(r.priority for r in watch)
    assert all(a.revenue_ltm >= b.revenue_ltm for a, b in zip(watch, watch[1:]) if a.priority == b.priority)
    feed = views.exception_feed(book).collect()
    assert [r.severity for r in feed] == sorted(r.severity for r in feed)
    explorer = serving.customer_explorer(book).collect()
    assert all(a.revenue_ltm >= b.revenue_ltm for a, b in zip(explorer, explorer[1:]))
    assert [r.segment for r in serving.segment_distribution(book).collect()] == list(c.SEGMENTS)
    assert [r.health_category for r in serving.health_distribution(book).collect()] == list(
        c.HEALTH_CATEGORIES
    )


def test_filters_narrow_without_changing_rows(book):
    everyone = {r.customer_id: r for r in serving.customer_explorer(book).collect()}
    some = serving.customer_explorer(book, segments=["VIP"], health_trends=["Improving"]).collect()
    assert some and all(everyone[r.customer_id] == r for r in some)
    assert len(some) == sum(r.segment == "VIP" and r.health_trend == "Improving" for r in everyone.values())
    assert serving.customer_explorer(book, segments=["nobody"]).count() == 0
    manager = next(iter(everyone.values())).assigned_rm
    mine = serving.rm_workbook(book, managers=[manager], priorities=["P1", "P2", "P3"]).collect()
    assert {r.assigned_rm for r in mine} == {manager}
    alerts = serving.exception_feed(book, severities=["P1"], exception_types=["REVENUE DECLINE"]).collect()
    assert {(r.severity, r.exception_type) for r in alerts} <= {("P1", "REVENUE DECLINE")}


def test_filtered_headlines(book):
    whole = serving.explorer_kpis(book).first()
    assert (whole.pct_of_customers, whole.pct_of_revenue) == (100, 100)
    assert whole.deteriorating_pct == whole.portfolio_deteriorating_pct
    nobody = serving.explorer_kpis(book, segments=["nobody"]).first()
    assert (nobody.customers, nobody.total_revenue, nobody.avg_health_score) == (0, 0, 0)
    assert (nobody.deteriorating_pct, nobody.retain_customers) == (0, 0)


def test_segment_without_customers_keeps_its_row(spark):
    rows = [{"segment": "VIP", "health_category": "Healthy"}]
    book = Portfolio.from_book(scored_with_action(spark, rows), CFG)
    pivot = serving.health_heatmap_pivot(book).collect()
    assert [r.segment for r in pivot] == list(c.SEGMENTS)
    assert [r.Healthy for r in pivot] == [1, 0, 0, 0, 0]
    assert all(r.Critical == 0 for r in pivot)


def test_agenda(book):
    agenda = {(r.priority, r.action): r.customers for r in serving.priority_agenda(book).collect()}
    workbook = book.rm_actions()
    assert agenda[("P1", "Retain")] == workbook.filter("action_type = 'Retain' and priority = 'P1'").count()
    assert agenda[("P2", "Exceptions")] == book.exceptions_of("SEGMENT DOWNGRADE").count()
    assert agenda[("P3", "Cross-Sell")] == workbook.filter("action_type = 'Cross-Sell'").count()


def test_shortfall_is_about_distinct_customers(spark):
    rows = [
        # two P1 alerts for one customer count once
        {"customer_id": "a", "segment": "VIP", "health_trend": "Deteriorating",
         "revenue_delta_pct": -25, "revenue_90d": 75, "revenue_prior_90d": 100},
        {"customer_id": "b"},
    ]
    from decimal import Decimal

    rows[0] = {k: Decimal(v) if isinstance(v, int) else v for k, v in rows[0].items()}
    row = findings.p1_shortfall(Portfolio.from_book(scored(spark, rows), CFG)).first()
    assert (row.customers, row.revenue_current, row.revenue_prior, row.change) == (1, 75, 100, -25)
    assert row.change_pct == -25


def test_single_row_as_dict(book):
    summary = serving.first_row(views.executive_summary(book))
    assert summary["total_customers"] == book.profile.count()
    assert serving.first_row(book.concentration())["top_10_pct"] is not None


def test_labels_are_cut(spark, book):
    longest = serving.top_customers_chart(book, 10).agg(F.max(F.length("label"))).first()[0]
    assert longest <= 28
