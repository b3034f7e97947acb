"""Ranking, ladder, concentration and KPIs."""

import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from clientbook import Portfolio
from clientbook.operators.ranking import rank_and_accumulate
from clientbook.plans import findings, serving, views
from tests.conftest import CFG, portfolio, scored, txn

AMOUNTS = "customer_id string, revenue_ltm decimal(15,0)"


def by_hand(pairs):
    ordered = sorted(pairs, key=lambda p: (-p[1], p[0]))
    total, so_far, out = sum(v for _, v in pairs), 0, []
    for rank, (name, value) in enumerate(ordered, start=1):
        so_far += value
        out.append((rank, name, value, so_far, total))
    return out


def ranked(spark, pairs, slices=None):
    df = spark.createDataFrame([(k, Decimal(v)) for k, v in pairs], AMOUNTS)
    rows = rank_and_accumulate(df, "revenue_ltm", "customer_id", slices).collect()
    return sorted(
        (r.revenue_rank, r.customer_id, int(r.revenue_ltm), int(r.cumulative), int(r.grand_total))
        for r in rows
    )


@pytest.mark.parametrize("slices", [None, 1, 3, 16])
def test_rank_with_a_third_of_all_rows_tied(spark, slices):
    rng = random.Random(7)
    pairs = [(f"C{i:05d}", 0 if i % 3 == 0 else rng.randint(0, 60)) for i in range(3000)]
    rng.shuffle(pairs)
    assert ranked(spark, pairs, slices) == by_hand(pairs)


def test_tied_values_are_spread_over_slices(spark):
    df = spark.range(6000).selectExpr(
        "cast(id as string) customer_id", "cast(if(id % 3 = 0, 5, id) as decimal(15,0)) revenue_ltm"
    )
    ranged = df.repartitionByRange(8, df.revenue_ltm.desc(), df.customer_id.asc())
    sizes = [len(part) for part in ranged.rdd.glom().collect()]
    assert max(sizes) < 2000  # the tied third alone has 2000 rows


@pytest.mark.parametrize("pairs", [[], [("only", 7)], [("a", 0), ("b", 0)]])
def test_rank_of_few_rows(spark, pairs):
    assert ranked(spark, pairs) == by_hand(pairs)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.text("abcxyz", min_size=1, max_size=4), st.integers(0, 9), max_size=40))
def test_rank_of_any_rows(spark, values):
    pairs = list(values.items())
    assert ranked(spark, pairs, 4) == by_hand(pairs)


def standing(spark, revenues, **row):
    rows = [{"customer_id": f"C{i:03d}", "revenue_ltm": Decimal(str(v)), **row} for i, v in enumerate(revenues)]
    return Portfolio.from_book(scored_with_action(spark, rows), CFG)


def scored_with_action(spark, rows):
    from clientbook.operators import actions

    return actions.with_actions(scored(spark, rows), CFG)


@pytest.mark.parametrize(
    "top, rest, grade, pct",
    [
        ([5] * 10, [1] * 50, "CRITICAL", "50.0"),
        ([4.99] * 10, [1] * 50, "HIGH", "49.9"),
        ([4] * 10, [1] * 60, "HIGH", "40.0"),
        ([3] * 10, [1] * 70, "MEDIUM", "30.0"),
        ([2.99] * 10, [1] * 70, "LOW", "29.9"),
    ],
)
def test_dependency_grades(spark, top, rest, grade, pct):
    row = standing(spark, top + rest).concentration().first()
    assert row.revenue_dependency_score == grade
    assert row.top_10_revenue == Decimal(str(sum(map(Decimal, map(str, top)))))
    assert row.top_10_pct == Decimal(pct)


def test_grade_uses_the_unrounded_share(spark):
    # 499.80 of 1,000.00 shows as 50.0 % and is still only HIGH
    row = standing(spark, [49.98] * 10 + [10.004] * 50).concentration().first()
    assert (row.top_10_pct, row.revenue_dependency_score) == (Decimal("50.0"), "HIGH")


def test_fewer_customers_than_tiers(spark):
    row = standing(spark, [3, 2, 1]).concentration().first()
    assert row.total_portfolio_revenue == row.top_10_revenue == row.top_50_revenue == 6
    assert (row.top_10_pct, row.revenue_dependency_score) == (100, "CRITICAL")


def test_empty_portfolio(spark):
    book = standing(spark, [])
    row = book.concentration().first()
    assert row.total_portfolio_revenue is None and row.top_10_pct is None
    assert (row.revenue_dependency_score, row.scenario_critical_exit_risk) == ("LOW", 0)
    kpis = book.executive_kpis().first()
    assert (kpis.total_customers, kpis.open_exceptions) == (0, 0)
    assert kpis.active_customers is None and kpis.open_retain_actions is None
    assert kpis.open_p1_exceptions is None and kpis.healthy_pct is None
    assert book.executive_summary().count() == 0
    assert serving.first_row(book.executive_summary()) == {}
    assert book.exceptions().count() == 0
    assert views.concentration_ladder(book).count() == 0


def test_customers_without_long_window_transactions_do_not_rank(spark):
    book = portfolio(spark, txn("a", 10, fee="5.00") + txn("b", 400, fee="9.00"), ["a", "b", "c"])
    assert [r.customer_id for r in views.concentration_ladder(book).collect()] == ["a"]
    assert book.concentration().first().total_portfolio_revenue == 5


def test_unlisted_revenue_counts_in_the_total_only(spark):
    t = txn("listed", 200, fee="30.00") + txn("stranger", 200, fee="70.00")
    book = portfolio(spark, t, ["listed"])
    row = book.concentration().first()
    assert row.total_portfolio_revenue == 100
    assert row.scenario_critical_exit_risk == 30  # only listed customers have a health category
    (rung,) = views.concentration_ladder(book).collect()
    assert (rung.revenue_rank, rung.customer_id) == (2, "listed")
    assert (rung.pct_of_portfolio, rung.cumulative_pct) == (30, 100)
    assert book.executive_kpis().first().total_customers == 1
    assert [r.customer_id for r in serving.top_customers(book, 5).collect()] == ["listed"]


def test_ladder_rounds_before_ranking_and_summing(spark):
    t = txn("z", 10, fee="10.40") + txn("y", 10, fee="10.30") + txn("x", 10, fee="10.49")
    rows = views.concentration_ladder(portfolio(spark, t)).collect()
    assert [(r.revenue_rank, r.customer_id, r.revenue_ltm) for r in rows] == [
        (1, "x", 10),
        (2, "y", 10),
        (3, "z", 10),
    ]
    assert [r.cumulative_pct for r in rows] == [Decimal("33.3"), Decimal("66.7"), Decimal("100.0")]


def test_top_of_the_ladder_is_the_ladder_cut_short(spark):
    rng = random.Random(3)
    t = []
    for i in range(40):
        t += txn(f"C{i:02d}", 10, fee=f"{rng.randint(1, 9)}.{rng.randint(10, 99)}")
    book = portfolio(spark, t)
    full = views.concentration_ladder(book).collect()
    assert serving.top_customers(book, 12).collect() == full[:12]
    assert [r.cumulative_pct for r in full] == sorted(r.cumulative_pct for r in full)
    assert full[-1].cumulative_pct == 100
    chart = serving.top_customers_chart(book, 12).collect()
    assert [r.revenue_rank for r in chart] == list(range(12, 0, -1))


def test_rank_cliff(spark):
    t = txn("a", 10, fee="90.00") + txn("b", 10, fee="45.00") + txn("c", 10, fee="10.00")
    rows = findings.rank_cliff(portfolio(spark, t)).collect()
    assert [(r.revenue_rank, r.drop_factor) for r in rows] == [(1, Decimal("2.00")), (2, Decimal("4.50"))]
