"""Actions and alerts: every reachable combination, and the borders of each trigger."""

from decimal import Decimal
from functools import reduce

import pytest
from pyspark.sql import DataFrame

from clientbook import Portfolio
from clientbook import config as c
from clientbook.operators import actions, exceptions
from tests.conftest import CFG, by_customer, scored


@pytest.fixture(scope="module")
def decided(spark):
    rows = [
        {"customer_id": f"{s}|{h}|{t}", "segment": s, "health_category": h, "health_trend": t}
        for s in c.SEGMENTS
        for h in c.HEALTH_CATEGORIES
        for t in c.HEALTH_TRENDS
    ]
    found = actions.with_actions(scored(spark, rows), CFG).collect()
    return {tuple(r.customer_id.split("|")): r for r in found}


def expected_action(segment, health, trend):
    if segment == "Dormant":
        return "Reactivate", "P3"
    valued = segment in ("VIP", "Growth")
    worse = trend == "Deteriorating"
    urgent = {"VIP": "P1", "Growth": "P1" if worse else "P2"}.get(segment, "P2")
    if health == "Critical":
        return "Retain", "P1" if worse else urgent
    if worse or health == "At-Risk":
        return ("Review", "P3") if segment == "Regular" else ("Retain", urgent)
    if valued:
        return "Cross-Sell", "P2" if segment == "VIP" else "P3"
    if segment == "At-Risk":
        return "Review", "P3"
    return ("Cross-Sell", "P3") if (health, trend) == ("Healthy", "Improving") else ("Monitor", "P4")


def test_every_combination_has_the_expected_action(decided):
    assert len(decided) == 60
    for key, row in decided.items():
        assert (row.action_type, row.priority) == expected_action(*key), key


def test_deadline_identifier_and_assignment(decided):
    for row in decided.values():
        assert row.sla_days == {"P1": 1, "P2": 3, "P3": 7, "P4": 30}[row.priority]
        assert row.action_id == f"{row.customer_id}_2024-01-31"
        assert (row.assigned_rm, row.status) == ("RM001", "OPEN")


def test_instruction_follows_action_and_customer(decided):
    texts = CFG.action_texts
    assert decided[("VIP", "Critical", "Stable")].action_description == texts.retain_vip
    assert decided[("Growth", "Critical", "Stable")].action_description == texts.retain_growth
    assert decided[("Regular", "Critical", "Stable")].action_description == texts.retain_critical
    assert decided[("At-Risk", "At-Risk", "Stable")].action_description == texts.retain
    assert decided[("VIP", "Healthy", "Stable")].action_description == texts.cross_sell_vip
    assert decided[("Growth", "Healthy", "Stable")].action_description == texts.cross_sell
    assert decided[("Dormant", "Critical", "Stable")].action_description == texts.reactivate
    assert decided[("At-Risk", "Healthy", "Stable")].action_description == texts.review
    assert decided[("Regular", "Healthy", "Stable")].action_description == texts.monitor


ALERT_ROWS = [
    {"customer_id": "critical", "health_category": "Critical"},
    {"customer_id": "critical-vip", "health_category": "Critical", "segment": "VIP"},
    {"customer_id": "vip-det", "segment": "VIP", "health_trend": "Deteriorating"},
    {"customer_id": "growth-det", "segment": "Growth", "health_trend": "Deteriorating"},
    {"customer_id": "regular-det", "health_trend": "Deteriorating"},
    {"customer_id": "decline-20", "revenue_delta_pct": Decimal("-20.00")},
    {"customer_id": "decline-19.99", "revenue_delta_pct": Decimal("-19.99")},
    {"customer_id": "decline-39.99", "revenue_delta_pct": Decimal("-39.99")},
    {"customer_id": "decline-40", "revenue_delta_pct": Decimal("-40.00"), "revenue_90d": Decimal("60.50")},
    {"customer_id": "decline-growth", "revenue_delta_pct": Decimal("-25.00"), "segment": "Growth"},
    {"customer_id": "decline-vip", "revenue_delta_pct": Decimal("-25.00"), "segment": "VIP"},
    {
        "customer_id": "decline-critical",
        "revenue_delta_pct": Decimal("-99.00"),
        "txn_delta_pct": Decimal("-99.00"),
        "health_category": "Critical",
    },
    {
        "customer_id": "decline-no-base",
        "revenue_delta_pct": Decimal("-30.00"),
        "revenue_prior_90d": Decimal("0.00"),
    },
    {"customer_id": "cliff-5", "txn_delta_pct": Decimal("-40.00"), "txn_count_90d": 3},
    {"customer_id": "cliff-4", "txn_delta_pct": Decimal("-40.00"), "txn_count_prior_90d": 4},
    {"customer_id": "cliff-39.99", "txn_delta_pct": Decimal("-39.99")},
    {"customer_id": "cliff-vip", "txn_delta_pct": Decimal("-60.00"), "segment": "VIP"},
    {"customer_id": "cliff-growth", "txn_delta_pct": Decimal("-60.00"), "segment": "Growth"},
    {"customer_id": "down-dormant-vip", "segment": "Dormant", "prior_segment": "VIP", "segment_change": "Downgraded"},
    {"customer_id": "down-dormant", "segment": "Dormant", "segment_change": "Downgraded"},
    {"customer_id": "down-at-risk", "segment": "At-Risk", "segment_change": "Downgraded"},
    {
        "customer_id": "down-at-risk-det",
        "segment": "At-Risk",
        "segment_change": "Downgraded",
        "health_trend": "Deteriorating",
    },
    {"customer_id": "down-regular", "prior_segment": "VIP", "segment_change": "Downgraded"},
    {
        "customer_id": "three",
        "segment": "At-Risk",
        "segment_change": "Downgraded",
        "health_trend": "Deteriorating",
        "revenue_delta_pct": Decimal("-55.55"),
        "txn_delta_pct": Decimal("-50.00"),
    },
    {
        "customer_id": "critical-and-down",
        "segment": "Dormant",
        "segment_change": "Downgraded",
        "health_category": "Critical",
    },
]


@pytest.fixture(scope="module")
def book(spark):
    return Portfolio.from_book(scored(spark, ALERT_ROWS), CFG)


def test_triggers_and_severities(book):
    found = sorted((r.customer_id, r.exception_type, r.severity) for r in book.exceptions().collect())
    assert found == sorted(
        [
            ("critical", "CRITICAL CUSTOMER", "P2"),
            ("critical-vip", "CRITICAL CUSTOMER", "P1"),
            ("vip-det", "VIP DETERIORATING", "P1"),
            ("growth-det", "VIP DETERIORATING", "P2"),
            ("decline-20", "REVENUE DECLINE", "P3"),
            ("decline-39.99", "REVENUE DECLINE", "P3"),
            ("decline-40", "REVENUE DECLINE", "P2"),
            ("decline-growth", "REVENUE DECLINE", "P2"),
            ("decline-vip", "REVENUE DECLINE", "P1"),
            ("decline-critical", "CRITICAL CUSTOMER", "P2"),
            ("cliff-5", "ACTIVITY CLIFF", "P3"),
            ("cliff-vip", "ACTIVITY CLIFF", "P1"),
            ("cliff-growth", "ACTIVITY CLIFF", "P2"),
            ("down-dormant-vip", "SEGMENT DOWNGRADE", "P1"),
            ("down-dormant", "SEGMENT DOWNGRADE", "P2"),
            ("down-at-risk-det", "SEGMENT DOWNGRADE", "P2"),
            ("three", "REVENUE DECLINE", "P2"),
            ("three", "ACTIVITY CLIFF", "P3"),
            ("three", "SEGMENT DOWNGRADE", "P2"),
            ("critical-and-down", "CRITICAL CUSTOMER", "P2"),
            ("critical-and-down", "SEGMENT DOWNGRADE", "P2"),
        ]
    )


def test_identifiers_and_texts(book):
    rows = {r.exception_id: r for r in book.exceptions().collect()}
    assert len(rows) == 21
    assert rows["EXC_REVDEC_decline-40"].description == (
        "Fee revenue 40% under the prior period (limit 20%): £61 left."
    )
    assert rows["EXC_REVDEC_three"].description.startswith("Fee revenue 56% under")
    assert rows["EXC_CLIFF_cliff-5"].description == (
        "3 transactions after 5: 40% fewer (limit 40%)."
    )
    assert rows["EXC_VIPDET_growth-det"].description.startswith("Growth: health score 5")
    assert rows["EXC_DOWN_down-dormant-vip"].description.startswith("Segment VIP became Dormant")
    assert {r.assigned_rm for r in rows.values()} == {"RM001"}


def test_one_pass_equals_the_union_of_single_rules(book):
    columns = book.exceptions().columns
    single = reduce(DataFrame.unionByName, [book.exceptions_of(n) for n in c.EXCEPTION_TYPES])
    assert sorted(map(tuple, book.exceptions().select(columns).collect())) == sorted(
        map(tuple, single.select(columns).collect())
    )


def test_counting_without_exploding(book):
    counted = book.profile.select(
        "customer_id",
        exceptions.alert_count(CFG).alias("n"),
        exceptions.alert_count(CFG, "P1").alias("urgent"),
        exceptions.raises(CFG, severity="P1").alias("any_urgent"),
        exceptions.raises(CFG, "SEGMENT DOWNGRADE").alias("down"),
    )
    found = by_customer(counted, "n", "urgent", "any_urgent", "down")
    alerts = book.exceptions().collect()
    for name, (n, urgent, any_urgent, down) in found.items():
        mine = [a for a in alerts if a.customer_id == name]
        assert n == len(mine)
        assert urgent == sum(a.severity == "P1" for a in mine)
        assert any_urgent == any(a.severity == "P1" for a in mine)
        assert down == any(a.exception_type == "SEGMENT DOWNGRADE" for a in mine)
