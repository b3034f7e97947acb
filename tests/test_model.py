"""The whole profile under the standard settings against a plain-Python reading of the rules.

Customers come in tiers with very different activity, so that all labels occur.
"""

import random
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from clientbook import config as c
from tests.conftest import CFG, DAY, ago, portfolio, txn

D = Decimal


def rounded(value, digits):
    return D(value).quantize(D(1).scaleb(-digits), ROUND_HALF_UP)


def at_least(value, steps, otherwise):
    return next((result for bound, result in steps if value >= bound), otherwise)


def at_most(value, steps, otherwise):
    return next((result for bound, result in steps if value <= bound), otherwise)


def activity_points(n):
    return at_most(n, [(0, 0), (2, 20), (9, 45), (24, 70), (49, 85)], 100)


def revenue_points(amount):
    return 0 if amount == 0 else at_most(amount, [(100, 25), (400, 50), (2000, 75)], 100)


def change(now, before):
    return rounded(D(now - before) * 100 / D(before), 2) if before else D(0)


def model(rows):
    now = [r for r in rows if ago(89) <= r[2] <= DAY]
    before = [r for r in rows if ago(179) <= r[2] <= ago(90)]
    ltm = sum((r[5] for r in rows if ago(364) <= r[2] <= DAY), D(0))
    money, prior_money = sum((r[5] for r in now), D(0)), sum((r[5] for r in before), D(0))
    n, m = len(now), len(before)
    days = (DAY - max(r[2] for r in rows)).days if rows else 999
    channels = Counter(r[3] for r in now)
    digital = channels["Online"] + channels["Mobile"]
    depth = rounded(D(len({r[1] for r in now})) * 100 / 5, 1)
    digital_pct = rounded(D(digital) * 100 / n, 1) if n else D(0)

    if n == 0:
        trend = "Inactive"
    elif m == 0:
        trend = "New"
    elif n >= m * D("1.1"):
        trend = "Growing"
    elif m >= 3 and n <= m * D("0.75"):
        trend = "Declining"
    else:
        trend = "Stable"

    if n == 0:
        segment = "Dormant"
    elif ltm >= 20000 and n >= 10:
        segment = "VIP"
    elif trend == "Declining":
        segment = "At-Risk"
    elif trend == "Growing" and ltm >= 800:
        segment = "Growth"
    else:
        segment = "Regular"
    if m == 0:
        prior_segment = "Dormant"
    elif prior_money >= 5000 and m >= 10:
        prior_segment = "VIP"
    else:
        prior_segment = "At-Risk" if m <= 2 else "Regular"
    better, middle = {"VIP", "Growth"}, {"Regular"}

    def level(name):
        return 2 if name in better else 1 if name in middle else 0

    move = level(segment) - level(prior_segment)
    engagement = rounded((depth + digital_pct) / 2, 1)
    recency = at_most(days, [(14, 100), (30, 85), (60, 60), (90, 35)], 0)
    prior_recency = 90 if m > 10 else 60 if m else 10

    def composite(a, r, t):
        return rounded(a * D("0.3") + r * D("0.35") + t * D("0.25") + engagement * D("0.1"), 1)

    score = composite(activity_points(n), revenue_points(money), recency)
    prior_score = composite(activity_points(m), revenue_points(prior_money), prior_recency)
    return {
        "revenue_ltm": ltm,
        "revenue_90d": money,
        "revenue_prior_90d": prior_money,
        "revenue_delta_pct": change(money, prior_money),
        "txn_count_90d": n,
        "txn_count_prior_90d": m,
        "txn_volume_90d": sum((r[4] for r in now), D(0)),
        "txn_delta_pct": change(n, m),
        "products_active": len({r[1] for r in now}),
        "product_depth_pct": depth,
        "primary_channel": min(channels, key=lambda k: (-channels[k], k)) if channels else "None",
        "digital_txn_pct": digital_pct,
        "days_since_last_txn": days,
        "activity_trend": trend,
        "rfm_recency_score": at_most(days, [(14, 5), (30, 4), (60, 3), (90, 2)], 1),
        "rfm_frequency_score": at_least(n, [(50, 5), (25, 4), (10, 3), (3, 2)], 1),
        "rfm_monetary_score": at_least(ltm, [(20000, 5), (3000, 4), (800, 3), (150, 2)], 1),
        "segment": segment,
        "prior_segment": prior_segment,
        "segment_change": "Upgraded" if move > 0 else "Downgraded" if move < 0 else "Stable",
        "engagement_health": engagement,
        "health_score": score,
        "prior_health_score": prior_score,
        "health_category": at_least(score, [(70, "Healthy"), (45, "Watchlist"), (25, "At-Risk")], "Critical"),
        "health_trend": "Improving" if score >= prior_score + 5 else "Deteriorating" if score <= prior_score - 5 else "Stable",
    }


# monthly transactions and fee per transaction
TIERS = {
    "top": ((18, 40), (120, 380)),
    "vip": ((12, 28), (12, 28)),
    "growth": ((7, 15), (6, 16)),
    "regular": ((3, 8), (3, 14)),
    "fading": ((2, 6), (1, 8)),
    "sleeping": ((0, 2), (0, 4)),
}


@pytest.fixture(scope="module")
def transactions():
    rng, out = random.Random(42), []
    for i in range(180):
        tier = list(TIERS)[i % len(TIERS)]
        (low, high), (cheap, dear) = TIERS[tier]
        for month in range(14):
            n = rng.randint(low, high)
            if tier == "fading":
                n = n * min(month, 6) // 6  # fewer the closer to the snapshot
            if tier == "sleeping" and month < 3 and i % 4:
                n = 0
            if tier in ("growth", "regular") and month < 3 and i % 5 == 0:
                n *= 2
            if tier == "top" and month < 3 and i % 4 == 0:
                n = n // 2
            for _ in range(n):
                out += txn(
                    f"{tier}-{i:03d}",
                    month * 30 + rng.randint(0, 29),
                    fee=f"{rng.uniform(cheap, dear):.2f}",
                    product=f"P00{rng.randint(1, 5)}",
                    channel=rng.choice(["Branch", "Online", "Mobile", "Mobile"]),
                    value=f"{rng.uniform(1, 5000):.2f}",
                )
    return out


@pytest.fixture(scope="module")
def book(spark, transactions):
    return portfolio(spark, transactions, sorted({r[0] for r in transactions}) + ["nobody"])


@pytest.fixture(scope="module")
def expected(transactions):
    rows = defaultdict(list)
    for row in transactions:
        rows[row[0]].append(row)
    rows["nobody"] = []
    return {name: model(mine) for name, mine in rows.items()}


def test_every_column_of_every_customer(book, expected):
    found = {r.customer_id: r for r in book.profile.collect()}
    assert set(found) == set(expected)
    for name, columns in expected.items():
        assert {k: found[name][k] for k in columns} == columns, name


def test_the_mix_reaches_all_labels(expected):
    for column, labels in (
        ("segment", c.SEGMENTS),
        ("prior_segment", ("VIP", "Regular", "At-Risk", "Dormant")),
        ("segment_change", ("Upgraded", "Stable", "Downgraded")),
        ("health_category", c.HEALTH_CATEGORIES),
        ("health_trend", c.HEALTH_TRENDS),
    ):
        assert {row[column] for row in expected.values()} == set(labels), column


def test_portfolio_figures(book, expected):
    revenue = sorted((row["revenue_ltm"] for row in expected.values()), reverse=True)
    total, top = sum(revenue), sum(revenue[:10])
    row = book.concentration().first()
    assert (row.total_portfolio_revenue, row.top_10_revenue) == (total, top)
    assert row.top_50_revenue == sum(revenue[:50])
    assert row.top_10_pct == rounded(top * 100 / total, 1)
    assert row.scenario_critical_exit_risk == sum(
        r["revenue_ltm"] for r in expected.values() if r["health_category"] == "Critical"
    )
    summary = book.executive_summary().first()
    now = sum(r["revenue_90d"] for r in expected.values())
    before = sum(r["revenue_prior_90d"] for r in expected.values())
    assert summary.revenue_current_90d == rounded(now, 0)
    assert summary.revenue_qoq_pct == rounded((now - before) * 100 / before, 1)
    assert summary.revenue_change == abs(now - before)
    assert summary.total_customers == len(expected)
    assert CFG.snapshot_date == summary.snapshot_date
