"""Hand-built customers at the edges of every rule of the profile."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clientbook import PortfolioConfig
from clientbook.operators import profile as ops
from tests.conftest import CFG, ago, by_customer, portfolio, scored, txn


@pytest.fixture(scope="module")
def rows(spark):
    """One customer per edge, all in one portfolio."""
    t = []
    # window edges: 1 in current on both ends, 1 prior on both ends, LTM ends, one after the snapshot
    for days in (0, 89, 90, 179, 180, 364, 365, -1):
        t += txn("edges", days, fee="1.00")
    t += txn("prior-zero", 10, fee="5.00", copies=2)
    for name, now, before in (
        ("grow", 11, 10),
        ("flat", 10, 10),
        ("drop", 3, 4),
        ("few", 1, 2),
        ("barely", 4, 5),
    ):
        t += txn(name, 5, copies=now) + txn(name, 100, copies=before)
    t += txn("vip", 5, fee="2000.00", copies=10)
    t += txn("not-vip-money", 5, fee="2000.00", copies=9) + txn("not-vip-money", 6, fee="1999.99")
    t += txn("not-vip-count", 5, fee="3000.00", copies=9)
    t += txn("was-vip", 100, fee="500.00", copies=10)
    t += txn("was-not-vip", 100, fee="500.00", copies=9) + txn("was-not-vip", 101, fee="499.99")
    t += txn("tie", 5, channel="Online", copies=2) + txn("tie", 5, channel="Branch", copies=2)
    t += txn("tie", 200, channel="Mobile", copies=9)
    t += txn("mix", 5, channel="Mobile", product="P001") + txn("mix", 5, channel="Online", product="P002")
    t += txn("mix", 5, channel="Mobile", product="P002") + txn("mix", 95, channel="Branch", product="P003")
    t += txn("old", 400, fee="7.00")
    names = sorted({r[0] for r in t}) + ["never"]
    book = portfolio(spark, t, names)
    return {r["customer_id"]: r for r in book.profile.collect()}


def test_one_row_per_customer(rows):
    assert len(rows) == 16


def test_window_edges(rows):
    r = rows["edges"]
    assert r.txn_count_90d == 2 and r.revenue_90d == Decimal("2.00")
    assert r.txn_count_prior_90d == 2 and r.revenue_prior_90d == Decimal("2.00")
    assert r.revenue_ltm == Decimal("6.00")  # 0, 89, 90, 179, 180, 364
    assert r.txn_volume_90d == Decimal("20.00")
    assert r.days_since_last_txn == 0


def test_never_transacted(rows):
    r = rows["never"]
    assert (r.days_since_last_txn, r.primary_channel) == (999, "None")
    assert (r.revenue_ltm, r.revenue_delta_pct, r.txn_delta_pct) == (0, 0, 0)
    assert (r.products_active, r.digital_txn_pct, r.product_depth_pct) == (0, 0, 0)
    assert (r.rfm_recency_score, r.rfm_frequency_score, r.rfm_monetary_score) == (1, 1, 1)
    assert (r.activity_trend, r.segment, r.prior_segment) == ("Inactive", "Dormant", "Dormant")
    assert (r.segment_change, r.health_category, r.health_score) == ("Stable", "Critical", 0)
    # nothing before either, yet the prior recency floor is 10 points at 25 %: 2.5
    assert (r.prior_health_score, r.health_trend) == (Decimal("2.50"), "Stable")


def test_activity_before_the_long_window_counts_for_recency_only(rows):
    r = rows["old"]
    assert (r.days_since_last_txn, r.revenue_ltm, r.ltm_txns) == (400, 0, 0)
    assert r.primary_channel == "None"


def test_zero_prior(rows):
    r = rows["prior-zero"]
    assert (r.revenue_delta_pct, r.txn_delta_pct) == (0, 0)
    assert (r.activity_trend, r.prior_segment) == ("New", "Dormant")


def test_trend_borders(rows):
    trends = {k: rows[k].activity_trend for k in ("grow", "flat", "drop", "few", "barely")}
    assert trends == {
        "grow": "Growing",
        "flat": "Stable",
        "drop": "Declining",
        "few": "Stable",
        "barely": "Stable",
    }
    assert rows["grow"].txn_delta_pct == Decimal("10.00")
    assert rows["drop"].txn_delta_pct == Decimal("-25.00")


def test_segment_borders(rows):
    found = {k: (rows[k].segment, rows[k].prior_segment) for k in rows}
    assert found["vip"][0] == "VIP"
    # "not-vip-money" has 19,999.99 and is new, hence neither Growth nor At-Risk
    assert found["not-vip-money"][0] == "Regular" and rows["not-vip-money"].revenue_ltm == Decimal("19999.99")
    assert found["not-vip-count"][0] == "Regular"
    assert found["was-vip"] == ("Dormant", "VIP")
    assert found["was-not-vip"] == ("Dormant", "Regular")
    assert found["drop"] == ("At-Risk", "Regular")
    assert found["few"] == ("Regular", "At-Risk")
    assert found["grow"] == ("Regular", "Regular")  # growing, but below the revenue floor


def test_channels_and_products(rows):
    assert rows["tie"].primary_channel == "Branch"  # alphabetical on a tie, current period only
    assert rows["tie"].digital_txn_pct == Decimal("50.0")
    r = rows["mix"]
    assert (r.primary_channel, r.products_active) == ("Mobile", 2)
    assert (r.digital_txn_pct, r.product_depth_pct) == (100, Decimal("40.0"))


def test_weighted_score(rows):
    # 10 transactions: 70; £20,000: 100; 5 days: 100; one of 5 products, no digital: (20 + 0) / 2
    r = rows["vip"]
    assert (r.activity_health, r.revenue_health, r.recency_health) == (70, 100, 100)
    assert r.engagement_health == Decimal("10.0")
    assert r.health_score == Decimal("82.0")  # 21 + 35 + 25 + 1
    assert r.health_category == "Healthy"
    # before: 0 and 0, absent 10 -> 2.5, same engagement -> 1.0
    assert (r.prior_health_score, r.health_trend) == (Decimal("3.5"), "Improving")


def test_missing_product_or_channel_is_not_counted(spark):
    t = txn("a", 5, channel=None, copies=3) + txn("a", 5, product=None, channel="Online")
    r = portfolio(spark, t).profile.first()
    assert (r.primary_channel, r.products_active, r.txn_count_90d) == ("Online", 1, 4)
    assert r.digital_txn_pct == Decimal("25.0")


def test_segment_transitions(spark):
    expected = {
        ("VIP", "VIP"): "Stable",
        ("VIP", "Regular"): "Upgraded",
        ("VIP", "At-Risk"): "Upgraded",
        ("VIP", "Dormant"): "Upgraded",
        ("Growth", "VIP"): "Stable",
        ("Growth", "Regular"): "Upgraded",
        ("Growth", "At-Risk"): "Upgraded",
        ("Growth", "Dormant"): "Upgraded",
        ("Regular", "VIP"): "Downgraded",
        ("Regular", "Regular"): "Stable",
        ("Regular", "At-Risk"): "Upgraded",
        ("Regular", "Dormant"): "Upgraded",
        ("At-Risk", "VIP"): "Downgraded",
        ("At-Risk", "Regular"): "Downgraded",
        ("At-Risk", "At-Risk"): "Stable",
        ("At-Risk", "Dormant"): "Stable",
        ("Dormant", "VIP"): "Downgraded",
        ("Dormant", "Regular"): "Downgraded",
        ("Dormant", "At-Risk"): "Stable",
        ("Dormant", "Dormant"): "Stable",
    }
    # inputs that produce each segment now and before
    now = {
        "VIP": (Decimal(20000), 10, "Stable"),
        "Growth": (Decimal(800), 5, "Growing"),
        "Regular": (Decimal(100), 5, "Stable"),
        "At-Risk": (Decimal(100), 5, "Declining"),
        "Dormant": (Decimal(100), 0, "Inactive"),
    }
    before = {"VIP": (Decimal(5000), 10), "Regular": (Decimal(10), 9), "At-Risk": (Decimal(10), 2), "Dormant": (Decimal(0), 0)}
    data = []
    for a, b in expected:
        ltm, n, trend = now[a]
        prior_revenue, m = before[b]
        if a == "At-Risk" and m < 3:
            continue  # needs three earlier transactions, so it cannot follow At-Risk or Dormant
        data.append((a, b, ltm, n, trend, prior_revenue, m))
    df = spark.createDataFrame(
        data,
        "now string, before string, revenue_ltm decimal(15,2), txn_count_90d bigint,"
        " activity_trend string, revenue_prior_90d decimal(15,2), txn_count_prior_90d bigint",
    )
    found = ops.with_segments(df, CFG).collect()
    assert len(found) == 18
    for r in found:
        assert (r.segment, r.prior_segment) == (r.now, r.before)
        assert r.segment_change == expected[(r.now, r.before)]


def test_trend_needs_five_points(spark):
    # same scores on both sides except recency; the prior proxy gives 60 points, i.e. 15.0
    base = (5, Decimal(100), 5, Decimal(100), Decimal("20.0"), Decimal("0.0"))
    data = [(f"d{d}", *base, d) for d in (14, 30, 60, 90, 91)]
    df = spark.createDataFrame(
        data,
        "customer_id string, txn_count_90d bigint, revenue_90d decimal(15,2), txn_count_prior_90d bigint,"
        " revenue_prior_90d decimal(15,2), product_depth_pct decimal(5,2), digital_txn_pct decimal(5,2),"
        " days_since_last_txn int",
    )
    found = by_customer(
        ops.with_health(df, CFG).withColumn("shift", F.col("health_score") - F.col("prior_health_score")),
        "shift",
        "health_trend",
    )
    assert found["d14"] == (Decimal("10.00"), "Improving")
    assert found["d30"] == (Decimal("6.20"), "Improving")  # 44.5 against 38.25, itself rounded
    assert found["d60"] == (Decimal("0.00"), "Stable")
    assert found["d90"][1] == "Deteriorating"
    assert found["d91"] == (Decimal("-15.00"), "Deteriorating")


def test_exactly_five_points_either_way(spark):
    rows = [
        # 45 x .30 + 25 x .35 + 85 x .25 = 43.5 against 20 x .30 + 50 x .35 + 60 x .25 = 38.5
        ("up", 5, Decimal(100), 30, 2, Decimal(101)),
        # 70 x .30 + 75 x .35 + 35 x .25 = 56.0 against 70 x .30 + 50 x .35 + 90 x .25 = 61.0
        ("down", 15, Decimal(401), 90, 15, Decimal(400)),
        # 85 x .30 + 50 x .35 + 85 x .25 = 64.25 against 70 x .30 + 50 x .35 + 90 x .25 = 61.0
        ("level", 25, Decimal(400), 30, 24, Decimal(400)),
    ]
    df = spark.createDataFrame(
        rows,
        "customer_id string, txn_count_90d bigint, revenue_90d decimal(15,2), days_since_last_txn int,"
        " txn_count_prior_90d bigint, revenue_prior_90d decimal(15,2)",
    ).selectExpr("*", "cast(0 as decimal(5,2)) product_depth_pct", "cast(0 as decimal(5,2)) digital_txn_pct")
    found = by_customer(ops.with_health(df, CFG), "health_score", "prior_health_score", "health_trend")
    assert found["up"] == (Decimal("43.5"), Decimal("38.5"), "Improving")
    assert found["down"] == (Decimal("56.0"), Decimal("61.0"), "Deteriorating")
    assert found["level"] == (Decimal("64.3"), Decimal("61.0"), "Stable")


def test_standard_periods():
    cfg = PortfolioConfig()
    assert (cfg.ltm_start.isoformat(), cfg.current_start.isoformat()) == ("2023-02-01", "2023-11-03")
    assert (cfg.prior_start.isoformat(), cfg.prior_end.isoformat()) == ("2023-08-05", "2023-11-02")
    assert (cfg.current_start - cfg.prior_start).days == 90 == (cfg.snapshot_date - cfg.prior_end).days


def test_later_transactions_do_not_change_a_back_dated_snapshot(spark):
    early = txn("a", 120, fee="3.00", copies=2)
    late = txn("a", 5, fee="9.00", copies=7, channel="Online")
    cfg = CFG.at(ago(100))
    one = portfolio(spark, early, cfg=cfg).customer_360().collect()
    two = portfolio(spark, early + late, cfg=cfg).customer_360().collect()
    assert one == two


def test_short_and_full_way_to_the_segments_agree(spark):
    t = txn("a", 5, fee="900.00", copies=12) + txn("a", 100, copies=4) + txn("b", 100, copies=3)
    t += txn("c", 500)
    book = portfolio(spark, t, ["a", "b", "c", "d"])
    columns = ("segment", "prior_segment", "segment_change", "activity_trend", "revenue_delta_pct")
    assert by_customer(book.movement, *columns) == by_customer(book.profile, *columns)


def test_unlisted_customers_stay_out_of_the_profile(spark):
    book = portfolio(spark, txn("known", 5) + txn("stranger", 5), ["known"])
    assert list(by_customer(book.profile, "segment")) == ["known"]
    assert sorted(by_customer(book.book, "is_listed")) == ["known", "stranger"]
    assert scored(spark, [{}]).count() == 1
