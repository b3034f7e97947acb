"""Every threshold of every scale: the bound itself and its neighbours."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clientbook import config as c
from clientbook.functions.money import change_pct, share_pct, to_pennies, from_pennies
from clientbook.functions.rules import fill, on_scale, optional_filters, position
from tests.conftest import CFG

CASES = {
    "recency score": (
        CFG.recency_score,
        [(0, 5), (14, 5), (15, 4), (30, 4), (31, 3), (60, 3), (61, 2), (90, 2), (91, 1), (999, 1)],
    ),
    "frequency score": (
        c.FREQUENCY_SCORE,
        [(51, 5), (50, 5), (49, 4), (25, 4), (24, 3), (10, 3), (9, 2), (3, 2), (2, 1), (0, 1)],
    ),
    "monetary score": (
        c.MONETARY_SCORE,
        [
            ("20000.00", 5),
            ("19999.99", 4),
            ("3000.00", 4),
            ("2999.99", 3),
            ("800.00", 3),
            ("799.99", 2),
            ("150.00", 2),
            ("149.99", 1),
            ("0.00", 1),
        ],
    ),
    "activity health": (
        c.ACTIVITY_HEALTH,
        [(0, 0), (1, 20), (2, 20), (3, 45), (9, 45), (10, 70), (24, 70), (25, 85), (49, 85), (50, 100)],
    ),
    "revenue health": (
        c.REVENUE_HEALTH,
        [
            ("-0.01", 25),
            ("0.00", 0),
            ("0.01", 25),
            ("100.00", 25),
            ("100.01", 50),
            ("400.00", 50),
            ("400.01", 75),
            ("2000.00", 75),
            ("2000.01", 100),
        ],
    ),
    "recency health": (
        CFG.recency_health,
        [(14, 100), (15, 85), (30, 85), (31, 60), (60, 60), (61, 35), (90, 35), (91, 0)],
    ),
    "prior recency health": (c.PRIOR_RECENCY_HEALTH, [(0, 10), (1, 60), (10, 60), (11, 90)]),
    "health category": (
        c.HEALTH_CATEGORY,
        [
            ("70.0", "Healthy"),
            ("69.9", "Watchlist"),
            ("45.0", "Watchlist"),
            ("44.9", "At-Risk"),
            ("25.0", "At-Risk"),
            ("24.9", "Critical"),
        ],
    ),
    "dependency": (
        c.DEPENDENCY_SCORE,
        [
            ("0.50", "CRITICAL"),
            ("0.4999", "HIGH"),
            ("0.40", "HIGH"),
            ("0.3999", "MEDIUM"),
            ("0.30", "MEDIUM"),
            ("0.2999", "LOW"),
        ],
    ),
    "rating": (
        c.HEALTH_RATING,
        [("50.0", "Strong"), ("49.9", "Moderate"), ("30.0", "Moderate"), ("29.9", "Weak")],
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_scale(spark, name):
    scale, pairs = CASES[name]
    numbers = [(i, Decimal(str(v))) for i, (v, _) in enumerate(pairs)]
    df = spark.createDataFrame(numbers, "i int, v decimal(12,4)")
    found = [r[0] for r in df.orderBy("i").select(on_scale(F.col("v"), scale)).collect()]
    assert found == [expected for _, expected in pairs]


def test_missing_value_falls_to_the_last_step(spark):
    df = spark.createDataFrame([(None,)], "v decimal(12,4)")
    assert df.select(on_scale(F.col("v"), c.DEPENDENCY_SCORE)).first()[0] == "LOW"


def test_pennies_round_trip(spark):
    amounts = [(Decimal(v),) for v in ("0.00", "0.01", "-12.34", "9999999999999.99")]
    df = spark.createDataFrame(amounts, "v decimal(15,2)")
    assert [r[0] for r in df.select(from_pennies(to_pennies(F.col("v")))).collect()] == [
        v for (v,) in amounts
    ]


def test_change_pct_rounds_half_up_and_is_zero_without_a_base(spark):
    rows = [("110.00", "100.00", "10.00"), ("5.00", "0.00", "0"), ("0.00", "8.00", "-100"),
            ("1.00", "3.00", "-66.67"), ("800.04", "800.00", "0.01"), ("1000.05", "1000.00", "0.01")]
    data = [(Decimal(a), Decimal(b)) for a, b, _ in rows]
    df = spark.createDataFrame(data, "a decimal(15,2), b decimal(15,2)")
    found = [r[0] for r in df.select(change_pct(F.col("a"), F.col("b"))).collect()]
    assert found == [Decimal(x) for *_, x in rows]


def test_share_pct_of_nothing_is_null(spark):
    df = spark.createDataFrame([(Decimal(1), Decimal(0)), (Decimal(1), None)], "a decimal(15,2), b decimal(15,2)")
    assert [r[0] for r in df.select(share_pct(F.col("a"), F.col("b"))).collect()] == [None, None]


def test_filters_ignore_empty_choices_and_never_build_sql(spark):
    df = spark.createDataFrame([("a", "x"), ("b'; DROP", "y"), ("c", "x")], "k string, g string")

    def kept(**choices):
        return sorted(r[0] for r in df.filter(optional_filters(**choices)).collect())

    assert kept(k=None, g=[]) == ["a", "b'; DROP", "c"]
    assert kept(k=["b'; DROP"]) == ["b'; DROP"]
    assert kept(k=["a", "b'; DROP"], g=["x"]) == ["a"]
    assert kept(g=["nothing"]) == []


def test_fill_and_position(spark):
    df = spark.createDataFrame([("VIP", 3)], "s string, n int")
    row = df.select(
        fill("{s} has {n}.", s=F.col("s"), n=F.col("n")),
        fill("{n}", n=F.col("n")),
        fill("plain"),
        position(F.col("s"), ("a", "VIP")),
        position(F.lit("zzz"), ("a", "VIP")),
    ).first()
    assert tuple(row) == ("VIP has 3.", "3", "plain", 2, 3)
