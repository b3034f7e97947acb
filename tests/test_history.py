"""Health history against one run per date, and trend lines against plain Python."""

from __future__ import annotations

import datetime as dt
import random
import re
from decimal import Decimal

import pytest

from clientbook import Portfolio
from clientbook.operators import history as operator
from clientbook.plans import history
from tests.conftest import CFG, ago, portfolio, txn
from tests.test_scale import final_plan

COLUMNS = (
    "customer_id", "health_score", "health_category", "health_trend", "segment", "segment_change", "revenue_90d",
    "txn_count_90d", "days_since_last_txn",
)


@pytest.mark.parametrize(
    "last,months,wanted",
    [
        (dt.date(2024, 1, 31), 3, ["2023-11-30", "2023-12-31", "2024-01-31"]),
        (dt.date(2024, 3, 30), 2, ["2024-02-29", "2024-03-30"]),
        (dt.date(2001, 8, 1), 2, ["2001-07-01", "2001-08-01"]),
    ],
)
def test_month_ends(last, months, wanted):
    assert [str(d) for d in operator.month_ends(last, months)] == wanted


@pytest.fixture(scope="module")
def book(spark):
    """Two years of activity; one customer has a third of it, one has none, one is not listed."""
    draw, rows = random.Random(4), []
    for i in range(3000):
        name = "hot" if i % 3 == 0 else f"c{draw.randint(0, 30):02d}"
        product = draw.choice(["P1", "P2", "P3", None])
        channel = draw.choice(["Online", "Branch", None])
        rows += txn(name, draw.randint(-20, 700), fee=f"{draw.randint(0, 90)}.{draw.randint(10, 99)}", product=product, channel=channel)
    # On both sides of every bound of the last date.
    for days in (0, 89, 90, 179, 180, 364, 365, 366):
        rows += txn("edge", days, fee="10.00") + txn("ghost", days)
    return portfolio(spark, rows, ["hot", "edge", "silent", *[f"c{i:02d}" for i in range(31)]])


@pytest.fixture(scope="module")
def rows(book):
    return {(r.customer_id, r.snapshot_date): r for r in history.health_history(book).collect()}


@pytest.mark.parametrize("back", range(12))
def test_every_date_equals_a_run_of_its_own(book, rows, back):
    date = operator.month_ends(CFG.snapshot_date, 12)[back]
    single = Portfolio(book.customers, book.transactions, CFG.at(date)).profile.select(*COLUMNS).collect()
    assert len(single) == 34 and len(rows) == 12 * 34
    for row in single:
        found = rows[row.customer_id, date]
        assert {c: found[c] for c in COLUMNS} == row.asDict()


def test_dates_may_be_given_in_any_order_and_twice(book):
    dates = [ago(10), ago(400), ago(10), ago(0)]
    found = history.health_history(book, dates).collect()
    assert len(found) == 3 * 34 and {r.snapshot_date for r in found} == set(dates)


def test_one_scan_and_no_join(book):
    df = history.health_history(book)
    text = final_plan(df)
    # The transactions are a local table here: they are read by one scan, the customers by another.
    assert len(re.findall(r"(?:LocalTableScan|Scan ExistingRDD) \(\d+\)\n", text.split("\n\n")[0] + "\n")) == 2
    assert "Join" not in text


def generated(df) -> int:
    """Rows that generators gave out while ``df`` was worked out."""
    df.collect()
    found, left = 0, [df._jdf.queryExecution().executedPlan()]
    while left:
        at = left.pop()
        kind = at.getClass().getSimpleName()
        if kind == "GenerateExec":
            found += at.metrics().apply("numOutputRows").value()
        if kind == "AdaptiveSparkPlanExec":
            left.append(at.executedPlan())
        elif kind.endswith("QueryStageExec"):
            left.append(at.plan())
        else:
            left += [at.children().apply(i) for i in range(at.children().size())]
    return found


def test_rows_grow_with_the_dates_and_not_with_products_times_bounds(spark):
    rows = [t for i in range(40) for t in txn("one", 5, product=f"P{i}")]
    df = history.health_history(portfolio(spark, rows))
    # The row of each product and that of the list, on each of twelve dates, and two later generators of one row each;
    # every product used to come at all 46 bounds, which made 3,919 rows.
    assert 0 < generated(df) <= (40 + 1 + 2) * 12


def test_trend_lines_take_no_more_rows_than_their_six_dates(spark):
    rows = [t for i in range(40) for t in txn("one", 5, product=f"P{i}")]
    assert 0 < generated(history.health_trend(portfolio(spark, rows))) <= (40 + 1 + 2) * 6


def test_products_are_counted_once_and_only_while_current(spark):
    """A product with rows in several slots of a period counts once; one without a name, or only in the past, not at all."""
    rows = [t for days in (1, 35, 70, 95, 200) for t in txn("one", days, product="P1") + txn("one", days, product=None)]
    rows += txn("one", 95, product="P2") + txn("one", 1, product="P3") + txn("two", 400, product="P1")
    dates = [ago(0), ago(30), ago(90), ago(300)]
    book = portfolio(spark, rows, ["one", "two", "three"])
    found = {
        (r.customer_id, r.snapshot_date): r.products_active
        for r in operator.measures_on(book.customers, book.transactions, CFG, dates).collect()
    }
    assert [found["one", day] for day in dates] == [2, 2, 2, 0]
    assert {found[name, day] for name in ("two", "three") for day in dates[:3]} == {0} and found["two", ago(300)] == 0 and len(found) == 12


def lines(points):
    """Slope, start of the later stretch and both means by plain arithmetic."""
    n, xs, ys = len(points), range(len(points)), [float(y) for _, y in points]
    along = n * sum(x * x for x in xs) - sum(xs) ** 2
    slope = (n * sum(x * y for x, y in zip(xs, ys)) - sum(xs) * sum(ys)) / along if along else None
    best = (0.0, None)
    for k in range(1, n):
        a, b = sum(ys[:k]) / k, sum(ys[k:]) / (n - k)
        gain = k * (n - k) / n * (a - b) ** 2
        if gain > best[0] + 1e-9:
            best = (gain, (points[k][0], a, b))
    return slope, best[1]


def test_trend_lines_against_plain_python(spark):
    draw, rows = random.Random(9), {}
    for i in range(60):
        n = draw.choice([1, 2, 3, 6, 12])
        scores = [Decimal(draw.randint(0, 1000)) / 10 if i % 5 else Decimal(40) for _ in range(n)]
        rows[f"c{i}"] = [(dt.date(2023, k + 1, 1), s) for k, s in enumerate(scores)]
    rows["tie"] = [(dt.date(2023, k + 1, 1), Decimal(s)) for k, s in enumerate((10, 20, 10, 20))]
    data = [(name, *point) for name, points in rows.items() for point in points] + [("none", dt.date(2023, 1, 1), None)]
    draw.shuffle(data)
    df = spark.createDataFrame(data, "customer_id string, snapshot_date date, health_score decimal(5,2)").repartition(5)
    found = {r.customer_id: r for r in history.trend_lines(df).collect()}
    assert set(found) == set(rows)
    for name, points in rows.items():
        row, (slope, change) = found[name], lines(points)
        assert row.dates == len(points) and row.snapshot_date == points[-1][0] and row.health_score == float(points[-1][1])
        assert row.slope == (None if slope is None else pytest.approx(slope, abs=6e-5))
        if change is None:
            assert (row.change_date, row.mean_before, row.mean_after) == (None, None, None)
        else:
            assert row.change_date == change[0]
            assert (row.mean_before, row.mean_after) == (pytest.approx(change[1], abs=6e-5), pytest.approx(change[2], abs=6e-5))


def test_falling_customers_have_falling_lines(spark):
    rows = [t for month in range(8) for t in txn("down", 15 + 30 * month, fee="60.00", copies=1 + 3 * month)]
    rows += [t for month in range(8) for t in txn("up", 15 + 30 * month, fee="60.00", copies=22 - 3 * month)]
    found = {r.customer_id: r.slope for r in history.health_trend(portfolio(spark, rows)).collect()}
    assert found["down"] < 0 < found["up"]
