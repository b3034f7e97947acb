"""Plans and partitioning: what must hold for the work to spread over a cluster."""

import os
import random
import re
import pytest
from clientbook.operators import activity
from clientbook.operators.staging import shared_folder
from clientbook.plans import registry, serving, views
from tests.conftest import CFG, DATA, ago, by_customer, portfolio, txn

needs_tables = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def measures_by_hand(rows):
    """Plain Python over the same transactions."""
    out = {}
    for customer in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == customer and r[2] <= ago(0)]
        now = [r for r in mine if r[2] >= CFG.current_start]
        before = [r for r in mine if CFG.prior_start <= r[2] <= CFG.prior_end]
        channels = [r[3] for r in now]
        favourite = min(set(channels), key=lambda x: (-channels.count(x), x)) if channels else None
        out[customer] = (
            sum(int(r[5] * 100) for r in mine if r[2] >= CFG.ltm_start),
            sum(int(r[5] * 100) for r in now),
            sum(int(r[5] * 100) for r in before),
            len(now),
            len(before),
            max(r[2] for r in mine),
            len({r[1] for r in now}),
            sum(x in CFG.digital_channels for x in channels),
            favourite,
        )
    return out


MEASURES = (
    "ltm_pennies",
    "current_pennies",
    "prior_pennies",
    "txn_count_90d",
    "txn_count_prior_90d",
    "last_txn_date",
    "products_active",
    "digital_txns",
    "primary_channel",
)


@pytest.fixture(scope="module")
def skewed():
    """A third of all rows belongs to one customer, and half of those to one product."""
    rng = random.Random(11)
    rows = []
    for i in range(6000):
        customer = "HOT" if i % 3 == 0 else f"C{rng.randint(0, 400):03d}"
        product = "P001" if i % 6 == 0 else f"P00{rng.randint(1, 5)}"
        rows += txn(
            customer,
            rng.randint(0, 500),
            fee=f"{rng.randint(0, 99)}.{rng.randint(10, 99)}",
            product=product,
            channel=rng.choice(["Branch", "Online", "Mobile"]),
        )
    return rows


@pytest.mark.parametrize("partitions, shuffle", [(1, 1), (7, 3), (40, 16)])
def test_measures_under_skew_and_any_partitioning(spark, skewed, partitions, shuffle):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shuffle)
    try:
        transactions = portfolio(spark, skewed).transactions.repartition(partitions)
        found = by_customer(activity.customer_measures(transactions, CFG), *MEASURES)
        short = by_customer(activity.period_totals(transactions, CFG), *MEASURES[:6])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    expected = measures_by_hand(skewed)
    assert found == expected
    assert short == {k: v[:6] for k, v in expected.items()}


def test_hot_customer_reaches_the_shuffle_as_few_rows(spark, skewed):
    transactions = portfolio(spark, skewed).transactions.filter("customer_id = 'HOT'").repartition(4)
    assert transactions.count() == 2000
    for df, most in (
        # 5 products x 3 channels in the current period and one row for older activity, per task
        (activity.customer_measures(transactions, CFG), 4 * (5 * 3 + 1)),
        (activity.period_totals(transactions, CFG), 4),
    ):
        df.collect()
        stages = re.findall(r"ShuffleQueryStage.*?rowCount=([\d.E+]+)\)", final_plan(df), re.S)
        shuffled = sorted(float(n) for n in stages)
        assert shuffled[-1] == 2000  # our own repartition of the raw rows
        assert all(n <= most for n in shuffled[:-1]) and len(shuffled) >= 2


@needs_tables
@pytest.mark.parametrize("name", sorted(set(registry.queries()) - {"publish", "dq_primary_keys"}))
def test_no_python_no_cartesian_product(spark, name):
    text = plan(registry.queries()[name](spark, DATA))
    assert "CartesianProduct" not in text
    assert not re.search(r"Python|MapInPandas|ArrowEval", text)


@needs_tables
@pytest.mark.parametrize(
    "name",
    [
        "customer_360",
        "customer_health",
        "rm_actions",
        "exceptions",
        "exception_feed",
        "customer_watchlist",
        "customer_explorer",
        "explorer_kpis",
        "health_heatmap",
        "priority_agenda",
        "p1_shortfall",
        "customer_segments",
    ],
)
def test_one_pass_over_the_transactions(spark, name):
    text = optimized(registry.queries()[name](spark, DATA))
    assert text.count("l_extendedprice") > 0
    assert len(re.findall(r"Relation \[l_orderkey", text)) == 1
    assert "FullOuter" not in text  # listed customers only: the outer join keeps one side


@needs_tables
def test_dates_and_columns_reach_the_scan(spark):
    df = registry.queries()["customer_segments"](spark, DATA)
    text = plan(df)
    scan = next(line for line in text.splitlines() if "orders.parquet" in line)
    assert "GreaterThanOrEqual(o_orderdate" in scan and "LessThan(o_orderdate" in scan
    assert "o_totalprice" not in scan and "o_orderpriority" not in scan
    assert "part.parquet" not in text
    lines = next(line for line in text.splitlines() if "lineitem.parquet" in line)
    assert "l_tax" not in lines and "l_quantity" not in lines


@needs_tables
def test_totals_take_one_shuffle_and_generated_aggregates(spark):
    df = registry.open_star_schema(spark, DATA, with_product=False).revenue_by_period()
    text = plan(df)
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text
    assert text.count("Exchange hashpartitioning(customer_id") == 1


@needs_tables
def test_large_sides_are_not_forced_to_broadcast(spark):
    for build in (serving.customer_explorer, views.customer_watchlist):
        text = optimized(build(registry.open_star_schema(spark, DATA)))
        assert "strategy=broadcast" not in text


def test_only_the_slice_offsets_are_broadcast_in_the_ladder(spark, skewed):
    text = optimized(views.concentration_ladder(portfolio(spark, skewed)))
    assert text.count("rightHint=(strategy=broadcast)") == 1


class FakeSession:
    """Just enough of a session to ask for its shared folder."""

    def __init__(self, master, folder=None):
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.folder = folder

    def get(self, key, default=None):
        assert key == "spark.checkpoint.dir"
        return self.folder or default

    def getConf(self):
        return self


def test_shared_folder_comes_from_the_session():
    assert shared_folder(FakeSession("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert shared_folder(FakeSession("local[4]", "/mnt/shared")) == "/mnt/shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(FakeSession("spark://host:7077"))
    assert shared_folder(FakeSession("local[2]")) == shared_folder(FakeSession("local[*]"))


def test_results_do_not_depend_on_partitioning(spark, skewed):
    book = portfolio(spark, skewed)
    one = views.concentration_ladder(book).collect()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        again = portfolio(spark, skewed)
        again.transactions = again.transactions.repartition(9, "transaction_id")
        assert views.concentration_ladder(again, slices=11).collect() == one
        assert again.executive_kpis().collect() == book.executive_kpis().collect()
        assert sorted(map(str, again.exceptions().collect())) == sorted(map(str, book.exceptions().collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
