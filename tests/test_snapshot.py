"""Inputs from CSV, published snapshots, and checks."""

import os

import pytest

from clientbook import Portfolio
from clientbook import schemas as s
from clientbook.plans import findings, quality, registry, serving, snapshot, views
from clientbook.sources import csv_files
from tests.conftest import CFG, ago, portfolio, txn

MANAGERS = "rm_id,rm_name,rm_grade,team\nRM001,Ann,Manager,North\n"
PRODUCTS = "product_id,product_name,product_category,is_core_product\nP001,Loan,Lending,1\n"
CUSTOMERS = (
    "customer_id,customer_name,customer_type,onboarding_date,relationship_manager,region,is_active\n"
    'C1,"Smith, Jones and Co",SME,2020-02-29,RM001,North,1\n'
    "C2,Solo,Retail,2021-01-01,RM001,South,\n"
)
TRANSACTIONS = (
    "transaction_id,customer_id,product_id,transaction_date,transaction_type,channel,transaction_value,fee_revenue\n"
    "T1,C1,P001,2024-01-30,Debit,Online,100.10,1.25\n"
    "T2,C1,P001,2023-10-01,Debit,Branch,50.00,2.50\n"
)


@pytest.fixture
def folder(tmp_path):
    texts = {
        "dim_relationship_managers": MANAGERS,
        "dim_products": PRODUCTS,
        "dim_customers": CUSTOMERS,
        "stg_transactions": TRANSACTIONS,
    }
    for table, path in csv_files.input_paths(str(tmp_path)).items():
        with open(path, "w", encoding="utf-8") as file:
            file.write(texts[table])
    return tmp_path


def test_csv_inputs_are_typed_and_feed_the_model(spark, folder):
    tables = csv_files.load_tables(spark, csv_files.input_paths(str(folder)))
    for name, schema in csv_files.INPUTS.items():
        assert [(f.name, f.dataType) for f in tables[name].schema] == [
            (f.name, f.dataType) for f in schema
        ]
    customers = {r.customer_id: r for r in tables["dim_customers"].collect()}
    assert customers["C1"].customer_name == "Smith, Jones and Co"
    assert customers["C2"].is_active == 1  # default of an empty value
    book = Portfolio(tables["dim_customers"], tables["stg_transactions"], CFG)
    rows = {r.customer_id: r for r in book.customer_360().collect()}
    assert [str(rows["C1"][c]) for c in ("revenue_90d", "revenue_prior_90d", "revenue_delta_pct")] == [
        "1.25",
        "2.50",
        "-50.0000",
    ]
    assert rows["C2"].days_since_last_txn == 999


def test_all_missing_inputs_are_named(spark, folder):
    paths = csv_files.input_paths(str(folder))
    paths["dim_products"] = str(folder / "nowhere.csv")
    paths["stg_transactions"] = str(folder / "nothing" / "*.csv")
    with pytest.raises(csv_files.MissingInputs) as error:
        csv_files.load_tables(spark, paths)
    assert set(error.value.missing) == {"dim_products", "stg_transactions"}


@pytest.mark.parametrize(
    "bad",
    [
        "T3,C1,P001,not-a-date,Debit,Online,1.00,1.00\n",
        "T3,C1,P001,2024-01-01,Debit,Online,plenty,1.00\n",
    ],
)
def test_bad_values_stop_the_load(spark, folder, bad):
    path = csv_files.input_paths(str(folder))["stg_transactions"]
    with open(path, "a", encoding="utf-8") as file:
        file.write(bad)
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        csv_files.read_csv(spark, path, s.TRANSACTIONS).collect()


def test_header_that_differs_from_the_schema_stops_the_load(spark, folder):
    path = csv_files.input_paths(str(folder))["dim_products"]
    with open(path, "w", encoding="utf-8") as file:
        file.write("product_name,product_id,product_category,is_core_product\nLoan,P001,Lending,1\n")
    with pytest.raises(Exception, match="header"):
        csv_files.read_csv(spark, path, s.PRODUCTS).collect()


@pytest.fixture(scope="module")
def book(spark):
    t = txn("a", 5, fee="900.00", copies=12) + txn("a", 100, copies=4) + txn("b", 100, copies=6)
    t += txn("c", 20, channel="Online", copies=3) + txn("c", 120, copies=5) + txn("x", 10, fee="4.00")
    return portfolio(spark, t, ["a", "b", "c", "d"])


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return str(tmp_path_factory.mktemp("published"))


@pytest.fixture(scope="module")
def stored(spark, book, root):
    return snapshot.run_snapshot(book, root)


def sorted_rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("table", snapshot.FACTS)
def test_published_facts_equal_the_lazy_ones(spark, book, stored, root, table):
    lazy = snapshot.FACTS[table](book)
    fact = snapshot.read_fact(spark, root, table, CFG).select(*lazy.columns)
    assert fact.schema.simpleString() == lazy.schema.simpleString()
    assert sorted_rows(fact) == sorted_rows(lazy)


@pytest.mark.parametrize(
    "build",
    [
        views.executive_summary,
        views.customer_watchlist,
        views.concentration_ladder,
        views.health_heatmap,
        views.exception_feed,
        serving.top_customers,
        serving.health_heatmap_pivot,
        serving.customer_explorer,
        serving.explorer_kpis,
        serving.priority_agenda,
        serving.segment_distribution,
        findings.segment_transitions,
        findings.rank_cliff,
        findings.revenue_rank,
    ],
)
def test_views_are_the_same_from_stored_rows(book, stored, build):
    assert build(stored).collect() == build(book).collect()


def test_publishing_again_replaces_only_its_date(spark, book, stored, root):
    earlier = portfolio(spark, txn("a", 70, copies=2), ["a"], CFG.at(ago(60)))
    snapshot.run_snapshot(earlier, root)
    table = os.path.join(root, "fct_customer_360")
    before = spark.read.parquet(table).groupBy("snapshot_date").count().collect()
    assert sorted(r["count"] for r in before) == [1, 4]
    snapshot.run_snapshot(book, root)
    assert sorted(spark.read.parquet(table).groupBy("snapshot_date").count().collect()) == sorted(before)


def test_finished_date_is_left_alone(spark, stored, root):
    changed = portfolio(spark, txn("other", 5), ["other"])
    again = snapshot.run_snapshot(changed, root, overwrite=False)
    assert sorted(r.customer_id for r in again.customer_360().collect()) == ["a", "b", "c", "d"]
    assert not snapshot.is_published(spark, root, CFG.at(ago(1)))


def test_empty_result_stops_the_run(spark, tmp_path):
    with pytest.raises(ValueError, match="fct_customer_360"):
        snapshot.run_snapshot(portfolio(spark, [], []), str(tmp_path))


def test_views_can_be_queried_with_sql(spark, book):
    views.register_views(book)
    (row,) = spark.sql("SELECT max(revenue_rank) AS n FROM v_concentration_ladder").collect()
    assert row.n == 4 or row.n == 3  # the unlisted earner has a rank but no line
    assert spark.sql("SELECT * FROM v_executive_summary").count() == 1


def test_key_check_counts_duplicates_surplus_and_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), ("b",), ("c",), (None,), (None,)], "k string")
    (row,) = quality.primary_keys({"t": (df, "k")}).collect()
    assert (row.table_name, row.duplicate_keys, row.surplus_rows, row.null_keys) == ("t", 2, 3, 2)
    (clean,) = quality.primary_keys({"t": (df.filter("k = 'c'"), "k")}).collect()
    assert (clean.duplicate_keys, clean.surplus_rows, clean.null_keys) == (0, 0, 0)


def test_pipeline_summary(book):
    counts = {r.item: r.row_count for r in quality.pipeline_summary(book).collect()}
    assert counts["Transactions loaded"] == 31
    assert counts["Customers loaded"] == counts["RM actions generated"] == 4
    assert counts["Exceptions detected"] == book.exceptions().count()
    assert counts["Executive KPI snapshots"] == 1


def test_non_empty_verdicts(spark):
    rows = quality.non_empty({"full": spark.range(2), "empty": spark.range(0)}).collect()
    assert [(r.table_name, r.row_count, r.is_ok) for r in rows] == [("full", 2, 1), ("empty", 0, 0)]


def test_plain_types_are_for_comparison_only(spark, book):
    assert book.customer_360().schema["revenue_ltm"].dataType == s.MONEY
    assert registry.plain(book.customer_360()).schema["revenue_ltm"].dataType.simpleString() == "double"
