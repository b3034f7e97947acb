"""Stored layout and CSV loads that set bad rows aside."""

from __future__ import annotations

import re
import uuid

import pytest

from clientbook import Portfolio
from clientbook import schemas as s
from clientbook.plans import views
from clientbook.sources import csv_files, layout
from tests.conftest import CFG, portfolio, txn
from tests.test_scale import final_plan


@pytest.fixture(scope="module")
def book(spark):
    rows = [t for i in range(40) for t in txn(f"c{i:02d}", 3 * i, product=f"P{i % 3}", channel=("Online", "Branch")[i % 2], copies=1 + i % 5)]
    return portfolio(spark, rows + txn("c00", 1, copies=60) + txn("ghost", 4), [*[f"c{i:02d}" for i in range(40)], "quiet"])


@pytest.fixture(scope="module")
def stored(spark, book, tmp_path_factory):
    name = f"t{uuid.uuid4().hex}"
    layout.store_inputs(book, name, str(tmp_path_factory.mktemp("buckets")), buckets=4)
    return layout.open_inputs(spark, name, CFG)


def plain(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("build", [Portfolio.customer_360, Portfolio.exceptions, Portfolio.customer_segments, views.customer_watchlist])
def test_bucketed_inputs_give_the_same_rows(book, stored, build):
    assert plain(build(stored)) == plain(build(book))


def exchanges(df):
    return re.findall(r"(\w*Exchange) \(", final_plan(df).split("Initial Plan")[0])


def test_no_shuffle_by_customer(spark, book, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lazy = stored.customer_360()
        lazy.collect()
        assert exchanges(lazy) == []
        # The same question over inputs without a layout.
        plain_inputs = book.customer_360()
        plain_inputs.collect()
        assert len(exchanges(plain_inputs)) > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


TRANSACTIONS = (
    "transaction_id,customer_id,product_id,transaction_date,transaction_type,channel,transaction_value,fee_revenue\n"
    "T1,C1,P001,2024-01-30,Debit,Online,100.10,1.25\n"
    "T2,C1,P001,30/01/2024,Debit,Branch,50.00,2.50\n"
    "T3,C1,P001,2024-01-30,Debit,Branch,plenty,much\n"
    "T4,C1,P001,2024-01-30\n"
    "T5,C1,,,,,,\n"
    ",C1,P001,2024-01-30,Debit,Branch,1.00,1.00\n"
    'T6,"C, 1",P001,2024-01-30,"De""bit",Online,1.00,1.00\n'
    "T7,C1,P001,2024-01-30,Debit,Online,1.00,1.00,more\n"
    "T8,C1,P001,2024-02-30,Debit,Online,1.00,1.00\n"
)


def test_bad_rows_are_set_aside_with_their_faults(spark, tmp_path):
    path = tmp_path / "transactions.csv"
    path.write_text(TRANSACTIONS, encoding="utf-8")
    good, bad = csv_files.read_or_reject(spark, str(path), s.TRANSACTIONS, "transaction_id")
    assert [(f.name, f.dataType) for f in good.schema] == [(f.name, f.dataType) for f in s.TRANSACTIONS]
    rows = {r.transaction_id: r for r in good.collect()}
    assert set(rows) == {"T1", "T5", "T6"}
    assert rows["T6"].customer_id == "C, 1" and rows["T6"].transaction_type == 'De"bit' and rows["T5"].fee_revenue is None
    faults = {r.record: r.faults for r in bad.collect()}
    assert faults == {
        "T2,C1,P001,30/01/2024,Debit,Branch,50.00,2.50": ["transaction_date"],
        "T3,C1,P001,2024-01-30,Debit,Branch,plenty,much": ["transaction_value", "fee_revenue"],
        "T4,C1,P001,2024-01-30": ["record"],
        ",C1,P001,2024-01-30,Debit,Branch,1.00,1.00": ["transaction_id"],
        "T7,C1,P001,2024-01-30,Debit,Online,1.00,1.00,more": ["record"],
        "T8,C1,P001,2024-02-30,Debit,Online,1.00,1.00": ["transaction_date"],
    }


def test_a_file_without_rows_and_a_whole_load(spark, tmp_path):
    header = {name: ",".join(schema.names) + "\n" for name, schema in csv_files.INPUTS.items()}
    header["stg_transactions"] = TRANSACTIONS
    header["dim_customers"] += "C1,One,SME,2020-01-01,RM001,North,\nC2,Two,SME,2020-01-01,RM001,North,x\n"
    paths = csv_files.input_paths(str(tmp_path))
    for name, path in paths.items():
        with open(path, "w", encoding="utf-8") as file:
            file.write(header[name])
    tables, rejects = csv_files.load_or_reject(spark, paths)
    assert tables["dim_products"].count() == 0
    assert [tuple(r) for r in tables["dim_customers"].select("customer_id", "is_active").collect()] == [("C1", 1)]
    counted = {r.table_name: r["count"] for r in rejects.groupBy("table_name").count().collect()}
    assert counted == {"stg_transactions": 6, "dim_customers": 1}
    assert Portfolio(tables["dim_customers"], tables["stg_transactions"], CFG).customer_360().count() == 1


def test_presence_names_each_path(spark, tmp_path):
    (tmp_path / "here.csv").write_text("a\n", encoding="utf-8")
    (tmp_path / "folder").mkdir()
    paths = {"a": f"{tmp_path}/here.csv", "b": f"{tmp_path}/gone.csv", "c": f"{tmp_path}/folder", "d": f"{tmp_path}/*.csv", "e": f"{tmp_path}/*.txt"}
    found = {r.table_name: (r.path, r.is_present) for r in csv_files.presence(spark, paths).collect()}
    assert found == {name: (path, int(name in "acd")) for name, path in paths.items()}
