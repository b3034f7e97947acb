"""Releases: a date is served whole or as before; counts, refreshes and key checks."""

from __future__ import annotations

import re

import pytest

from clientbook import Portfolio
from clientbook.plans import quality, releases, snapshot, views
from tests.conftest import CFG, ago, portfolio, txn
from tests.test_scale import final_plan


def plain(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def first_rows():
    rows = [t for i in range(12) for t in txn(f"c{i:02d}", 5 + 7 * i, fee=f"{10 + i}.50", copies=1 + i % 4)]
    return rows + [t for i in range(12) for t in txn(f"c{i:02d}", 120, copies=6)]


NAMES = [f"c{i:02d}" for i in range(12)] + ["quiet"]


@pytest.fixture(scope="module")
def book(spark):
    return portfolio(spark, first_rows(), NAMES)


@pytest.fixture(scope="module")
def released(spark, book, tmp_path_factory):
    return releases.publish(book, str(tmp_path_factory.mktemp("released")))


def test_a_release_holds_every_fact(spark, book, released):
    for table, build in snapshot.FACTS.items():
        assert plain(released.read(spark, table)) == plain(build(book))
    found = releases.latest(spark, released.root, CFG)
    assert found == released and found.rows == released.rows
    assert releases.latest(spark, released.root, CFG.at(ago(1))) is None
    assert plain(views.executive_summary(releases.open_release(spark, found, CFG))) == plain(views.executive_summary(book))


def test_counts_are_taken_while_writing(spark, book, released):
    for table in snapshot.FACTS:
        assert released.rows[table] == released.read(spark, table).count()
        assert released.null_keys[table] == 0
    rows = {r.table_name: (r.row_count, r.is_ok) for r in quality.non_empty_release(spark, released).collect()}
    assert rows == {r.table_name: (r.row_count, r.is_ok) for r in quality.non_empty({t: released.read(spark, t) for t in snapshot.FACTS}).collect()}
    assert plain(quality.release_summary(book, released)) == plain(quality.pipeline_summary(book))
    # No stored table is opened for it.
    assert "Scan parquet" not in final_plan(quality.non_empty_release(spark, released))


def test_a_run_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    released = releases.publish(portfolio(spark, first_rows(), NAMES), root)
    before = plain(releases.open_release(spark, released, CFG).customer_360())

    def fails(book):
        raise RuntimeError("executor lost")

    monkeypatch.setitem(snapshot.FACTS, "fct_exceptions", fails)
    with pytest.raises(RuntimeError, match="lost"):
        releases.publish(portfolio(spark, txn("other", 3)), root)
    served = releases.latest(spark, root, CFG)
    assert served == released
    assert plain(releases.open_release(spark, served, CFG).customer_360()) == before


def test_a_run_that_lacks_tables_is_not_committed(spark, book, tmp_path):
    run = releases.Run(spark, str(tmp_path), CFG)
    run.write(snapshot.BOOK, book.book)
    with pytest.raises(RuntimeError, match="lacks"):
        run.commit()
    assert releases.latest(spark, str(tmp_path), CFG) is None


def test_readers_keep_their_release(spark, tmp_path):
    root = str(tmp_path)
    first = releases.publish(portfolio(spark, first_rows(), NAMES), root)
    reader = releases.open_release(spark, first, CFG)
    second = releases.publish(portfolio(spark, txn("other", 3)), root)
    assert second.sequence == first.sequence + 1
    assert reader.customer_360().count() == len(NAMES)
    now = releases.latest(spark, root, CFG)
    assert now == second and releases.open_release(spark, now, CFG).customer_360().count() == 1


def test_an_empty_run_is_not_released(spark, tmp_path):
    with pytest.raises(ValueError, match="no rows"):
        releases.publish(portfolio(spark, [], []), str(tmp_path))
    assert releases.latest(spark, str(tmp_path), CFG) is None


def people(spark, names, manager="RM001"):
    df = portfolio(spark, [], names).customers
    return df if manager == "RM001" else df.replace({"RM001": manager}, subset=["relationship_manager"])


def test_a_refresh_equals_a_full_run(spark, tmp_path):
    """New transactions, a new customer, one who leaves, one with another manager, and an unlisted earner."""
    old = portfolio(spark, first_rows(), NAMES)
    first = releases.publish(old, str(tmp_path))
    new = txn("c03", 1, fee="900.00", copies=20) + txn("new", 2) + txn("ghost", 2, fee="5.00") + txn(None, 3)
    moved = people(spark, ["c05"], "RM009")
    customers = old.customers.filter("customer_id NOT IN ('c05', 'c07')").union(moved).union(people(spark, ["new"]))
    added = portfolio(spark, new, []).transactions
    now = Portfolio(customers, old.transactions.union(added), CFG)
    changed = releases.changed_customers(added, old.customers, customers)
    assert {r.customer_id for r in changed.collect()} == {"c03", "new", "ghost", None, "c05", "c07"}
    refreshed = releases.refresh(first, now, changed)
    whole = releases.publish(now, str(tmp_path / "whole"))
    for table in (snapshot.BOOK, *snapshot.FACTS):
        assert plain(refreshed.read(spark, table)) == plain(whole.read(spark, table)), table
    # Nothing changed: the same rows again.
    again = releases.refresh(refreshed, now, changed.filter("false"))
    assert plain(again.read(spark, snapshot.BOOK)) == plain(whole.read(spark, snapshot.BOOK))


def test_a_refresh_works_out_changed_customers_only(spark, released, book, monkeypatch):
    seen = []
    scored = releases.scored_book
    monkeypatch.setattr(releases, "scored_book", lambda c, m, cfg: seen.append((c, m)) or scored(c, m, cfg))
    releases.refresh(released, book, book.transactions.filter("customer_id IN ('c01', 'c02')"))
    ((customers, measures),) = seen
    assert {r.customer_id for r in customers.collect()} == {"c01", "c02"}
    assert {r.customer_id for r in measures.collect()} == {"c01", "c02"}


def test_key_checks_share_one_shuffle(spark, released):
    tables = {name: (released.read(spark, name), "snapshot_date" if "kpis" in name else "customer_id") for name in list(snapshot.FACTS)[:3]}
    tables["empty"] = (spark.createDataFrame([], "id bigint"), "id")
    tables["bad"] = (spark.createDataFrame([(1,), (1,), (None,), (2,)], "id bigint"), "id")
    df = quality.primary_keys(tables)
    found = {r.table_name: (r.duplicate_keys, r.surplus_rows, r.null_keys) for r in df.collect()}
    assert found["bad"] == (1, 1, 1) and found["empty"] == (0, 0, 0) and len(found) == 5
    tree = final_plan(df).split("Initial Plan")[0]
    # One exchange by table and key, and one for a row per table.
    assert len(re.findall(r"\bExchange \(", tree)) == 2


