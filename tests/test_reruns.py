"""Reruns of a date replace it whole or leave it alone; top lists count listed customers."""

from __future__ import annotations

import os

import pytest
from pyspark.errors import AnalysisException

from clientbook.plans import findings, registry, serving, snapshot, views
from tests.conftest import CFG, DATA, portfolio, txn


def _alerting():
    # Busy and lucrative in the prior period, nearly silent now: alerts fire.
    return txn("a", 120, fee="900.00", copies=30) + txn("a", 5, fee="1.00") + txn("b", 5, fee="50.00", copies=3)


def test_rerun_without_alerts_leaves_none(spark, tmp_path):
    root = str(tmp_path)
    snapshot.run_snapshot(portfolio(spark, _alerting()), root)
    assert snapshot.read_fact(spark, root, "fct_exceptions", CFG).count() > 0
    calm = txn("a", 5, copies=5) + txn("a", 100, copies=5)
    stored = snapshot.run_snapshot(portfolio(spark, calm), root)
    wanted = stored.exceptions().count()
    assert snapshot.read_fact(spark, root, "fct_exceptions", CFG).count() == wanted
    assert wanted < 2


def test_rerun_on_empty_inputs_keeps_the_date(spark, tmp_path):
    root = str(tmp_path)
    snapshot.run_snapshot(portfolio(spark, _alerting()), root)
    before = snapshot.read_fact(spark, root, "fct_customer_360", CFG).collect()
    empty = portfolio(spark, txn("a", 5), customers=[])
    with pytest.raises(ValueError):
        snapshot.run_snapshot(empty, root)
    assert snapshot.read_fact(spark, root, "fct_customer_360", CFG).collect() == before
    assert snapshot.is_published(spark, root, CFG)


def test_failed_rerun_is_not_published(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    snapshot.run_snapshot(portfolio(spark, _alerting()), root)

    def fails(book):
        raise RuntimeError("lost")

    monkeypatch.setitem(snapshot.FACTS, "fct_exceptions", fails)
    with pytest.raises(RuntimeError):
        snapshot.run_snapshot(portfolio(spark, _alerting()), root)
    assert not snapshot.is_published(spark, root, CFG)


def test_unlisted_earners_do_not_shorten_top_lists(spark):
    rows = [t for name, fee in (("ghost", "90"), ("a", "50"), ("b", "40"), ("c", "30")) for t in txn(name, 5, fee=fee)]
    book = portfolio(spark, rows, customers=["a", "b", "c"])
    top = serving.top_customers(book, 2).collect()
    assert [(r.customer_id, r.revenue_rank) for r in top] == [("a", 2), ("b", 3)]
    chart = serving.top_customers_chart(book, 2).collect()
    assert [r.revenue_rank for r in chart] == [3, 2]


def test_rank_cliff_covers_every_rank(spark):
    rows = [t for i in range(60) for t in txn(f"c{i:02}", 5, fee=str(100 + i))]
    found = findings.rank_cliff(portfolio(spark, rows))
    assert found.count() == 59
    assert findings.rank_cliff(portfolio(spark, rows), depth=5).count() == 5


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")
def test_left_out_columns_are_missing_not_null(spark):
    bare = registry.open_star_schema(spark, DATA, with_product=False, with_region=False)
    assert "product_id" not in bare.transactions.columns and "region" not in bare.customers.columns
    with pytest.raises(AnalysisException):
        bare.customer_360()
    with pytest.raises(AnalysisException):
        views.customer_watchlist(registry.open_star_schema(spark, DATA, with_region=False))
    assert bare.customer_segments().count() > 0
