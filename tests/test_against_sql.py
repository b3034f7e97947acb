"""Every registered query against its SQL over the given tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from clientbook.plans import registry  # noqa: E402
from tests.conftest import DATA  # noqa: E402
from verification import duckdb_sql  # noqa: E402
from verification.compare import difference, duck  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(DATA)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(duckdb_sql.oracle_sql())
    # What else the contract offers has tests of its own.
    assert set(registry.queries()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_sql(spark, con, name):
    assert difference(spark, con, name, DATA) is None


def test_entry_returns_one_row(spark):
    assert contract.entry(spark).count() == 1
