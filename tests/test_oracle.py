"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from ledgerloom.queries import all_oracles, all_queries
from tests.oracle_check import compare, duck

SF = entry.SMOKE_DIR
SQL = all_oracles()
QUERIES = {name: fn for name, fn in entry.queries().items() if name in all_queries()}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    diff, n = compare(spark, con, SF, QUERIES[name], SQL[name])
    assert diff is None
    assert n > 0
