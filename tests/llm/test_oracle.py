"""The queries on training text against their SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from ledgerloom.llm.oracle import ORACLE
from tests.oracle_check import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(entry.SMOKE_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    diff, n = compare(spark, con, entry.SMOKE_DIR, entry.queries()[name], entry.oracle_sql()[name])
    assert diff is None and n > 0
