"""Every registered query against its SQL on the smallest folder."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from conftest import TINY

ORACLES = entry.oracle_sql()
#: Strict conditions that no row of the smallest folder meets.
MAY_BE_EMPTY = ()


@pytest.fixture(scope="module")
def con():
    return connect(TINY)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    found = compare(spark, con, TINY, entry.queries()[name], ORACLES[name])
    assert found == "" or found == "empty" and name in MAY_BE_EMPTY


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "row_id"
    assert set(ORACLES) <= set(entry.queries())
