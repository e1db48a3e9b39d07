"""The text queries that SQL can express, against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from conftest import TINY
from oddspend.llm.sql import oracle_sql


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(TINY), TINY, entry.queries()[name], oracle_sql()[name]) == ""
