"""Every registered query against its SQL in DuckDB."""

import os

import pytest

import __spark_entry__ as entry_point
from oracle_check import compare, connect
from tillworks.plans import oracle, registry

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = registry.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert compare(QUERIES[name](spark, SF_DIR), duck, SQL[name]) is None


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns[:3] == ["year", "month", "month_name"] and df.count() > 0
