"""Every query against its SQL on the smallest sample."""

import os

import pytest

import __spark_entry__ as entry

from .oracle import compare, connect

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    result = QUERIES[name](spark, SF)
    if name in SQL:
        assert compare(result, connection, SQL[name]) == ""
    else:
        assert result.count() > 0
