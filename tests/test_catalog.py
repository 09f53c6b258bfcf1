"""Every registered query runs on the smallest tables; those with SQL equal it."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_module
from tests.oracle import connect, difference, duck_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = entry_module.queries(), entry_module.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = spark_rows(QUERIES[name](spark, SF_DIR))
    if name in SQL:
        assert difference(got, duck_rows(con, SQL[name])) is None
