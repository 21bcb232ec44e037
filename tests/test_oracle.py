"""Every query with SQL against that SQL, over whole tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SF = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    verdict = compare(spark, con, QUERIES[name], SQL.get(name), SF)
    assert verdict.startswith(("ok", "rows only")), verdict


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
