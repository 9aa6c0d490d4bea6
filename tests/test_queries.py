"""All registered queries that have SQL against it, on the smallest sample tables."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
NAMES = sorted(ORACLE)


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, con, sf_dir, name):
    assert compare(spark, con, QUERIES[name], ORACLE[name], sf_dir) is None


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns and df.count() > 0
