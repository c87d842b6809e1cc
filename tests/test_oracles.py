"""Every registered query against its DuckDB oracle, on the sf0.001 tables."""

import pytest

import __spark_entry__ as E
from textloom.checks.compare import compare, duck_connection

SQLS = E.oracle_sql()


@pytest.fixture(scope="module")
def con(sf0001):
    return duck_connection(sf0001)


@pytest.mark.parametrize("key", sorted(SQLS))
def test_query_matches_oracle(spark, con, sf0001, key):
    problems = compare(E.queries()[key](spark, sf0001), con, SQLS[key])
    assert not problems, problems


def test_every_oracle_has_a_query():
    assert set(SQLS) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["row_id", "summary", "label", "source"]
    assert df.count() >= 0
