"""Queries that SQL can express, against DuckDB."""

import pytest

from textloom.checks.compare import compare, duck_connection
from textloom.llm import queries as Q


@pytest.mark.parametrize("key", sorted(Q.ORACLES))
def test_query_matches_oracle(spark, sf0001, key):
    problems = compare(Q.QUERIES[key](spark, sf0001), duck_connection(sf0001), Q.ORACLES[key])
    assert not problems, problems


def test_every_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in Q.QUERIES) == list(range(1, 14))
