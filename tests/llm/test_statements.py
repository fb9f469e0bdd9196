"""Queries that have SQL against it, and what all queries share."""

import pytest

from __spark_entry__ import SMOKE, oracle_sql, queries
from stockledger.llm.queries import QUERIES, STATEMENTS
from tests.compare import connect, differences


@pytest.fixture(scope="module")
def con():
    return connect(SMOKE)


@pytest.mark.parametrize("name", list(STATEMENTS))
def test_query_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SMOKE), con, STATEMENTS[name]) == []


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(STATEMENTS) <= set(oracle_sql())
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
