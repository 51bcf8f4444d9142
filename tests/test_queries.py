"""Every registered query against its SQL."""

import pytest

from __spark_entry__ import LLM_QUERIES, entry, oracle_sql, queries
from tests.conftest import SMALL
from tests.oracle import differences, duck


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_sql():
    assert set(queries()) - set(LLM_QUERIES) == set(oracle_sql()) - set(LLM_QUERIES)


def test_entry(spark):
    assert entry(spark).columns == ["commit_id", "is_rollback", "execution_id"]


@pytest.mark.parametrize("name", sorted(set(queries()) & set(oracle_sql())))
def test_same_rows(spark, con, name):
    problem, _ = differences(queries()[name](spark, SMALL), con, oracle_sql()[name])
    assert problem is None, problem
