"""Every query against its SQL counterpart, and the contract of the entry module."""

import oracle
import pytest

import __spark_entry__ as driver

QUERIES, SQL = driver.queries(), driver.oracle_sql()
# Fitted on too few rows at the smallest scale to say anything beyond "it runs". Queries of the training-data
# operators have tests of their own.
ROWS_ONLY = sorted(n for n in set(QUERIES) - set(SQL) if not n.startswith("op") and n != "pipeline")


@pytest.fixture(scope="module")
def con(folder):
    return oracle.connect(folder)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert driver.entry(spark).columns == ["doc_id", "term", "weight"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, folder, con, name):
    rows, problems = oracle.compare(QUERIES[name](spark, folder), con, SQL[name])
    assert not problems
    assert rows > 0


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_query_runs(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0
