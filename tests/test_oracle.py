"""Every registered query against its SQL, answered by DuckDB on the same files."""

import pytest

import __spark_entry__ as entry
from tests.support.oracle import compare, connect

# the training-data queries have tests of their own
QUERIES = {n: q for n, q in entry.queries().items() if n not in entry.LLM_QUERIES}
SQL = {n: q for n, q in entry.oracle_sql().items() if n in QUERIES}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf, con, name):
    report = compare(QUERIES[name](spark, sf), con, SQL[name])
    assert report["ok"], report


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
