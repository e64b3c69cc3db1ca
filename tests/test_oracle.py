"""Every query against its SQL twin on the smallest tables."""

import pytest
from check import compare, connect

import __spark_entry__ as entry
from linewatch import catalog
from conftest import SF

# The queries of this part of the library; others have tests of their own.
QUERIES = {n: q for n, q in entry.queries().items() if n in catalog.QUERIES}
ORACLES = {n: q for n, q in entry.oracle_sql().items() if n in QUERIES}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, text = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF)
    assert ok, text


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and all(r["count"] > 0 for r in rows)
