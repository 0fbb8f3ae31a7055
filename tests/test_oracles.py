"""Every registered query against its reference SQL in DuckDB, on the smallest test tables."""

import pytest

import __spark_entry__ as entry
from carelens.testbed import oracles
from carelens.testbed import queries as registered
from tests.compare import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(registered.queries()) == set(oracles.oracle_sql())
    assert set(registered.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query(spark, con, name):
    assert compare(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) == []


def test_flagship(spark):
    assert len(entry.entry(spark).columns) == 73
