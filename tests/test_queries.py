"""Registered queries against their SQL."""

import pytest

import __spark_entry__ as entry
from clickloom.plans.oracle import ORACLE
from clickloom.plans.queries import QUERIES
from compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert difference(df, con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["word", "document_count"] and df.count() > 0
