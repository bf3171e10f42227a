"""Every catalogue query equals its DuckDB counterpart."""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect

SF_DIR = os.environ.get("HAILSTAT_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_counterpart():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) <= set(entry.CORPUS_QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_oracle(spark, con, name):
    assert compare(spark, con, SF_DIR, QUERIES[name], ORACLE[name]) == ""


def test_flagship_query(spark):
    assert entry.entry(spark).count() > 0
