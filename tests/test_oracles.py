"""Every registered query against its oracle, strictly by value and type."""

import os

import pytest

import __spark_entry__ as entry_points
from compare import difference, oracle_connection
from recordferry.plans import oracles, queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(queries.queries()) == set(oracles.oracle_sql())
    assert set(queries.queries()) <= set(entry_points.queries())
    assert set(oracles.oracle_sql()) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_matches_oracle(spark, con, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    assert difference(df, con, entry_points.oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    df = entry_points.entry(spark)
    assert df.columns[-1] == "match_condition" and df.count() > 0
