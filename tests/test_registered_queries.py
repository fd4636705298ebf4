"""Every registered query against its SQL on the smallest driver tables."""

import pytest
from oracle_check import connect, difference, kinds

import __spark_entry__ as entry
from quern.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql()[name]
    assert difference(df.toPandas(), con.execute(sql).df()) is None
    assert kinds(df, con, sql) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
