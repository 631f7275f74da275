"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check import compare, connect
from shelfmark.oracle import SQL
from shelfmark.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    want = duck.execute(SQL[name]).df()
    assert compare(got, want) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
