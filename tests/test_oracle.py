"""Every registered query against its SQL, on the smallest data set."""

import pytest

import __spark_entry__ as entry
from ledgerloom.plans import catalogue
from oracle import connect, difference

ROOT = "/root/testdata/sf0.001"
PLANS, SQL = catalogue.queries(), catalogue.oracle_sql()   # the llm subpackage brings its own tests


@pytest.fixture(scope="module")
def con():
    return connect(ROOT)


def test_every_query_has_sql():
    assert set(PLANS) == set(SQL)


@pytest.mark.parametrize("key", sorted(PLANS))
def test_query(spark, con, key):
    note = difference(PLANS[key](spark, ROOT), con, SQL[key])
    assert note in (None, "both sides are empty"), note


def test_entry(spark):
    assert entry.entry(spark).count() > 0
