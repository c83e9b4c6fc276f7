"""Every registered query against its SQL on whole driver tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


# The queries of the training-data operators have tests of their own.
OWN = entry._QUERIES


def test_every_query_has_sql():
    assert OWN.keys() == entry._ORACLES.keys()
    assert entry.queries().keys() >= OWN.keys() and entry.oracle_sql().keys() >= OWN.keys()


@pytest.mark.parametrize("name", list(OWN))
def test_query_equals_sql(spark, con, name):
    fn, sql = entry.queries()[name], entry.oracle_sql()[name]
    assert difference(spark, con, SF, fn, sql) is None


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 5
    assert sum(r.n for r in rows) == 1000
