"""The registered queries against their SQL; those without SQL have brute-force tests beside this one."""

import os

import pytest

from tests.compare import connect, difference
from tillflow.llm.queries import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_one_query_of_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {n.split("_")[0] for n in QUERIES.keys() - ORACLES.keys()} == {"op1", "op3", "op4", "op7", "op8", "op13"}


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    assert difference(spark, connect(SF), SF, QUERIES[name], ORACLES[name]) is None
