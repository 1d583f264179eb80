"""Every registered query against its oracle SQL on DuckDB."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from catalogue import ORACLES, QUERIES
from tests.oracle import compare, duck

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


# All pairs of two inputs, and Python between the operators.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "MapInArrow", "InPandas")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, connection, plan_of, name):
    df = QUERIES[name](spark, FOLDER)
    assert not [operator for operator in UNWANTED if operator in plan_of(df)]
    assert compare(df, connection, ORACLES[name]) is None


def test_entry(spark):
    df = entry(spark)
    assert df.columns[-1] == "row_num" and df.count() > 0
