"""Every registered query beside its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect
from ledgerline.plans.oracles import ORACLES
from ledgerline.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR) == []


def test_flagship(spark):
    assert entry.entry(spark).count() == 10


@pytest.mark.parametrize("name", list(QUERIES))
def test_plan_stays_in_spark(spark, name):
    text = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas"):
        assert word not in text
