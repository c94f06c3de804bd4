"""Every registered query against its SQL, and what its plan must not hold."""

import pytest

import __spark_entry__ as entry_point
from catalogue import ORACLES, QUERIES
from tools.compare import differences, duck_connection

PAGES = {n for n in QUERIES if n.endswith("_from_pages")} | {"page_errors", "table_round_trip", "races_from_index", "sprint_flag"}


@pytest.fixture(scope="module")
def con(folder):
    return duck_connection(folder)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, con, folder, name):
    assert name in ORACLES
    assert differences(spark, con, folder, name) is None


@pytest.mark.parametrize("name", QUERIES)
def test_plan(spark, folder, name):
    plan = QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroups", "Window ["):
        assert node not in plan
    assert ("MapInArrow" in plan) == (name in PAGES)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
