"""Every registered query against its SQL, on the smallest tables."""

import pytest
from compare import check, connection
from conftest import SMALL

from tidemark.oracle import ORACLE
from tidemark.plans.splits import SET_1, SET_2, label_reach, survey
from tidemark.queries import QUERIES
from tidemark.sources.adapters import order_events, watch_events


@pytest.fixture(scope="module")
def con():
    return connection(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert check(spark, con, name, SMALL) == []


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    without = {"oof_predictions", "oof_scores", "test_predictions", "holdout_predictions", "importance"}
    assert set(QUERIES) - set(ORACLE) == without


@pytest.mark.parametrize("read, column, catalogue", [(watch_events, "ts", SET_1), (order_events, "l_shipdate", SET_2)])
def test_label_ranges_reach_the_scan(spark, read, column, catalogue):
    layout = survey(read(spark, SMALL), catalogue, skew=False)
    plan = read(spark, SMALL, label_reach(layout))._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line and column in line]
    assert any(f"GreaterThanOrEqual({column}" in line and f"LessThan" in line for line in pushed), plan
