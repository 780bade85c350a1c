"""Plan checks: no cartesian products or nested-loop joins, no Python in
SQL-expressible jobs, the broadcasts and partial top-k where the design expects them."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF01

ORACLES = entry.oracle_sql()


def plan_text(spark, name):
    df = entry.queries()[name](spark, SF01)
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_no_cartesian_or_python(spark, name):
    p = plan_text(spark, name)
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "FlatMapGroupsInPandas" not in p


def test_expected_physical_choices(spark):
    assert "WindowGroupLimit" in plan_text(spark, "top_sellers")       # partial top-k before the shuffle
    assert "WindowGroupLimit" in plan_text(spark, "flyer_feed")
    assert "BroadcastHashJoin" in plan_text(spark, "priced_usage")     # price list broadcast by its measured size
    abt = plan_text(spark, "abt_daily")
    assert "InMemoryTableScan" in abt                                  # fact pre-aggregate read from one persisted copy
    assert "Subquery" in abt or "subquery" in abt                      # theta join as a scalar subquery


def test_forecaster_is_grouped_pandas(spark):
    p = plan_text(spark, "tune_additive")
    assert "FlatMapGroupsInPandas" in p                                # one task per (series, number of changepoints) group
