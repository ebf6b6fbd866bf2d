"""Physical-plan properties of every registered query."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

QUERIES = E.queries()
CROSS_OK = {"join_cross", "join_cross_renamed"}
# one-row (or bounded, e.g. hot-key) broadcast sides joined without keys
ONE_ROW_BROADCAST = {"histogram", "impute_mean", "salted_sum", "count_approx", "quantiles_approx", "sample_fraction"}
DISTRIBUTED = ("abc_revenue", "abc_sales", "abc_summary", "running_sum", "running_sum_partitioned", "running_share_sql")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_properties(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan                 # no row-at-a-time Python
    assert "CartesianProduct" not in plan
    if re.search("BroadcastNestedLoopJoin", plan):
        assert name in CROSS_OK | ONE_ROW_BROADCAST, name


@pytest.mark.parametrize("name", DISTRIBUTED)
def test_running_sums_gather_no_rows_in_one_task(spark, name):
    """The only single-partition exchanges are those of the partitions' totals and of the three classes."""
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Window" in line and "windowspecdefinition" in line and "partitionBy" not in line:
            assert "__vireo_pid" in line or "__t" in line or "catrev" in line or "catcount" in line, line
