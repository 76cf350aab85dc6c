"""Physical plans of key queries contain no shapes that do not scale."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF001

BAD = {
    "cartesian": re.compile(r"CartesianProduct"),
    "nested_loop": re.compile(r"BroadcastNestedLoopJoin"),
    "unpartitioned_window": re.compile(r"Window \[[^\]]*\], \[\]"),
}


@pytest.mark.parametrize("name", ["engineer_sales", "stratified_split", "ks_drift", "group_median",
                                  "lookup_with_fallback", "serving_features", "run_ranking",
                                  "clip_upper_quantile", "drop_rare_categories", "resolve_dimension"])
def test_no_unscalable_plan_shapes(spark, name):
    df = E.queries()[name](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = [k for k, p in BAD.items() if p.search(plan)]
    assert not found, (name, found)


@pytest.mark.parametrize("name", ["run_ranking", "metric_series"])
def test_two_reads_of_the_runs(spark, name):
    df = E.queries()[name](spark, SF001)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[", plan)) <= 2
