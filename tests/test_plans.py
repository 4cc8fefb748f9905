"""Plan guards: no cartesian products, partial aggregation before shuffles, pruned scans."""

import pytest

import __spark_entry__ as E

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_no_cartesian_or_nested_loop_join(spark, name):
    p = plan(E.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_first_event_aggregates_map_side(spark):
    p = plan(E.queries()["first_bloom"](spark, SF_DIR))
    assert "partial_min" in p and "Window" not in p


def test_monthly_pivot_partial_aggregate_and_pruned_scan(spark):
    df = E.queries()["monthly_pivot"](spark, SF_DIR)
    p = plan(df)
    assert "partial_avg" in p
    scan = [line for line in p.splitlines() if "lineitem" in line and "Scan" in line or "ReadSchema" in line]
    assert not any("l_comment" in line or "l_linestatus" in line for line in scan)


def test_training_set_has_no_unpartitioned_window(spark):
    p = plan(E.entry(spark))
    assert "Window" not in p
