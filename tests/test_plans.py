"""Plan shape checks: pruning and pushdown reach the scan, latest-per-key is
a partial aggregate (no sort, no window), NOT IN needs no driver list."""

import __spark_entry__ as entry
from quayside.operators.latest import latest_per_key

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_user_state_prunes_and_pushes_down(spark):
    p = _plan(entry.queries()["user_state_latest"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_linestatus), EqualTo(l_linestatus,F)" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string,l_linestatus:string,l_shipdate:timestamp_ntz>" in p
    # map-side partial aggregate, no window over all rows
    assert "partial_max" in p and "Window" not in p


def test_latest_is_partial_aggregate(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS t", "id AS v")
    p = _plan(latest_per_key(df, ["k"], ["t"], ["v"]))
    assert "partial_max" in p and "Window" not in p


def test_anti_join_not_collect(spark):
    p = _plan(entry.queries()["anti_singleton"](spark, SF))
    # the "list is empty" test is a one-row scalar subquery, not a collected list
    assert "LeftAnti" in p and "CollectLimit 1" in p
