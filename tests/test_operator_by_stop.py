"""The operators of the schedule mart are attached to narrow rows, as ``resolve_operator`` attaches them to the wide ones."""

import os
import re

import pytest
from pyspark.sql import functions as F

from quayside.operators import effective as E
from quayside.operators.lookup import lookup_join
from quayside.session import checkpoint_dir
from tests.conftest import rows

VOYAGES = [(f"V{i}", "S" if i % 3 else None, f"X{i % 4}") for i in range(12)] + [("V1", "S", "X3"), ("V2", "S2", "X2"), (None, "S", "X1")]
CARRIERS = [("P1", c) for c in ("A", "B", "C")] + [("P2", "A"), ("P2", None), ("P3", "B"), (None, "A"), ("P5", None)]
DEPARTURES = [("P1", "20240501"), ("P1", "20240301"), ("P2", None), ("P3", "20240901"), ("P6", "20240101"), (None, "20240101")]
ASSIGNMENTS = [("S", "X1", "O1", "20240101", "20240601"), ("S", "X1", "O2", "20240401", None), ("S", "X2", "O3", "20240801", None),
               (None, "X3", "O4", None, None), (None, "X2", "O5", "20240101", "20240401"), (None, "X1", "O6", None, "20241231"), ("S", "X3", None, "20240101", None)]
VESSELS = [("X0", "D0"), ("X1", "D1"), ("X1", "D9"), ("X2", None)]


def _tables(spark):
    calls = [(v, s, x, p, i * 10 + j) for i, (v, s, x) in enumerate(VOYAGES) for j, p in enumerate(["P1", "P2", "P3", "P4", "P5", "P6", None, "P1"])]
    return (spark.createDataFrame(calls, "VOY_CDE string, SVC_CDE string, VSL_CDE string, STOP_ID string, n int"),
            spark.createDataFrame(CARRIERS, "STOP_ID string, CARRIER_ID string"),
            spark.createDataFrame(DEPARTURES, "STOP_ID string, CSTL_BERTH_DEP_IODT string"),
            spark.createDataFrame(ASSIGNMENTS, "SVC_LOOP_CODE string, VSL_CODE string, OPERATOR string, EFF_START_IODT string, EFF_END_IODT string"),
            spark.createDataFrame(VESSELS, "VSL_CDE string, OPERATOR string"))


@pytest.mark.parametrize("many, more", [(64, []), (2, ["P1", "P2"])])
def test_equals_resolve_operator(spark, monkeypatch, many, more):
    calls, carriers, departures, assignments, vessels = _tables(spark)
    carriers = carriers.unionByName(spark.createDataFrame([(p, c) for p in more for c in "ABDEF"], carriers.schema))

    def widen(d):                                   # a carrier that comes twice gives two rows
        return lookup_join(lookup_join(d, departures, ["STOP_ID"]), carriers.withColumn("x", F.lit(1)), ["STOP_ID"])

    before = E.resolve_operator(widen(calls), assignments, vessels, materialize=None)
    monkeypatch.setattr(E, "MANY", many)
    after = E.resolve_operator_by_stop(calls, carriers, departures, assignments, vessels, widen)
    assert after.columns == before.columns
    assert rows(after) == rows(before)
    assert len({r[-1] for r in rows(after)}) > 3


def test_voyages_with_much_are_resolved_row_by_row(spark, monkeypatch):
    calls, carriers, departures, assignments, vessels = _tables(spark)

    def widen(d):
        return lookup_join(lookup_join(d, departures, ["STOP_ID"]), carriers, ["STOP_ID"])

    want = rows(E.resolve_operator(widen(calls), assignments, vessels, materialize=None))
    folder = f"{checkpoint_dir(spark)}/quayside/first_departures"
    had = set(os.listdir(folder)) if os.path.exists(folder) else set()
    narrow = calls.select("VOY_CDE", "SVC_CDE", "VSL_CDE", "STOP_ID")
    assert rows(E.resolve_operator_by_stop(calls, carriers, departures, assignments, vessels, widen, narrow=narrow)) == want
    assert (set(os.listdir(folder)) if os.path.exists(folder) else set()) == had      # no row for each voyage and carrier
    some = calls.where("VOY_CDE <> 'V4' OR STOP_ID <> 'P1'")
    monkeypatch.setattr(E, "MANY_A_VOYAGE", 8)                                        # V4 has less, the others more
    want = rows(E.resolve_operator(widen(some), assignments, vessels, materialize=None))
    assert rows(E.resolve_operator_by_stop(some, carriers, departures, assignments, vessels, widen)) == want
    assert (set(os.listdir(folder)) if os.path.exists(folder) else set()) != had


def test_many_validity_rows_or_vessels(spark, monkeypatch):
    calls, carriers, departures, assignments, vessels = _tables(spark)
    vessels = vessels.unionByName(spark.createDataFrame([("X0", f"E{i}") for i in range(3)], vessels.schema))
    assignments = assignments.unionByName(spark.createDataFrame([("S", "X1", f"Q{i}", f"20240{i + 1}01", None) for i in range(3)] + [(None, "X2", f"R{i}", None, "20240801") for i in range(4)], assignments.schema))
    carriers = carriers.where("STOP_ID <> 'P1' OR CARRIER_ID <> 'C'")                 # no stop has too many

    def widen(d):
        return lookup_join(lookup_join(d, departures, ["STOP_ID"]), carriers, ["STOP_ID"])

    want = rows(E.resolve_operator(widen(calls), assignments, vessels, materialize=None))
    for many in (64, 3):
        monkeypatch.setattr(E, "MANY", many)
        assert rows(E.resolve_operator_by_stop(calls, carriers, departures, assignments, vessels, widen)) == want


def _mart_tables(spark, folder):
    li = spark.range(400).select(
        (F.col("id") % 60).alias("l_orderkey"), (F.col("id") % 7).cast("int").alias("l_linenumber"), (F.col("id") % 11).alias("l_partkey"),
        (F.col("id") % 5).alias("l_suppkey"), F.col("id").cast("double").alias("l_extendedprice"),
        F.element_at(F.array(*map(F.lit, "ANR")), (F.col("id") % 3 + 1).cast("int")).alias("l_returnflag"),
        F.element_at(F.array(*map(F.lit, "FO")), (F.col("id") % 2 + 1).cast("int")).alias("l_linestatus"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id as int))").alias("l_shipdate"))
    orders = spark.range(60).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 9).alias("o_custkey"), F.lit("5-LOW").alias("o_orderpriority"),
        F.element_at(F.array(*map(F.lit, "FOP")), (F.col("id") % 3 + 1).cast("int")).alias("o_orderstatus"),
        F.lit(30000.0).alias("o_totalprice"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id as int))").alias("o_orderdate"))
    part = spark.range(11).select(F.col("id").alias("p_partkey"), F.lit("B").alias("p_brand"), F.lit("T").alias("p_type"), F.col("id").cast("int").alias("p_size"))
    customer = spark.range(9).select(F.col("id").alias("c_custkey"), F.lit("M").alias("c_mktsegment"))
    for name, t in {"lineitem": li, "orders": orders, "part": part, "customer": customer}.items():
        t.write.parquet(f"{folder}/{name}.parquet")


def test_wide_rows_stay(spark, tmp_path):
    """Neither written nor moved for their operators."""
    from quayside.plans import named
    _mart_tables(spark, tmp_path)
    folder = f"{checkpoint_dir(spark)}/quayside/schedule"
    had = set(os.listdir(folder)) if os.path.exists(folder) else set()
    out = named.QUERIES["schedule_mart"](spark, str(tmp_path))
    assert out.count() >= 400
    assert (set(os.listdir(folder)) if os.path.exists(folder) else set()) == had
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(VOY_CDE#\w+, CARRIER_ID#\w+", plan)


@pytest.mark.parametrize("query", ["schedule_mart", "schedule_mart_chain"])
def test_moves_of_the_calls(spark, tmp_path, query):
    """Two for their sequences, one for the voyage with its sequence and operators, one for the stop's lookups."""
    from quayside.plans import named
    _mart_tables(spark, tmp_path)
    off = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in off}
    try:
        for k in off:
            spark.conf.set(k, "-1")
        out = named.QUERIES[query](spark, str(tmp_path))
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert out.count() >= 400
    lines, moved = plan.splitlines(), []
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(" in line and "VOY_STOP_ASSN_ID" in next((x for x in lines[i + 1:] if re.search(r"Project|Window|Scan", x)), ""):
            moved.append(re.search(r"hashpartitioning\((.*?), \d+\)", line)[1])
    assert [re.sub(r"#\w+", "", m) for m in moved] == ["STOP_ID, __spread" if query == "schedule_mart" else "STOP_ID", "VOY_CDE", "DEP_VOY_CDE, STOP_PORT_ID", "ARR_VOY_CDE, STOP_PORT_ID"]
    assert "hashpartitioning(VOY_CDE" in plan and not re.search(r"hashpartitioning\(VOY_CDE#\w+, STOP", plan)
