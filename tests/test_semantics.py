"""Hand fixtures for the semantics the marts must keep."""

import pytest

from quayside.functions.scalar import bucket_start
from quayside.operators import effective as E
from quayside.operators.filters import not_in_keys, not_suffix
from quayside.operators.latest import latest_per_key
from quayside.operators.lookup import lookup_join, with_state_lookups
from quayside.operators.reshape import coalesce_precedence, fixed_pivot
from quayside.operators.sequence import with_sequences
from quayside.plans.proforma import cut_ava_columns
from quayside.plans.schedule import with_cut_ava
from quayside.plans.user_state import user_state_mart
from tests.conftest import rows

STATES = {"LongTerm": "LGMT", "Coastal": "CSTL", "Actual": "ACTL"}
FIELDS = {"BERTH_DEP_IODT": "BERTH_DEPARTURE_IODT"}


def test_s1_missing_state_kept_and_coalesced(spark):
    spine = spark.createDataFrame([("S1",), ("S2",)], "STOP_ID string")
    arr = spark.createDataFrame([("S1", "Coastal", "20240102000000")],
                                "STOP_ID string, SCHEDULE_STATE string, BERTH_DEPARTURE_IODT string")
    for strategy in ("chain", "pivot"):
        out = with_state_lookups(spine, arr, ["STOP_ID"], "SCHEDULE_STATE", STATES, FIELDS,
                                 strategy=strategy)
        out = coalesce_precedence(out, ["ACTL", "CSTL", "LGMT"], ["BERTH_DEP_IODT"], "LTT")
        assert rows(out, "STOP_ID", "LTT_BERTH_DEP_IODT", "CSTL_BERTH_DEP_IODT") == [
            ("S1", "20240102000000", "20240102000000"), ("S2", None, None)]


def test_s1_precedence_actual_first(spark):
    spine = spark.createDataFrame([("S1",)], "STOP_ID string")
    arr = spark.createDataFrame([("S1", "Coastal", "c"), ("S1", "Actual", "a"), ("S1", "LongTerm", "l")],
                                "STOP_ID string, SCHEDULE_STATE string, BERTH_DEPARTURE_IODT string")
    out = with_state_lookups(spine, arr, ["STOP_ID"], "SCHEDULE_STATE", STATES, FIELDS, strategy="pivot")
    out = coalesce_precedence(out, ["ACTL", "CSTL", "LGMT"], ["BERTH_DEP_IODT"], "LTT")
    assert rows(out, "LTT_BERTH_DEP_IODT") == [("a",)]


CUT_SCHEMA = "STOP_ID string, CARRIER_ID string, CARGO_NATURE string, TYPE string, DATE_IODT string, DATE_LOC string"
COMBOS = [("DG", "Cutoff"), ("RF", "Cutoff")]


def _cut(spark, data):
    return spark.createDataFrame(data, CUT_SCHEMA)


@pytest.mark.parametrize("strategy", ["chain", "pivot"])
def test_s2_carrier_anchoring(spark, strategy):
    spine = spark.createDataFrame([("A",), ("B",), ("C",)], "STOP_ID string")
    cut = _cut(spark, [
        ("A", "C1", "DG", "Cutoff", "d1", "l1"), ("A", "C2", "DG", "Cutoff", "d2", "l2"),   # S2a
        ("B", "C1", "DG", "Cutoff", "d3", "l3"), ("B", "C2", "RF", "Cutoff", "r4", "l4"),   # S2b
        ("C", "C3", "RF", "Cutoff", "r5", "l5"),                                            # S2c
    ])
    faithful = with_cut_ava(spine, cut, COMBOS, anchor="dg_cutoff", strategy=strategy)
    assert rows(faithful, "STOP_ID", "CARRIER_ID", "DG_CUT_IODT", "RF_CUT_IODT") == [
        ("A", "C1", "d1", None), ("A", "C2", "d2", None), ("B", "C1", "d3", None), ("C", None, None, None)]
    every = with_cut_ava(spine, cut, COMBOS, anchor="all_carriers", strategy=strategy)
    assert rows(every, "STOP_ID", "CARRIER_ID", "DG_CUT_IODT", "RF_CUT_IODT") == [
        ("A", "C1", "d1", None), ("A", "C2", "d2", None), ("B", "C1", "d3", None),
        ("B", "C2", None, "r4"), ("C", "C3", None, "r5")]


def test_s9_null_nature_ignored_by_pivots(spark):
    spine = spark.createDataFrame([("A",)], "STOP_ID string")
    cut = _cut(spark, [("A", "C1", "DG", "Cutoff", "d1", "l1"), ("A", "C1", None, "Cutoff", "x", "x")])
    out = with_cut_ava(spine, cut, COMBOS, strategy="pivot")
    assert rows(out, "CARRIER_ID", "DG_CUT_IODT") == [("C1", "d1")]
    pcut = spark.createDataFrame([("P", None, "Cutoff", 3), ("P", "DG", None, 4), ("P", "DG", "Cutoff", 5)],
                                 "profm_stop_id string, cargo_nature string, type string, date_day_off int")
    for formulation in ("conditional", "map"):   # the map form must not raise NULL_MAP_KEY
        w = cut_ava_columns(pcut, measures={"date_day_off": "date_day_off"}, formulation=formulation)
        assert rows(w, "dg_cut_date_day_off", "gc_cut_date_day_off") == [(5, None)]


def test_s10_duplicates_multiply_under_both_strategies(spark):
    spine = spark.createDataFrame([("A",), ("B",), (None,)], "STOP_ID string")
    cut = _cut(spark, [("A", "C1", "DG", "Cutoff", "d1", "l1"), ("A", "C1", "DG", "Cutoff", "d2", "l2"),
                       ("A", "C1", "RF", "Cutoff", "r1", "l1"), ("A", "C1", "RF", "Cutoff", "r2", "l2"),
                       ("A", None, "DG", "Cutoff", "d3", None), ("A", None, "RF", "Cutoff", "r3", None),
                       ("B", None, "RF", "Cutoff", "r4", None), (None, "C1", "DG", "Cutoff", "d5", None)])
    for anchor in ("dg_cutoff", "all_carriers"):
        chain = with_cut_ava(spine, cut, COMBOS, anchor=anchor, strategy="chain")
        pivot = with_cut_ava(spine, cut, COMBOS, anchor=anchor, strategy="pivot")
        assert rows(pivot, *chain.columns) == rows(chain) and pivot.count() == chain.count()
    one = with_cut_ava(spine, cut, COMBOS[:1], strategy="pivot")        # a single combination
    assert rows(one) == rows(with_cut_ava(spine, cut, COMBOS[:1], strategy="chain"), *one.columns)


def test_s3_sequences_before_fan_out(spark):
    spine = spark.createDataFrame([("V1", 1, "S1", "P1"), ("V1", 2, "S2", "P1")],
                                  "VOY_CDE string, VOY_SEQ int, STOP_ID string, STOP_PORT_ID string")
    seq = with_sequences(spine, {"PORT_CALL_SEQ": (["VOY_CDE", "STOP_PORT_ID"], ["VOY_SEQ", "STOP_ID"])})
    cut = _cut(spark, [(s, c, "DG", "Cutoff", "d", "l") for s in ("S1", "S2") for c in ("C1", "C2")])
    out = with_cut_ava(seq, cut, COMBOS)
    assert rows(out, "CARRIER_ID", "PORT_CALL_SEQ") == [("C1", 1), ("C1", 2), ("C2", 1), ("C2", 2)]


ASSN = "SVC_LOOP_CODE string, VSL_CODE string, OPERATOR string, EFF_START_IODT string, EFF_END_IODT string"
VSCH = "VOY_CDE string, SVC_CDE string, VSL_CDE string, CARRIER_ID string, CSTL_BERTH_DEP_IODT string"


def _resolve(spark, sched, assn, vessels):
    s = spark.createDataFrame(sched, VSCH)
    a = spark.createDataFrame(assn, ASSN)
    v = spark.createDataFrame(vessels, "VSL_CDE string, OPERATOR string")
    return E.resolve_operator(s, a, v, materialize=None)


def test_s4_null_carrier_gets_no_operator(spark):
    out = _resolve(spark, [("V1", "S", "X", None, "20240501")],
                   [("S", "X", "OPA", "20240101", None)], [("X", "DEF")])
    assert rows(out, "VOY_CDE", "CARRIER_ID", "OPERATOR") == [("V1", None, None)]


def test_s5_bounds_inclusive_and_tier_rules(spark):
    fd = spark.createDataFrame([("V1", "S", "X", "C", "20240501")],
                               "VOY_CDE string, SVC_CDE string, VSL_CDE string, CARRIER_ID string, F_BERTH_DEP_IODT string")
    a = spark.createDataFrame([
        ("S", "X", "T1_START_EQ", "20240501", "20240601"),
        ("S", "X", "T1_END_EQ", "20240401", "20240501"),
        ("S", "X", "T1_NULL_START", None, "20240601"),        # tier 1: NULL start never matches
    ], ASSN)
    assert rows(E.service_operators(fd, a), "OPERATOR") == [("T1_END_EQ",), ("T1_START_EQ",)]
    a2 = spark.createDataFrame([("", "X", "unused", "1", "1")], ASSN).where("false").unionByName(
        spark.createDataFrame([(None, "X", "T2_OPEN_START", None, "20240501"),
                               (None, "X", "T2_OPEN_END", "20240501", None)], ASSN))
    assert rows(E.service_operators(fd, a2), "OPERATOR") == [("T2_OPEN_END",), ("T2_OPEN_START",)]


def test_s6_unknown_departure_matches_only_fully_open_tier2(spark):
    fd = spark.createDataFrame([("V1", "S", "X", "C", None)],
                               "VOY_CDE string, SVC_CDE string, VSL_CDE string, CARRIER_ID string, F_BERTH_DEP_IODT string")
    a = spark.createDataFrame([(None, "X", "OPEN", None, None), (None, "X", "HALF", None, "2099"),
                               ("S", "X", "T1", "2000", None)], ASSN)
    assert rows(E.service_operators(fd, a), "OPERATOR") == [("OPEN",)]


def test_s7a_expired_tier1_lets_tier2_in_then_vessel_default(spark):
    out = _resolve(spark, [("V1", "S", "X", "C", "20240501")],
                   [("S", "X", "OP_OLD", "20240101", "20240301"), ("S", "X", "OP_B", "20240401", None),
                    (None, "X", "OP_C", None, None)], [("X", "OP_V")])
    assert rows(out, "VOY_CDE", "CARRIER_ID", "OPERATOR") == [("V1", "C", "OP_V")]


def test_s7b_one_singleton_carrier_admits_the_whole_voyage(spark):
    out = _resolve(spark, [("V2", "S", "X", "A", "20240105"), ("V2", "S", "X", "B", "20240115")],
                   [("S", "X", "OP1", "20240101", None), ("S", "X", "OP2", "20240110", None)],
                   [("X", "OP_V")])
    assert rows(out, "CARRIER_ID", "OPERATOR") == [("A", "OP1"), ("B", "OP1"), ("B", "OP2")]


def test_s8_latest_ties_and_nulls(spark):
    info = spark.createDataFrame([
        (1, "R1", "AMS", 0, "20240102"), (2, "R1", "AMS", 0, "20240102"),    # tie -> id 2
        (3, "R2", "AMS", 0, None), (4, "R2", "AMS", 0, None),                # all NULL -> kept, id 4
        (5, "R3", "AMS", 0, None), (6, "R3", "AMS", 0, "20240101"),           # NULL last
    ], "mfest_info_id long, owner_ref_num string, submit_type string, is_deleted int, update_iodt string")
    ready = spark.createDataFrame([(i, f"st{i}", "User", "x") for i in range(1, 7)],
                                  "mfest_info_id long, readiness_state string, readiness_type string, rec_upd_dt string")
    out = user_state_mart(info, ready)
    assert rows(out, "owner_ref_num", "mfest_info_id", "readiness_state_distinct") == [
        ("R1", 2, "st2"), ("R2", 4, "st4"), ("R3", 6, "st6")]
    w = latest_per_key(info, ["owner_ref_num"], ["update_iodt"], ["mfest_info_id"], ["mfest_info_id"],
                       strategy="window")
    assert rows(w) == [("R1", 2), ("R2", 4), ("R3", 6)]


def test_f3_suffix_filter_drops_null(spark):
    df = spark.createDataFrame([("ABIB",), ("IBX",), (None,)], "submit_type string")
    assert rows(df.where(not_suffix("submit_type", "IB"))) == [("IBX",)]


def test_f8_not_in_null_rules(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    listed = spark.createDataFrame([("a",)], "k string")
    assert rows(not_in_keys(df, listed, ["k"])) == [("b",)]
    empty = listed.where("false")
    assert rows(not_in_keys(df, empty, ["k"])) == [("a",), ("b",), (None,)]


def test_s9_malformed_time_string_gives_null_bucket(spark):
    df = spark.createDataFrame([("20240131120000",), ("garbage",), (None,)], "create_iodt string")
    out = df.select(bucket_start("create_iodt", 31, from_string=True).alias("b"),
                    bucket_start("create_iodt", 10, from_string=True).alias("b10"))
    assert rows(out) == [("202401", "20240131"), (None, None), (None, None)]


def test_a5_fixed_pivot(spark):
    df = spark.createDataFrame([("V1", "BOX_20_MIN", 2), ("V1", "BOX_20_MIN", 3), ("V1", "ODD", 9),
                                ("V2", "ODD", 1)], "VSL_CAP_ID string, CAT_CDE string, QTY int")
    out = fixed_pivot(df, ["VSL_CAP_ID"], "CAT_CDE", {"BOX_20_MIN": "MIN_20FT", "BOX_40_MAX": "MAX_40FT"}, "QTY")
    assert rows(out, "VSL_CAP_ID", "MIN_20FT", "MAX_40FT") == [("V1", 5, None), ("V2", None, None)]


def test_lookup_rejects_column_clash(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    with pytest.raises(ValueError):
        lookup_join(a, a, ["k"])


def test_pruned_pivot_keeps_its_rows(spark):
    """Rows multiply the same when none or one of the pivoted columns is used."""
    spine = spark.createDataFrame([("S1",), ("S2",)], "STOP_ID string")
    arr = spark.createDataFrame([("S1", "Coastal", "a"), ("S1", "Coastal", "b")],
                                "STOP_ID string, SCHEDULE_STATE string, BERTH_DEPARTURE_IODT string")
    for how in ("left", "inner"):
        pivot, chain = (with_state_lookups(spine, arr, ["STOP_ID"], "SCHEDULE_STATE", {"Coastal": "CSTL"}, FIELDS, how=how,
                                           strategy=s) for s in ("pivot", "chain"))
        assert pivot.count() == chain.count() and rows(pivot) == rows(chain)
        assert rows(pivot.select("STOP_ID")) == rows(chain.select("STOP_ID"))


def test_small_helpers(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from quayside.functions.scalar import nested_get, nvl, run_timestamp
    from quayside.operators.filters import any_present
    from quayside.streaming.refresh import Feed, purge_tombstones
    df = spark.createDataFrame([(None, None), ("a", None), (None, "b")], "x string, y string")
    assert df.where(any_present("x", "y")).count() == 2
    assert rows(df.select(nvl("x", "y").alias("v"))) == [("a",), ("b",), (None,)]
    m = spark.createDataFrame([("DG", "Cutoff", 5)], "n string, t string, v int").select(
        F.create_map("n", F.create_map("t", "v")).alias("m"))
    assert m.select(nested_get("m", "DG", "Cutoff").alias("a"), nested_get("m", "RF", "Cutoff").alias("b")
                    ).collect()[0] == (5, None)
    ts = spark.range(1).select(run_timestamp(dt.datetime(2024, 1, 1)).alias("t")).collect()[0][0]
    assert ts == dt.datetime(2024, 1, 1)
    st = spark.createDataFrame([("k1", 1, True), ("k2", 1, False), ("k3", 9, True)],
                               "pk string, change_ts int, is_deleted boolean")
    assert rows(purge_tombstones(st, Feed(pk="pk", payload=()), 5), "pk") == [("k2",), ("k3",)]


def test_pivot_holds_one_row_of_a_key(spark):
    """Equal to the chain when some keys have several rows for some states, and no aggregate collects them."""
    spine = spark.createDataFrame([("A",), ("A",), ("B",), ("C",), ("D",), (None,)], "STOP_ID string")
    arr = spark.createDataFrame(
        [("A", "Coastal", f"a{i}") for i in range(30)] + [("A", "Actual", "x"), ("B", "Actual", "b"), ("B", "Coastal", None),
         ("B", "Coastal", "c"), ("C", "Coastal", None), ("C", "Actual", "d"), ("E", "Actual", "e")] + [(None, "Coastal", "n")] * 30,
        "STOP_ID string, SCHEDULE_STATE string, BERTH_DEPARTURE_IODT string")
    states = {"Coastal": "CSTL", "Actual": "ACTL"}
    for how in ("left", "inner"):
        pivot, chain = (with_state_lookups(spine, arr, ["STOP_ID"], "SCHEDULE_STATE", states, FIELDS, how=how, strategy=s)
                        for s in ("pivot", "chain"))
        assert pivot.columns == chain.columns and rows(pivot) == rows(chain) and pivot.count() == chain.count()
        assert "collect_list" not in pivot._jdf.queryExecution().toString()
    cut = _cut(spark, [("A", "C1", "DG", "Cutoff", f"d{i}", None) for i in range(3)] + [("A", "C2", "DG", "Cutoff", "e", "l"),
                       ("A", None, "DG", "Cutoff", "f", "l"), ("A", None, "DG", "Cutoff", "g", "l"), ("A", "C2", "RF", "Cutoff", "r", "l"),
                       ("A", "C2", "RF", "Cutoff", "s", "l"), ("B", "C3", "RF", "Cutoff", "t", "l"), ("C", "C1", "DG", "Cutoff", "u", "l")]
               + [(None, None, "DG", "Cutoff", "n", None)] * 5)
    for anchor in ("dg_cutoff", "all_carriers"):
        pivot, chain = (with_cut_ava(spine, cut, COMBOS, anchor=anchor, strategy=s) for s in ("pivot", "chain"))
        assert rows(pivot, *chain.columns) == rows(chain) and pivot.count() == chain.count()
        assert "collect_list" not in pivot._jdf.queryExecution().toString()
