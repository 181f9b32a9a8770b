"""The job entry points on tiny tables in the operational source schemas."""

import datetime as dt

from quayside.plans.jobs import run_capacity, run_proforma, run_schedule, run_user_state
from quayside.sources.landing import scratch_table_path
from tests.conftest import rows

RUN = dt.datetime(2024, 1, 1)


def _src(spark, tables):
    frames = {name: spark.createDataFrame(data, schema) for name, (data, schema) in tables.items()}
    return lambda name: frames[name]


def test_user_state_job_writes(spark):
    t = _src(spark, {
        "mfest_info": ([(1, "R1", "AMS", 0, "20240102", 5), (2, "R1", "ABIB", 0, "20240105", 5),
                        (3, "R2", "AMS", 1, "20240101", 5)],
                       "mfest_info_id long, owner_ref_num string, submit_type string, is_deleted int, "
                       "update_iodt string, extra int"),
        "mfest_ready_info": ([(1, "READY", "User", "d1"), (2, "READY", "User", "d2"), (3, "X", "User", "d3")],
                             "mfest_info_id long, readiness_state string, readiness_type string, rec_upd_dt string"),
    })
    path = scratch_table_path(spark, "t-user")
    out = run_user_state(t, target_path=path, run_ts=RUN)
    assert rows(out, "owner_ref_num", "mfest_info_id") == [("R1", 1)]   # ABIB excluded, R2 deleted
    assert spark.read.parquet(path).count() == 1


def _schedule_tables(spark):
    S = "string"
    voy = ("VOYAGE_CODE string, SERVICE_LOOP_CDE string, VESSEL_CDE string, VOYAGE_NUM string, "
           "DIRECTION string, PREV_VOYAGE_CODE string, NEXT_VOYAGE_CODE string, VOY_ID string, "
           "SSM_VOY_ID string, REMARK string, SVC_LOOP_ID string, VSL_ID string, PARENT_PROFM_ID string, "
           "EXT_VOY_REF string")
    from quayside.plans.domain_sources import STOP, STOP_ARR_DEP
    stop_schema = ", ".join(f"{c} {S}" for c in STOP.values())
    stop_row = {c: None for c in STOP.values()}
    stops = []
    for sid, port in (("S1", "P1"), ("S2", "P2")):
        r = dict(stop_row, STOP_ID=sid, PORT_ID=port, ARR_VOYAGE_CODE="V0", DEP_VOYAGE_CODE="V1")
        stops.append(tuple(r[c] for c in STOP.values()))
    ad_schema = ", ".join(f"{c} {S}" for c in STOP_ARR_DEP)
    ad = [("S1", "Coastal", "a1", "20240110") + (None,) * 9, ("S2", "Actual", "a2", "20240120") + (None,) * 9]
    return {
        "voyage_stop_assn": ([("A1", "V1", "S1", 1), ("A2", "V1", "S2", 2)],
                             "VOYAGE_STOP_ASSN_ID string, VOYAGE_CODE string, STOP_ID string, SEQ_IN_VOYAGE int"),
        "voyage": ([("V1", "SVC", "VSL") + (None,) * 11], voy),
        "stop": (stops, stop_schema),
        "stop_arr_dep": (ad, ad_schema),
        "stop_cut_ava": ([("S1", "C1", "CA", "DG", "Cutoff", "d1", "l1", "x", "y", "z", "w"),
                          ("S2", "C1", "CB", "DG", "Cutoff", "d2", "l2", "x", "y", "z", "w")],
                         "STOP_ID string, CARRIER_ID string, STOP_CUT_AVA_ID string, CARGO_NATURE string, "
                         "TYPE string, DATE_IODT string, DATE_LOC string, CREATE_IODT string, CREATE_BY string, "
                         "UPDATE_IODT string, UPDATE_BY string"),
        "svc_operator_assn": ([("SVC", "VSL", "OPX", "20240101", None)],
                              "SVC_LOOP_CODE string, VSL_CODE string, OPERATOR string, EFF_START_IODT string, "
                              "EFF_END_IODT string"),
        "vessel": ([("VSL", "DEF")], "CODE string, OPERATOR string"),
    }


def test_schedule_job(spark):
    t = _src(spark, _schedule_tables(spark))
    for strategy in ("pivot", "chain"):
        out = run_schedule(t, run_ts=RUN, strategy=strategy)
        assert rows(out, "STOP_ID", "CARRIER_ID", "PORT_CALL_SEQ", "LTT_BERTH_DEP_IODT", "DG_CUT_IODT",
                    "OPERATOR") == [("S1", "C1", 1, "20240110", "d1", "OPX"),
                                    ("S2", "C1", 1, "20240120", "d2", "OPX")]


def test_proforma_job(spark):
    t = _src(spark, {
        "profm_stop_assn": ([("PA1", "PS1", 1, "PF1")],
                            "PROFM_STOP_ASSN_ID string, PROFM_STOP_ID string, SEQ_IN_PROFM int, PROFORMA_ID string"),
        "profm_stop": ([("PS1", "F1", "P1")], "PROFM_STOP_ID string, FACILITY_ID string, PORT_ID string"),
        "prorm_stop_cut_ava": ([("PS1", "DG", "Cutoff", 2, 10, 30, 3), ("PS1", "DG", "Cutoff", 1, 11, 0, 4)],
                               "profm_stop_id string, cargo_nature string, type string, date_day_off int, "
                               "date_l_hr int, date_l_min int, date_l_dow int"),
        "proforma": ([("PF1", "SVC", "Name") + (None,) * 14],
                     "PROFORMA_ID string, SERVICE_LOOP_CDE string, NAME string, TYPE string, IS_SSO_LABELED string, "
                     "EFFECTIVE_START_IODT string, EFFECTIVE_END_IODT string, REFERENCE_DATE_IODT string, "
                     "SCHEDULE_LENGTH string, SSM_PROFORMA_ID string, SVC_LOOP_ID string, FREQUENCY string, "
                     "VENDOR_CODE string, VENDOR_NAME string, TERRITORY_CODE string, SCHEDULE_LENGTH_MIN string, "
                     "MCS string"),
    })
    out = run_proforma(t, run_ts=RUN, num_files=5)
    assert out.rdd.getNumPartitions() == 5
    assert rows(out, "PROFM_STOP_ID", "dg_cut_date_day_off", "dg_cut_date_l_hr", "rf_cut_date_day_off",
                "SVC_CDE") == [("PS1", 2, 11, None, "SVC")]


def test_capacity_job(spark):
    t = _src(spark, {
        "effective_voyage": ([("E1", "CAR", "SVC", "VSL", "N1", "EAST")],
                             "EFFECTIVE_VOY_ID string, CARRIER_CODE string, SERVICE_LOOP_CODE string, "
                             "VESSEL_CODE string, EFFECTIVE_VOY_NUM string, DIRECTION string"),
        "vsl_cap_default_assn": ([("E1", "K0")], "EFFECTIVE_VOY_ID string, VESSEL_CAPACITY_ID string"),
        "vsl_cap_port_assn": ([("E1", "P1", "K1"), ("E1", "P2", "K1")],
                              "EFFECTIVE_VOY_ID string, PORT_ID string, VESSEL_CAPACITY_ID string"),
        "vessel_capacity": ([("K1", "CAR", "SVC", "VSL", "WEST", 1.0, 2.0, 3.0, 4.0)],
                            "VESSEL_CAPACITY_ID string, CARRIER_CODE string, SERVICE_LOOP_CODE string, "
                            "VESSEL_CODE string, DIRECTION string, LADEN_VOLUME_TEU double, "
                            "LADEN_WEIGHT_IN_TON double, EMPTY_VOLUME_TEU double, EMPTY_WEIGHT_IN_TON double"),
        "laden_capacity": ([("K1", "BOX_20_MIN", 5), ("K1", "BOX_20_MIN", 1), ("K1", "OTHER", 9)],
                           "VESSEL_CAPACITY_ID string, CATEGORY string, QUANTITY int"),
    })
    out = run_capacity(t)
    assert rows(out, "PORT_ID", "DIR", "CAP_DIR", "MIN_20FT", "MAX_40FT") == [
        ("P1", "E", "W", 6, None), ("P2", "E", "W", 6, None)]


def test_user_state_job_from_catalog_views(spark):
    from quayside.sources.tables import catalog_tables
    spark.createDataFrame([(1, "R1", "AMS", 0, "20240102")],
                          "mfest_info_id long, owner_ref_num string, submit_type string, is_deleted int, "
                          "update_iodt string").createOrReplaceTempView("mf_info_v")
    spark.createDataFrame([(1, "READY", "User", "d1")],
                          "mfest_info_id long, readiness_state string, readiness_type string, rec_upd_dt string"
                          ).createOrReplaceTempView("mf_ready_v")
    out = run_user_state(catalog_tables(spark), names={"mfest_info": "mf_info_v",
                                                       "mfest_ready_info": "mf_ready_v"}, run_ts=RUN)
    assert rows(out, "owner_ref_num", "readiness_state_distinct") == [("R1", "READY")]
