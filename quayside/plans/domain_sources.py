"""Mart inputs read from the operational source tables (SRC1, SRC3-SRC5).

Each input is an alias projection of one source table, resolved through a
table source (``sources.tables.catalog_tables`` on a cluster).  Logical table
names are mapped to physical names by ``SOURCE_TABLES``; pass your own map to
the jobs in ``plans.jobs`` when the catalog names differ.  Projections are
lazy: only the columns a mart uses are read, and literal filters (schedule
state, readiness type) are pushed into the scans by the marts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from quayside.sources.tables import TableSource, scan_alias

# Logical input -> physical table name (override per catalog).
SOURCE_TABLES = {
    "voyage_stop_assn": "voyage_stop_assn", "voyage": "voyage", "stop": "stop",
    "stop_arr_dep": "stop_arr_dep", "stop_cut_ava": "stop_cut_ava",
    "svc_operator_assn": "svc_operator_assn", "vessel": "vessel",
    "profm_stop_assn": "profm_stop_assn", "profm_stop": "profm_stop",
    "profm_stop_cut_ava": "prorm_stop_cut_ava", "proforma": "proforma",
    "mfest_info": "mfest_info", "mfest_ready_info": "mfest_ready_info",
    "effective_voyage": "effective_voyage", "vsl_cap_default_assn": "vsl_cap_default_assn",
    "vsl_cap_port_assn": "vsl_cap_port_assn", "vsl_cap_tradelane_assn": "vsl_cap_tradelane_assn",
    "vessel_capacity": "vessel_capacity", "laden_capacity": "laden_capacity",
}

# Mart column <- source column, per input (natural order).
VOYAGE_STOP_ASSN = {"VOY_STOP_ASSN_ID": "VOYAGE_STOP_ASSN_ID", "VOY_CDE": "VOYAGE_CODE",
                    "STOP_ID": "STOP_ID", "VOY_SEQ": "SEQ_IN_VOYAGE"}
VOYAGE = {
    "VOY_CDE": "VOYAGE_CODE", "SVC_CDE": "SERVICE_LOOP_CDE", "VSL_CDE": "VESSEL_CDE",
    "VOY_NUM": "VOYAGE_NUM", "DIR": "DIRECTION", "PREV_VOY_CDE": "PREV_VOYAGE_CODE",
    "NEXT_VOY_CDE": "NEXT_VOYAGE_CODE", "VOY_ID": "VOY_ID", "SSM_VOY_ID": "SSM_VOY_ID",
    "VOY_RMK": "REMARK", "SVC_ID": "SVC_LOOP_ID", "VSL_ID": "VSL_ID",
    "PARENT_PROFM_ID": "PARENT_PROFM_ID", "EXT_REF_VOY": "EXT_VOY_REF",
}
STOP = {
    "STOP_ID": "STOP_ID", "STOP_FCIL_ID": "FACILITY_ID", "STOP_PORT_ID": "PORT_ID",
    "STOP_TZ_NME": "TIMEZONE_NME", "ARR_VOY_CDE": "ARR_VOYAGE_CODE", "DEP_VOY_CDE": "DEP_VOYAGE_CODE",
    "IS_LOAD_ALLOWED": "IS_LOAD_ALLOWED", "IS_DSCH_ALLOWED": "IS_DISCHARGE_ALLOWED",
    "IS_PASS_ALLOWED": "IS_PASS_ALLOWED", "IS_TURNAROUND": "IS_TURNAROUND", "IS_OMITTED": "IS_OMITTED",
    "IS_TENTATIVE_SCHED": "IS_TENTATIVE_SCHEDULE", "DSCH_COMPL_IODT": "DISCHARGE_COMPLETED_IODT",
    "EXT_REF_ARR_VOY": "ARR_EXT_VOY_REF", "EXT_REF_DEP_VOY": "DEP_EXT_VOY_REF",
    "ARR_PORT_CALL_SEQ": "ARR_PORT_CALL_SEQ", "DEP_PORT_CALL_SEQ": "DEP_PORT_CALL_SEQ",
    "STOP_MRU": "MRU", "STOP_RMK": "REMARK", "SSM_STOP_ID": "SSM_VOYAGE_STOP_ID",
    "IS_PHASE_IN_OUT": "IS_PHASE_IN_OUT", "EST_BERTH_ARR_IODT": "EST_BERTH_ARR_IODT",
    "EST_BERTH_DEP_IODT": "EST_BERTH_DEP_IODT", "EST_BERTH_ARR_LOC": "EST_BERTH_ARR_LOC",
    "EST_BERTH_DEP_LOC": "EST_BERTH_DEP_LOC", "LATEST_BERTH_DEP_LOC": "LATEST_BERTH_DEP_LOC",
    "LATEST_BERTH_DEP_IODT": "LATEST_BERTH_DEP_IODT", "FIRST_CBF_CUTOFF_IODT": "FIRST_CBF_CUTOFF_IODT",
    "FIRST_CBF_CUTOFF_LOC": "FIRST_CBF_CUTOFF_LOC", "ERD_IODT": "ERD_IODT", "ERD_LOC": "ERD_LOC",
}
STOP_CUT_AVA = ["STOP_ID", "STOP_CUT_AVA_ID", "CARRIER_ID", "CARGO_NATURE", "TYPE", "DATE_IODT", "DATE_LOC"]
SVC_OPERATOR_ASSN = ["SVC_LOOP_CODE", "VSL_CODE", "OPERATOR", "EFF_START_IODT", "EFF_END_IODT"]
VESSEL = {"VSL_CDE": "CODE", "OPERATOR": "OPERATOR"}
PROFM_STOP_ASSN = {"PROFM_STOP_ASSN_ID": "PROFM_STOP_ASSN_ID", "PROFM_STOP_ID": "PROFM_STOP_ID",
                   "PROFM_SEQ": "SEQ_IN_PROFM", "PROFORMA_ID": "PROFORMA_ID"}
PROFM_STOP = ["PROFM_STOP_ID", "FACILITY_ID", "GMT", "PORT_ID", "ARR_PORT_CALL_SEQ", "DEP_PORT_CALL_SEQ", "ARR_VOYAGE_DIR",
              "DEP_VOYAGE_DIR", "BERTH_ARR_DAY_OFF", "BERTH_ARR_L_HR", "BERTH_ARR_L_MIN", "BERTH_ARR_L_DOW",
              "BERTH_DEP_DAY_OFF", "BERTH_DEP_L_HR", "BERTH_DEP_L_MIN", "BERTH_DEP_L_DOW", "PILOT_ARR_DAY_OFF",
              "PILOT_ARR_L_HR", "PILOT_ARR_L_MIN", "PILOT_ARR_L_DOW", "PILOT_DEP_DAY_OFF", "PILOT_DEP_L_HR",
              "PILOT_DEP_L_MIN", "PILOT_DEP_L_DOW", "ENTRY_HR", "BERTH_HR", "EXIT_HR", "SEA_HR", "PORT_HR",
              "PORT_OCCURRENCE", "IS_LOAD_ALLOWED", "IS_DISCHARGE_ALLOWED", "IS_PASS_ALLOWED", "ENTRY_MIN", "BERTH_MIN",
              "EXIT_MIN", "SEA_MIN", "PORT_MIN", "PRIVATE_CALL"]
# Listed tables without which the mart still holds: their other columns may be missing in a source.
REQUIRED = {"profm_stop": ["PROFM_STOP_ID", "FACILITY_ID", "PORT_ID"]}
PROFORMA = {
    "PROFORMA_ID": "PROFORMA_ID", "SVC_CDE": "SERVICE_LOOP_CDE", "SVC_NME": "NAME", "SVC_TYPE": "TYPE",
    "IS_SSO_LABELED": "IS_SSO_LABELED", "EFF_START_IODT": "EFFECTIVE_START_IODT",
    "EFF_END_IODT": "EFFECTIVE_END_IODT", "REF_DATE_IODT": "REFERENCE_DATE_IODT",
    "SCHEDULE_LENGTH": "SCHEDULE_LENGTH", "SSM_PROFORMA_ID": "SSM_PROFORMA_ID", "SVC_ID": "SVC_LOOP_ID",
    "FREQUENCY": "FREQUENCY", "VENDOR_CDE": "VENDOR_CODE", "VENDOR_NME": "VENDOR_NAME",
    "TERR_CDE": "TERRITORY_CODE", "SCHEDULE_LENGTH_MIN": "SCHEDULE_LENGTH_MIN", "MCS": "MCS",
}
PROFM_CUT_AVA = ["profm_stop_id", "cargo_nature", "type", "date_day_off", "date_l_hr", "date_l_min",
                 "date_l_dow"]
MFEST_INFO = ["mfest_info_id", "owner_ref_num", "submit_type", "is_deleted", "update_iodt"]
MFEST_READY_INFO = ["mfest_info_id", "readiness_state", "readiness_type", "rec_upd_dt"]
EFFECTIVE_VOYAGE = {"EFF_VOY_ID": "EFFECTIVE_VOY_ID", "CARRIER_CDE": "CARRIER_CODE",
                    "SVC_CDE": "SERVICE_LOOP_CODE", "VSL_CDE": "VESSEL_CODE",
                    "EFF_VOY_NUM": "EFFECTIVE_VOY_NUM", "DIRECTION": "DIRECTION"}
VSL_CAP_DEFAULT_ASSN = {"EFF_VOY_ID": "EFFECTIVE_VOY_ID", "DEFAULT_VSL_CAP_ID": "VESSEL_CAPACITY_ID"}
VSL_CAP_PORT_ASSN = {"EFF_VOY_ID": "EFFECTIVE_VOY_ID", "PORT_ID": "PORT_ID",
                     "VSL_CAP_ID": "VESSEL_CAPACITY_ID"}
VSL_CAP_TRADELANE_ASSN = {"EFF_VOY_ID": "EFFECTIVE_VOY_ID", "TRADELANE_CDE": "TRADE_LANE_CODE",
                          "OWNERS_MERIT": "OWNERS_MERIT", "VSL_CAP_ID": "VESSEL_CAPACITY_ID"}
VESSEL_CAPACITY = {"VSL_CAP_ID": "VESSEL_CAPACITY_ID", "CARRIER_CDE": "CARRIER_CODE",
                   "SVC_CDE": "SERVICE_LOOP_CODE", "VSL_CDE": "VESSEL_CODE", "DIRECTION": "DIRECTION",
                   "LADEN_VOL_TEU": "LADEN_VOLUME_TEU", "LADEN_WEIGHT_TON": "LADEN_WEIGHT_IN_TON",
                   "MT_VOL_TEU": "EMPTY_VOLUME_TEU", "MT_WEIGHT_TON": "EMPTY_WEIGHT_IN_TON"}
LADEN_CAPACITY = {"VSL_CAP_ID": "VESSEL_CAPACITY_ID", "CAT_CDE": "CATEGORY", "QTY": "QUANTITY"}
# Stop arrival/departure columns keep their source names; the mart prefixes them.
STOP_ARR_DEP = ["STOP_ID", "SCHEDULE_STATE", "BERTH_ARRIVAL_IODT", "BERTH_DEPARTURE_IODT",
                "BERTH_ARRIVAL_LOC", "BERTH_DEPARTURE_LOC", "PILOT_ARRIVAL_IODT", "PILOT_DEPARTURE_IODT",
                "PILOT_ARRIVAL_LOC", "PILOT_DEPARTURE_LOC", "PORT_ARRIVAL_IODT", "PORT_ARRIVAL_LOC",
                "PORT_WAITING"]


PROJECTIONS = {
    "voyage_stop_assn": VOYAGE_STOP_ASSN, "voyage": VOYAGE, "stop": STOP, "stop_arr_dep": STOP_ARR_DEP,
    "stop_cut_ava": STOP_CUT_AVA, "svc_operator_assn": SVC_OPERATOR_ASSN, "vessel": VESSEL,
    "profm_stop_assn": PROFM_STOP_ASSN, "profm_stop": PROFM_STOP, "profm_stop_cut_ava": PROFM_CUT_AVA, "proforma": PROFORMA,
    "mfest_info": MFEST_INFO, "mfest_ready_info": MFEST_READY_INFO,
    "effective_voyage": EFFECTIVE_VOYAGE, "vsl_cap_default_assn": VSL_CAP_DEFAULT_ASSN,
    "vsl_cap_port_assn": VSL_CAP_PORT_ASSN, "vsl_cap_tradelane_assn": VSL_CAP_TRADELANE_ASSN,
    "vessel_capacity": VESSEL_CAPACITY, "laden_capacity": LADEN_CAPACITY,
}


class DomainInputs:
    """Alias-projected mart inputs over a table source: ``inputs.get("stop")``."""

    def __init__(self, tables: TableSource, names: Mapping[str, str] | None = None):
        self._t = tables
        self._names = {**SOURCE_TABLES, **(names or {})}

    def get(self, logical: str) -> DataFrame:
        table, columns = self._t(self._names[logical]), PROJECTIONS[logical]
        if logical in REQUIRED:
            held = {c.lower() for c in table.columns}
            columns = [c for c in columns if c in REQUIRED[logical] or c.lower() in held]
        return scan_alias(table, columns)
