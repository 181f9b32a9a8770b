"""Domain-shaped inputs derived from the shared test tables.

The marts are written against the domain's own column names (voyages,
stops, carriers, manifests).  The test tables are a TPC-H-like star schema,
so each domain input is an alias projection (SRC1) of one test table:

    orders    -> voyage, manifest header,
                 operator validity rows
    lineitem  -> voyage-stop association, stop arrival/departure and
                 cut-off/availability rows, readiness rows
    part      -> stop; laden capacity detail
    customer  -> vessel with its default operator
    events    -> keyed change feed

Everything is lazy: the projections and filters below fold into the scans of
the jobs that use them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.sources.tables import TableSource, scan_alias

# Fixed values of the re-aiming.
SCHEDULE_STATES = {"A": "LongTerm", "N": "Coastal", "R": "Actual"}   # l_returnflag
# l_returnflag and the last bit of l_linenumber
CARGO_NATURES = {"A0": "DG", "A1": "CFS", "N0": "RF", "N1": "Default", "R0": "GC", "R1": "VGM"}
NATURE_KEY_SQL = "(l_returnflag || CAST(l_linenumber % 2 AS VARCHAR))"
# arrival/departure column -> (aggregate, days added) of l_shipdate
ARR_DEP_COLUMNS = {
    "BERTH_ARRIVAL_IODT": ("min", 0), "BERTH_DEPARTURE_IODT": ("max", 0), "BERTH_ARRIVAL_LOC": ("min", 1),
    "BERTH_DEPARTURE_LOC": ("max", 1), "PILOT_ARRIVAL_IODT": ("min", 2), "PILOT_DEPARTURE_IODT": ("max", 2),
    "PILOT_ARRIVAL_LOC": ("min", 3), "PILOT_DEPARTURE_LOC": ("max", 3), "PORT_ARRIVAL_IODT": ("min", 4),
    "PORT_ARRIVAL_LOC": ("min", 5), "PORT_WAITING": ("max", 6),
}
DATE_TYPES = {"F": "Cutoff", "O": "Availability"}                       # l_linestatus


def manifest_info(t: TableSource) -> DataFrame:
    return scan_alias(t("orders"), {
        "mfest_info_id": "o_orderkey",
        "owner_ref_num": "o_custkey",
        "submit_type": "o_orderpriority",
        "is_deleted": F.when(F.col("o_orderstatus") == "P", 1).otherwise(0),
        "update_iodt": "o_orderdate",
    })


def manifest_ready(t: TableSource) -> DataFrame:
    return scan_alias(t("lineitem"), {
        "mfest_info_id": "l_orderkey",
        "readiness_state": "l_returnflag",
        "readiness_type": "l_linestatus",
        "rec_upd_dt": "l_shipdate",
    })


def line_id() -> Column:
    """A unique id for a lineitem row (keys plus the price in cents: the
    four keys alone repeat)."""
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                       F.round(F.col("l_extendedprice") * 100).cast("bigint"))


def voyage_stop_assn(t: TableSource) -> DataFrame:
    """SRC3 spine: one row per lineitem (voyage = order, stop = part)."""
    return scan_alias(t("lineitem"), {
        "VOY_STOP_ASSN_ID": line_id(),
        "VOY_CDE": "l_orderkey",
        "STOP_ID": "l_partkey",
        "VOY_SEQ": "l_linenumber",
    })


def voyage(t: TableSource) -> DataFrame:
    return scan_alias(t("orders"), {
        "VOY_CDE": "o_orderkey",
        "SVC_CDE": "o_orderpriority",
        "VSL_CDE": "o_custkey",
        "VOY_STATUS": "o_orderstatus",
    })


def stop(t: TableSource) -> DataFrame:
    return scan_alias(t("part"), {
        "STOP_ID": "p_partkey",
        "STOP_PORT_ID": "p_brand",
        "STOP_FCIL_ID": "p_type",
        "ARR_VOY_CDE": "p_size",
        "DEP_VOY_CDE": F.col("p_size") + 1,
    })


def stop_arr_dep(t: TableSource) -> DataFrame:
    """Stop arrival/departure times: one row per (stop, schedule state)."""
    li = t("lineitem")
    return (li.groupBy(F.col("l_partkey").alias("STOP_ID"),
                       label("l_returnflag", SCHEDULE_STATES).alias("SCHEDULE_STATE"))
            .agg(*[(getattr(F, fn)("l_shipdate") + F.make_dt_interval(F.lit(days))).alias(c)
                   for c, (fn, days) in ARR_DEP_COLUMNS.items()]))


def stop_cut_ava(t: TableSource) -> DataFrame:
    """Stop cut-off/availability rows: one row per (stop, carrier, nature, type)."""
    li = t("lineitem")
    return (li.groupBy(F.col("l_partkey").alias("STOP_ID"), F.col("l_suppkey").alias("CARRIER_ID"),
                       label(_nature_key(), CARGO_NATURES).alias("CARGO_NATURE"),
                       label("l_linestatus", DATE_TYPES).alias("TYPE"))
            .agg(F.min("l_shipdate").alias("DATE_IODT"), F.max("l_shipdate").alias("DATE_LOC")))


def operator_assignments(t: TableSource) -> DataFrame:
    """Operator validity rows from orders: each order is one validity row of
    its customer (vessel), from the order date for ``o_totalprice / 1000``
    days.  'F' and 'O' orders are tier 1 (service = order priority), 'P'
    orders tier 2 (no service).  Priority '5-LOW' opens the start of a tier-2
    row, priority '4-NOT SPECIFIED' opens the end of any row.
    """
    o = t("orders")
    tier2 = F.col("o_orderstatus") == "P"
    days = F.floor(F.col("o_totalprice") / 1000).cast("int")
    return o.select(
        F.when(~tier2, F.col("o_orderpriority")).alias("SVC_LOOP_CODE"),
        F.col("o_custkey").alias("VSL_CODE"),
        F.concat(F.lit("OP-"), F.col("o_orderstatus"), F.lit("-"),
                 F.substring("o_orderpriority", 1, 1)).alias("OPERATOR"),
        F.when(tier2 & (F.col("o_orderpriority") == "5-LOW"), F.lit(None))
        .otherwise(F.col("o_orderdate")).alias("EFF_START_IODT"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None))
        .otherwise(F.col("o_orderdate") + F.make_dt_interval(days)).alias("EFF_END_IODT"))


def vessel(t: TableSource) -> DataFrame:
    return scan_alias(t("customer"), {"VSL_CDE": "c_custkey", "OPERATOR": "c_mktsegment"})


def proforma_stop_assn(t: TableSource) -> DataFrame:
    """SRC4 spine: one row per lineitem (proforma = order, stop = part)."""
    return scan_alias(t("lineitem"), {
        "PROFM_STOP_ASSN_ID": line_id(),
        "PROFM_STOP_ID": "l_partkey",
        "PROFM_SEQ": "l_linenumber",
        "PROFORMA_ID": "l_orderkey",
    })


def proforma_stop(t: TableSource) -> DataFrame:
    return scan_alias(t("part"), {
        "PROFM_STOP_ID": "p_partkey", "FACILITY_ID": "p_type", "PORT_ID": "p_brand",
        "PORT_OCCURRENCE": "p_size", "GMT": "p_retailprice",
    })


def proforma_cut_ava(t: TableSource) -> DataFrame:
    """Proforma stop cut-off/availability rows: one per lineitem, measures from the ship date."""
    return scan_alias(t("lineitem"), {
        "profm_stop_id": "l_partkey",
        "cargo_nature": label(_nature_key(), CARGO_NATURES),
        "type": label("l_linestatus", DATE_TYPES),
        "date_day_off": F.dayofmonth("l_shipdate"),
        "date_l_hr": F.month("l_shipdate"),
        "date_l_min": "l_linenumber",
        "date_l_dow": F.dayofweek("l_shipdate"),
    })


def proforma(t: TableSource) -> DataFrame:
    return scan_alias(t("orders"), {
        "PROFORMA_ID": "o_orderkey", "SVC_CDE": "o_orderpriority", "SVC_NME": "o_custkey",
        "SVC_TYPE": "o_orderstatus", "EFF_START_IODT": "o_orderdate",
    })


def _nature_key() -> Column:
    return F.concat("l_returnflag", (F.col("l_linenumber") % 2).cast("string"))


def label(col: str | Column, mapping: dict) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr


# Fixed values: (l_returnflag || l_linestatus) -> laden-capacity category;
# 'RO' is deliberately unlisted (ignored by the pivot).
LADEN_CATEGORIES = {"AF": "BOX_20_MIN", "AO": "BOX_20_MAX", "NF": "BOX_40_MIN",
                    "NO": "BOX_40_MAX", "RF": "BOX_45_MIN"}


def effective_voyage(t: TableSource) -> DataFrame:
    return scan_alias(t("orders"), {
        "EFF_VOY_ID": "o_orderkey", "CARRIER_CDE": "o_orderstatus", "SVC_CDE": "o_orderpriority",
        "VSL_CDE": "o_custkey", "EFF_VOY_NUM": "o_orderkey", "DIRECTION": "o_orderpriority"})


def default_capacity_assn(t: TableSource) -> DataFrame:
    return scan_alias(t("orders"), {"EFF_VOY_ID": "o_orderkey", "DEFAULT_VSL_CAP_ID": "o_custkey"})


def port_capacity_assn(t: TableSource) -> DataFrame:
    return scan_alias(t("lineitem"), {"EFF_VOY_ID": "l_orderkey", "PORT_ID": "l_partkey",
                                      "VSL_CAP_ID": "l_suppkey"})


def tradelane_capacity_assn(t: TableSource) -> DataFrame:
    return scan_alias(t("lineitem"), {"EFF_VOY_ID": "l_orderkey", "TRADELANE_CDE": "l_returnflag",
                                      "OWNERS_MERIT": "l_linenumber", "VSL_CAP_ID": "l_suppkey"})


def vessel_capacity(t: TableSource) -> DataFrame:
    return scan_alias(t("supplier"), {
        "VSL_CAP_ID": "s_suppkey", "CARRIER_CDE": F.substring("s_name", 1, 3),
        "SVC_CDE": "s_nationkey", "VSL_CDE": "s_name", "DIRECTION": F.substring("s_name", 10, 1),
        "LADEN_VOL_TEU": "s_acctbal"})


def laden_capacity(t: TableSource) -> DataFrame:
    return scan_alias(t("lineitem"), {
        "VSL_CAP_ID": "l_suppkey",
        "CAT_CDE": _label_expr(F.concat("l_returnflag", "l_linestatus"), LADEN_CATEGORIES),
        "QTY": "l_quantity"})


def _label_expr(expr: Column, mapping: dict) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(expr == k, v) if out is None else out.when(expr == k, v)
    return out.otherwise(expr)
