"""User-state mart (JOB1): manifest header ⋈ readiness rows, filtered, latest
readiness per owner reference.

    info  -- mfest_info_id, owner_ref_num, submit_type, is_deleted, update_iodt
    ready -- mfest_info_id, readiness_state, readiness_type, rec_upd_dt

Plan: both sides are filtered and pruned in their scans (the literal
predicates push down), joined on ``mfest_info_id`` (one shuffle per side, or a
broadcast of the filtered side when AQE measures it small), then reduced to
one row per owner by a partial+final aggregate — no global sort, no window
over every row.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.scalar import run_timestamp
from quayside.operators.filters import equals, not_deleted, not_suffix
from quayside.operators.latest import latest_per_key

# Fixed values of the mart's filters.
READINESS_TYPE = "User"
EXCLUDED_SUBMIT_SUFFIX = "IB"


def user_ready_input(info: DataFrame, ready: DataFrame, readiness_type: str = READINESS_TYPE,
                     excluded_suffix: str = EXCLUDED_SUBMIT_SUFFIX) -> DataFrame:
    """SRC5: inner join + F3/F4/F5 filters."""
    a = (info.where(not_suffix("submit_type", excluded_suffix) & not_deleted("is_deleted"))
         .select("mfest_info_id", "owner_ref_num", "update_iodt"))
    r = (ready.where(equals("readiness_type", readiness_type))
         .select("mfest_info_id", "readiness_state", "rec_upd_dt"))
    return a.join(r, "mfest_info_id", "inner")


def user_state_mart(info: DataFrame, ready: DataFrame, run_ts: _dt.datetime | None = None,
                    **filters) -> DataFrame:
    """Latest (update_iodt desc nulls last, mfest_info_id desc) readiness row per
    owner_ref_num, plus the audit timestamp ``rec_cre_ts``.

    Further tie-breaks (rec_upd_dt, readiness_state, descending) make the
    chosen values deterministic when one header has several readiness rows.

    Since a header's update time and id are the same on all its readiness
    rows, the winning readiness row of each header can be picked *before*
    the join: a partial aggregate keyed on ``mfest_info_id`` -- the join key,
    so it adds no exchange -- that collapses a header with millions of
    readiness rows map-side and makes the join 1:1.
    """
    readiness_type = filters.get("readiness_type", READINESS_TYPE)
    ready = latest_per_key(ready.where(equals("readiness_type", readiness_type)), ["mfest_info_id"],
                           order=["rec_upd_dt"], tiebreak=["readiness_state"],
                           values=["readiness_state", "rec_upd_dt"]
                           ).withColumn("readiness_type", F.lit(readiness_type))
    joined = user_ready_input(info, ready, **filters)
    latest = latest_per_key(
        joined, ["owner_ref_num"],
        order=["update_iodt"],
        tiebreak=["mfest_info_id", "rec_upd_dt", "readiness_state"],
        values=["mfest_info_id", "readiness_state", "rec_upd_dt"])
    return (latest.withColumnRenamed("readiness_state", "readiness_state_distinct")
            .withColumn("rec_cre_ts", run_timestamp(run_ts)))
