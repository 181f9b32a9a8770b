"""Actual-schedule mart (JOB2, C3) and its carrier cut-off block.

    spine (SRC3)  -> stop (L2) -> call sequences of arrival and departure
    -> voyage (L1) -> its call sequence (W1-W3)
    -> arrival/departure per schedule state, prefixed (L3 x 3, F1)
    -> precedence coalesce Actual > Coastal > LongTerm (X1)
    -> carrier cut-off / availability columns (L5 x 11)
    -> operator resolution (JOB3), its operators found on narrow rows first
    -> audit timestamp

Carrier block strategies
------------------------
``chain``  -- the reference shape: one filtered, prefixed lookup per
              (nature, type) combination; duplicate rows multiply (S10).
              Eleven scans of the cut-off table.  All but the first are joined
              to the first one's rows, which gives the same as joining them to
              the wide rows.
``pivot``  -- default: one conditional aggregate of the cut-off table per
              (stop, carrier) and one join.  Equal to ``chain`` when the table
              is unique on (stop, carrier, nature, type); the same aggregate
              counts rows per combination and the job fails (``raise_error``,
              evaluated on the executors, no extra pass) if that contract is
              broken, instead of silently collapsing rows.

Anchors (S2): ``dg_cutoff`` -- carriers enter only through the first
combination, keyed on the stop alone (reference behaviour); ``all_carriers``
-- every carrier with any row for the stop (the distinct spine, L4).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.scalar import run_timestamp
from quayside.operators.effective import resolve_operator_by_stop
from quayside.operators.lookup import (SPREAD, filtered_lookup, lookup_join, pivot_join,
                                       spread_over, with_state_lookups)
from quayside.operators.reshape import coalesce_precedence
from quayside.operators.sequence import with_sequences
from quayside.session import staged

# Schedule states and their column prefixes, in precedence
# order for the LTT_* coalesce (first wins).
STATE_PREFIX = {"Actual": "ACTL", "Coastal": "CSTL", "LongTerm": "LGMT"}
# arrival/departure output suffix -> source column.
ARR_DEP_FIELDS = {
    "BERTH_ARR_IODT": "BERTH_ARRIVAL_IODT", "BERTH_DEP_IODT": "BERTH_DEPARTURE_IODT",
    "BERTH_ARR_LOC": "BERTH_ARRIVAL_LOC", "BERTH_DEP_LOC": "BERTH_DEPARTURE_LOC",
    "PILOT_ARR_IODT": "PILOT_ARRIVAL_IODT", "PILOT_DEP_IODT": "PILOT_DEPARTURE_IODT",
    "PILOT_ARR_LOC": "PILOT_ARRIVAL_LOC", "PILOT_DEP_LOC": "PILOT_DEPARTURE_LOC",
    "PORT_ARR_IODT": "PORT_ARRIVAL_IODT", "PORT_ARR_LOC": "PORT_ARRIVAL_LOC",
    "PORT_WAITING": "PORT_WAITING",
}
# Fields coalesced into LTT_* (the eight berth / pilot times).
LTT_FIELDS = ["BERTH_ARR_IODT", "BERTH_DEP_IODT", "BERTH_ARR_LOC", "BERTH_DEP_LOC",
              "PILOT_ARR_IODT", "PILOT_DEP_IODT", "PILOT_ARR_LOC", "PILOT_DEP_LOC"]
# Cargo natures and date types with their column prefixes.
NATURE_PREFIX = {"DG": "DG", "CFS": "CFS", "RF": "RF", "Default": "DEFAULT", "GC": "GC", "VGM": "VGM"}
TYPE_PREFIX = {"Cutoff": "CUT", "Availability": "AVA"}
# The eleven (nature, type) lookups of the mart, anchor first, and their fields.
CUT_AVA_COMBOS = [
    ("DG", "Cutoff"), ("CFS", "Cutoff"), ("RF", "Cutoff"), ("Default", "Cutoff"),
    ("GC", "Cutoff"), ("VGM", "Cutoff"), ("DG", "Availability"), ("CFS", "Availability"),
    ("RF", "Availability"), ("Default", "Availability"), ("GC", "Availability"),
]
CUT_AVA_FIELDS = {"IODT": "DATE_IODT", "LOC": "DATE_LOC"}

# The call sequences: (groups, order).  The association's id comes last, so the order is total.
SEQUENCES = {
    "ARR_PORT_CALL_SEQ_FIX": (["ARR_VOY_CDE", "STOP_PORT_ID"], ["VOY_CDE", "VOY_SEQ", "STOP_ID", "VOY_STOP_ASSN_ID"]),
    "DEP_PORT_CALL_SEQ_FIX": (["DEP_VOY_CDE", "STOP_PORT_ID"], ["VOY_CDE", "VOY_SEQ", "STOP_ID", "VOY_STOP_ASSN_ID"]),
    "PORT_CALL_SEQ": (["VOY_CDE", "STOP_PORT_ID"], ["VOY_SEQ", "STOP_ID", "VOY_STOP_ASSN_ID"]),
}


def combo_prefix(nature: str, dtype: str, prefixes=(NATURE_PREFIX, TYPE_PREFIX)) -> str:
    return f"{prefixes[0].get(nature, nature)}_{prefixes[1].get(dtype, dtype)}"


def _combo_cond(nature: str, dtype: str):
    return (F.col("CARGO_NATURE") == F.lit(nature)) & (F.col("TYPE") == F.lit(dtype))


def with_cut_ava(df: DataFrame, cut_ava: DataFrame, combos: Sequence[tuple[str, str]] = CUT_AVA_COMBOS,
                 anchor: str = "dg_cutoff", strategy: str = "pivot",
                 fields: Mapping[str, str] = CUT_AVA_FIELDS, stop: str = "STOP_ID",
                 carrier: str = "CARRIER_ID", prefixes=(NATURE_PREFIX, TYPE_PREFIX)) -> DataFrame:
    """Attach CARRIER_ID and ``{NATURE}_{TYPE}_{field}`` columns to ``df``."""
    if anchor not in ("dg_cutoff", "all_carriers"):
        raise ValueError(anchor)
    names = {c: combo_prefix(*c, prefixes=prefixes) for c in combos}
    if strategy == "chain":
        # the later lookups are joined to the first one's narrow rows, so the wide rows are moved by the stop alone
        if anchor == "dg_cutoff":
            own, rest = filtered_lookup(cut_ava, _combo_cond(*combos[0]), names[combos[0]], fields, [stop, carrier]), combos[1:]
        else:
            own, rest = cut_ava.select(stop, carrier).distinct(), combos
        for combo in rest:
            own = lookup_join(own, filtered_lookup(cut_ava, _combo_cond(*combo), names[combo], fields, [stop, carrier]), [stop, carrier])
        return lookup_join(df, own, [stop])
    if strategy != "pivot":
        raise ValueError(strategy)
    has_carrier = F.col(carrier).isNotNull()
    held = {}
    for i, combo in enumerate(combos):
        cond = _combo_cond(*combo)
        if not (anchor == "dg_cutoff" and i == 0):
            cond = cond & has_carrier           # keyed on (stop, carrier): NULL never matches
        row = F.struct(*[F.col(src).alias(f"{names[combo]}_{suffix}") for suffix, src in fields.items()])
        held[f"__{names[combo]}"] = (cond, row)
    return pivot_join(df, cut_ava, [stop, carrier], [stop], held,
                      anchor=next(iter(held)) if anchor == "dg_cutoff" else None)


def schedule_mart(spine: DataFrame, voyage: DataFrame, stop: DataFrame, arr_dep: DataFrame,
                  cut_ava: DataFrame, assignments: DataFrame, vessels: DataFrame, *,
                  arr_dep_fields: Mapping[str, str] = ARR_DEP_FIELDS,
                  ltt_fields: Sequence[str] = LTT_FIELDS,
                  combos: Sequence[tuple[str, str]] = CUT_AVA_COMBOS,
                  cut_ava_fields: Mapping[str, str] = CUT_AVA_FIELDS,
                  sequences=SEQUENCES, anchor: str = "dg_cutoff", strategy: str = "pivot",
                  sequence_strategy: str = "range", run_ts: _dt.datetime | None = None,
                  stage: bool = True) -> DataFrame:
    """JOB2.  ``stage`` writes the spine with its stops once to the shared folder,
    so its tables are read once.  The sequences are numbered before any lookup
    fans out (S3), each with the columns that it needs and those found before: the
    voyage's sequence shares the move of the voyage join, and so do the operators,
    which are found on one narrow row a voyage.  ``chain`` joins one lookup after
    another, ``pivot`` an aggregate of each table."""
    states = {s: STATE_PREFIX[s] for s in reversed(STATE_PREFIX)}   # LongTerm, Coastal, Actual
    ltt = [f for f in ltt_fields if f in arr_dep_fields]

    def states_join(d):
        return with_state_lookups(d, arr_dep, ["STOP_ID"], "SCHEDULE_STATE", states,
                                  arr_dep_fields, strategy=strategy)

    stops = lookup_join(spine, stop, ["STOP_ID"])
    stops = staged(stops, "schedule_spine") if stage else stops      # counts, samples and the operators read this copy
    # sequences of voyages come behind the voyage join, whose move they share, the others before rows get its columns
    by_voyage = {k: v for k, v in sequences.items() if "VOY_CDE" in v[0] or not {*v[0], *v[1]} <= {*stops.columns}}
    if not any("VOY_CDE" in part for part, _ in by_voyage.values()):
        by_voyage = dict(sequences)                                  # a voyage that comes twice fails in its sequence
    others = {k: v for k, v in sequences.items() if k not in by_voyage}
    df = with_sequences(stops, others, sequence_strategy) if others else stops
    df = lookup_join(df, voyage, ["VOY_CDE"])
    joined = [x for x in df.columns if x not in others]
    df = with_sequences(df, by_voyage, sequence_strategy, dealt_by=["VOY_CDE"], **({"basis": stops} if {*[y for p, o in by_voyage.values() for y in [*p, *o]]} <= {*stops.columns} else {}))
    if strategy == "pivot":
        df = df.select(*joined, *sorted(sequences, key=lambda k: "VOY_CDE" not in sequences[k][0]))
    else:
        attributes = [x for x in joined if x not in stops.columns]
        df = df.select(*spine.columns, *attributes, *[x for x in stops.columns if x not in spine.columns], *sequences)
    narrow = lookup_join(stops.select("VOY_CDE", "STOP_ID"), voyage.select("VOY_CDE", "SVC_CDE", "VSL_CDE"), ["VOY_CDE"])

    def widen(d):
        return ((spread_over(d, ["STOP_ID"]) if strategy == "pivot" else d)          # one move for both pivots
                .transform(states_join)
                .transform(lambda d: coalesce_precedence(d, list(STATE_PREFIX.values()), ltt, "LTT"))
                .transform(lambda d: with_cut_ava(d, cut_ava, combos, anchor, strategy, cut_ava_fields)).drop(SPREAD))

    carriers = cut_ava.where(_combo_cond(*combos[0])) if anchor == "dg_cutoff" else cut_ava
    departures = filtered_lookup(arr_dep, F.col("SCHEDULE_STATE") == F.lit("Coastal"), STATE_PREFIX["Coastal"],
                                 {"BERTH_DEP_IODT": arr_dep_fields["BERTH_DEP_IODT"]}, ["STOP_ID"])
    df = resolve_operator_by_stop(df, carriers, departures, assignments, vessels, widen, narrow=narrow)
    return df.withColumn("REC_CRE_TS", run_timestamp(run_ts))
