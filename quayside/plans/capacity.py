"""Vessel-capacity enrichment (JOB5: L6-L11, A5, P1, X3).

    effective voyage (L6) -> default capacity id (L7)
    -> per-port capacity assignment (L8, 1:N)  -- or per trade lane (L9, 1:N)
    -> vessel capacity header (L10) -> laden capacity detail pivot (L11)

The reference has these lookups but never chains them.  Port and trade-lane
assignments are both 1:N on the effective voyage; chaining the two would emit
every (port, trade lane) pair of a voyage, so they are two separate
enrichments (``by="port"`` or ``by="tradelane"``), each a plain fan-out.
The capacity header repeats the voyage's carrier/service/vessel/direction
columns; they are kept under a ``CAP_`` prefix instead of colliding.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.operators.lookup import lookup_join, merged_lookup
from quayside.operators.reshape import fixed_pivot

# Laden-capacity categories and their output column names.
CAPACITY_CATEGORIES = {
    "BOX_20_MIN": "MIN_20FT", "BOX_20_MAX": "MAX_20FT", "BOX_40_MIN": "MIN_40FT",
    "BOX_40_MAX": "MAX_40FT", "BOX_45_MIN": "MIN_45FT", "BOX_45_MAX": "MAX_45FT",
    "BOX_20RF_MAX": "MAX_20RF", "BOX_40RF_MAX": "MAX_40RF", "REEFER_PLUGS": "RF_PLUGS",
}
HEADER_COLLISIONS = ["CARRIER_CDE", "SVC_CDE", "VSL_CDE", "DIR"]


def capacity_detail(laden: DataFrame, categories: Mapping[str, str] = CAPACITY_CATEGORIES) -> DataFrame:
    """``groupBy(VSL_CAP_ID).pivot(CAT_CDE, fixed list).sum(QTY)`` + renames."""
    return fixed_pivot(laden, ["VSL_CAP_ID"], "CAT_CDE", categories, "QTY", "sum")


def capacity_mart(eff_voyage: DataFrame, default_assn: DataFrame, assn: DataFrame,
                  capacity: DataFrame, laden: DataFrame, *, by: str = "port",
                  categories: Mapping[str, str] = CAPACITY_CATEGORIES) -> DataFrame:
    """One row per (effective voyage, port | trade lane, capacity id).

    eff_voyage   -- EFF_VOY_ID, CARRIER_CDE, SVC_CDE, VSL_CDE, EFF_VOY_NUM, DIRECTION
    default_assn -- EFF_VOY_ID, DEFAULT_VSL_CAP_ID
    assn         -- EFF_VOY_ID, PORT_ID | (TRADELANE_CDE, OWNERS_MERIT), VSL_CAP_ID
    capacity     -- VSL_CAP_ID, CARRIER_CDE, SVC_CDE, VSL_CDE, DIRECTION, measures...
    laden        -- VSL_CAP_ID, CAT_CDE, QTY
    """
    if by not in ("port", "tradelane"):
        raise ValueError(by)
    voy = eff_voyage.withColumn("DIR", F.substring("DIRECTION", 1, 1)).drop("DIRECTION")   # X3
    # header and details of a capacity id are one written lookup: one join of the voyages, whose hot or NULL ids Spark deals out
    cap = (capacity.withColumn("DIR", F.substring("DIRECTION", 1, 1)).drop("DIRECTION")
           .withColumnsRenamed({c: f"CAP_{c}" for c in HEADER_COLLISIONS}))
    cap = merged_lookup([cap, capacity_detail(laden, categories)], ["VSL_CAP_ID"], "capacity")
    return (voy
            .transform(lambda d: lookup_join(d, default_assn, ["EFF_VOY_ID"]))     # L7
            .transform(lambda d: lookup_join(d, assn, ["EFF_VOY_ID"]))             # L8 / L9
            .transform(lambda d: lookup_join(d, cap, ["VSL_CAP_ID"])))             # L10, L11
