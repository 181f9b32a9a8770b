"""Latest record per key.

The reference sorts the whole input by update time and takes ``first`` per
key, which Spark does not guarantee (the merge order of partial ``first``
results is unspecified) and which costs a global range sort plus a hash
exchange.  Here the rule is explicit: newest ordering value first, NULLs
last, then the tie-break columns descending.

Default strategy: ``max_by(struct(payload...), struct(order..., tiebreak...))``
per key, so the payload may hold columns without an order (maps).
It is an aggregate with a map-side partial step, so each task ships at most
one row per key to the shuffle: a key holding a third of all rows is
collapsed before the exchange instead of landing whole in one task.  (A
struct buffer with string fields makes Spark pick its sort-based aggregate;
the sort is task-local and spills, and the shuffle still carries one row per
key per task.)  Struct ordering compares fields left to right with NULL
lowest, which is exactly "desc, nulls last".

``strategy="window"`` keeps a ``row_number`` formulation for orderings a
struct max cannot express (ascending strings); it shuffles every row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_PICK = "__latest"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   values: Sequence[str], tiebreak: Sequence[str] = (),
                   strategy: str = "aggregate") -> DataFrame:
    """One row per ``keys``: the row with the greatest (order..., tiebreak...).

    Returns ``keys + values`` (values may repeat order/tiebreak columns).
    """
    keys, order, tiebreak, values = list(keys), list(order), list(tiebreak), list(values)
    if strategy == "window":
        w = Window.partitionBy(*keys).orderBy(
            *[F.col(c).desc_nulls_last() for c in order + tiebreak])
        return (df.withColumn("__rn", F.row_number().over(w))
                .where(F.col("__rn") == 1).select(*keys, *values))
    if strategy != "aggregate":
        raise ValueError(strategy)
    rank = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order + tiebreak)])
    payload = F.struct(*[F.col(c).alias(f"_v{i}") for i, c in enumerate(values)])
    picked = df.groupBy(*keys).agg(F.max_by(payload, rank).alias(_PICK))
    return picked.select(*keys, *[F.col(f"{_PICK}._v{i}").alias(c) for i, c in enumerate(values)])

