"""Reshaping: fixed-list pivot (A5), conditional pivots (A6), precedence
coalesce (X1) and the one-pass state pivot that replaces repeated filtered
lookups of one table.

Every pivot here is a single hash aggregate over the input, with a map-side
partial aggregation: one scan, one shuffle of at most one row per key per
task, whatever the number of output columns.  The value lists are fixed in
code (as in the reference), so the output schema never depends on the data
and no distinct-values pass is run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_AGGS = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count, "first": F.first}


def fixed_pivot(df: DataFrame, keys: Sequence[str], pivot_col: str,
                values: Mapping[str, str] | Sequence[str], measure: str,
                agg: str = "sum") -> DataFrame:
    """A5: the result of ``groupBy(keys).pivot(pivot_col, values).agg(measure)``.

    ``values`` maps pivot value -> output column name (P1 renames folded in).
    Unlisted categories are ignored; a key with none of the listed values
    still yields a row of NULLs; duplicate categories are aggregated.

    Written as one conditional aggregate: ``DataFrame.pivot`` plans two
    aggregations (by key and pivot value, then a pivot-first by key), i.e. two
    shuffles, where ``agg(CASE WHEN pivot = v THEN measure END)`` needs one.
    """
    names = dict(values) if isinstance(values, Mapping) else {v: v for v in values}
    fn = _AGGS[agg]
    return df.groupBy(*keys).agg(*[fn(F.when(F.col(pivot_col) == F.lit(v), F.col(measure))).alias(n)
                                   for v, n in names.items()])


def conditional_agg(df: DataFrame, keys: Sequence[str],
                    outputs: Mapping[str, tuple[Column, str]], agg: str = "max") -> DataFrame:
    """A6 (rewrite): ``agg(CASE WHEN cond THEN measure END)`` per output.

    ``outputs`` maps output name -> (condition, measure column).  A NULL in
    a condition column simply never matches, so no row can raise.
    """
    fn = _AGGS[agg]
    return df.groupBy(*keys).agg(
        *[fn(F.when(cond, F.col(m))).alias(name) for name, (cond, m) in outputs.items()])


def nested_map_agg(df: DataFrame, keys: Sequence[str], outer_col: str, inner_col: str,
                   measures: Mapping[str, str], combos: Sequence[tuple[str, str, str]],
                   agg: str = "max") -> DataFrame:
    """A6 (literal): build ``map(outer, map(inner, measure))`` per row and take
    ``agg(m[outer_value][inner_value])`` per key.

    measures -- measure alias -> source column (one map per measure).
    combos   -- (outer value, inner value, output name template with
                ``{m}`` for the measure alias).
    Spark 4 runs with ANSI on, where a NULL map key raises; rows whose outer
    or inner value is NULL get a NULL map instead (they can never match a
    literal lookup key, so the result is unchanged).
    """
    fn = _AGGS[agg]
    ok = F.col(outer_col).isNotNull() & F.col(inner_col).isNotNull()
    maps = {m: F.when(ok, F.create_map(F.col(outer_col), F.create_map(F.col(inner_col), F.col(src))))
            for m, src in measures.items()}
    staged = df.select(*keys, *[v.alias(f"__kv_{m}") for m, v in maps.items()])
    aggs = []
    for m in measures:
        for outer, inner, template in combos:
            aggs.append(fn(F.col(f"__kv_{m}")[outer][inner]).alias(template.format(m=m)))
    return staged.groupBy(*keys).agg(*aggs)


def state_pivot(table: DataFrame, keys: Sequence[str], state_col: str,
                states: Mapping[str, str], columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One pass over ``table`` producing ``{prefix}_{name}`` per state.

    columns -- output suffix -> (aggregate, source column).  With ``max`` /
    ``min`` over a table that is unique on (keys, state) this equals the
    chain of filtered prefixed lookups (F1); with other aggregates it is the
    per-state aggregate itself.
    """
    outs = {}
    for value, prefix in states.items():
        cond = F.col(state_col) == F.lit(value)
        for suffix, (agg, src) in columns.items():
            outs[f"{prefix}_{suffix}"] = (agg, cond, src)
    return table.groupBy(*keys).agg(*[_cond(agg, cond, src).alias(name)
                                      for name, (agg, cond, src) in outs.items()])


def _cond(agg: str, cond: Column, src: str) -> Column:
    if agg == "count":
        return F.count(F.when(cond, F.lit(1)))
    return _AGGS[agg](F.when(cond, F.col(src)))


def coalesce_precedence(df: DataFrame, prefixes: Sequence[str], fields: Sequence[str],
                        out_prefix: str) -> DataFrame:
    """``{out}_{f} = coalesce({p1}_{f}, {p2}_{f}, ...)`` for each field,
    first prefix winning."""
    return df.withColumns({f"{out_prefix}_{f}": F.coalesce(*[F.col(f"{p}_{f}") for p in prefixes])
                           for f in fields})
