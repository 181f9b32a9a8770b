"""Lookup-join enrichment.

A *lookup* is a projection of a reference table whose columns already carry
the names the enriched row should get (see ``sources.scan_alias``).  The
enrichment is an equi-join on named keys: left outer by default (a row with
no match keeps NULLs), never null-safe (a NULL key matches nothing).

Scale notes
-----------
* Only the key columns plus the requested output columns of the lookup are
  selected before the join, so the scan reads just those columns.
* Joins use column-name lists (``USING``), so consecutive lookups on the same
  key reuse the left side's hash partitioning: a chain of N lookups on
  ``STOP_ID`` shuffles the spine once, not N times.
* A lookup that is an aggregate (a pivot, say) is written first
  (``aggregated_lookup``): Spark splits a hot key's side of a join only where
  both sides are plain exchanges, and an aggregate above the exchange is none.
  Rows with a NULL key, which match nothing, are dealt out by their other
  columns instead of meeting in one task.
* No broadcast is forced by default.  AQE converts a join to a broadcast join
  once the measured shuffle output of the lookup is under
  ``spark.sql.adaptive.autoBroadcastJoinThreshold``: a size check made on real
  data, not a guess.  ``broadcast=True`` is for lookups whose size is bounded
  by construction (enumerations, code lists).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quayside.session import staged


#: Join key that deals out rows whose real key is NULL (0 on every row of a lookup).
SPREAD = "__spread"


def lookup_join(df: DataFrame, lookup: DataFrame, keys: Iterable[str] | None = None, *,
                key_map: Mapping[str, str] | None = None, cols: Iterable[str] | None = None,
                how: str = "left", broadcast: bool = False) -> DataFrame:
    """Enrich ``df`` with ``lookup``.

    keys     -- join keys, named the same on both sides (default key set).
    key_map  -- overrides ``keys``: ``{df_column: lookup_column}``; single or
                composite.  The lookup column is renamed to the df name.
    cols     -- subset of lookup columns to bring (default: all non-key).
    how      -- join type; ``left`` unless the caller wants an inner join.

    Of an ``aggregated_lookup`` the rows with a NULL key go around the hot
    task: its ``SPREAD`` column is one more join key, which they get from a
    hash of the whole row.
    """
    if key_map is None:
        if keys is None:
            raise ValueError("lookup_join needs keys or key_map")
        key_map = {k: k for k in keys}
    key_map = dict(key_map)
    # column names are compared as Spark and the metastore do: without case
    own = {c.lower(): c for c in df.columns}
    key_map = {own.get(k.lower(), k): v for k, v in key_map.items()}
    joined, lookup_keys = {k.lower() for k in key_map}, {v.lower() for v in key_map.values()}
    spread = SPREAD in lookup.columns
    if cols is None:
        cols = [c for c in lookup.columns if c.lower() not in lookup_keys]
    cols = [c for c in cols if c.lower() not in joined and c != SPREAD]
    clash = [c for c in cols if c.lower() in own]
    if clash:
        raise ValueError(f"lookup columns already on the input: {clash}")
    right = lookup.select(*[F.col(src).alias(dst) for dst, src in key_map.items()], *[F.col(c) for c in cols],
                          *([SPREAD] if spread else []))
    if broadcast:
        right = F.broadcast(right)
    if not spread:
        return df.join(right, on=list(key_map), how=how)
    if SPREAD in df.columns:                                       # of ``spread_over``: joins on these keys share one move
        return df.join(right, on=[*key_map, SPREAD], how=how)
    return spread_over(df, list(key_map)).join(right, on=[*key_map, SPREAD], how=how).drop(SPREAD)


def spread_over(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with the column ``SPREAD`` for joins on ``keys``.  Several joins of
    aggregated lookups on the same keys move ``df`` once if it has the column."""
    some_null = reduce(or_, [F.col(k).isNull() for k in keys])
    whole = [c for c, t in df.dtypes if "map<" not in t]           # a map has no hash
    return df.withColumn(SPREAD, F.when(some_null, F.xxhash64(*whole)).otherwise(F.lit(0).cast("long")))


def aggregated_lookup(lookup: DataFrame, name: str = "lookup") -> DataFrame:
    """A lookup that was aggregated (or joined from others), written once, so
    that the join with it has plain exchanges on both sides."""
    return staged(lookup.withColumn(SPREAD, F.lit(0).cast("long")), name)


def merged_lookup(lookups: Sequence[DataFrame], keys: Sequence[str], name: str = "lookup") -> DataFrame:
    """Several lookups on the same keys as one (full outer joins, written
    once): the rows and columns that joining them one after another gives,
    for one join of the enriched table instead of several.  NULL keys match
    nothing and are left out."""
    known = [lk.where(reduce(and_, [F.col(k).isNotNull() for k in keys])) for lk in lookups]
    return aggregated_lookup(reduce(lambda a, b: a.join(b, list(keys), "full_outer"), known), name)


def prefixed(df: DataFrame, prefix: str, columns: Mapping[str, str] | Sequence[str],
             keep: Sequence[str] = ()) -> DataFrame:
    """Select ``keep`` unchanged plus ``columns`` renamed to ``{prefix}_{name}``.

    ``columns`` maps output suffix -> source column, or lists source columns
    whose own names are the suffixes.
    """
    items = columns.items() if isinstance(columns, Mapping) else [(c, c) for c in columns]
    return df.select(*[F.col(k) for k in keep],
                     *[F.col(src).alias(f"{prefix}_{suffix}") for suffix, src in items])


def filtered_lookup(table: DataFrame, condition: Column, prefix: str,
                    columns: Mapping[str, str] | Sequence[str], keep: Sequence[str]) -> DataFrame:
    """F1 / F2: ``WHERE condition`` (enum literals) + prefixed projection.

    The literal filter is pushed into the scan; the projection is pruned to
    ``keep`` (keys, passthrough ids) plus the renamed measures.
    """
    return prefixed(table.where(condition), prefix, columns, keep)


def with_state_lookups(df: DataFrame, table: DataFrame, keys: Sequence[str], state_col: str,
                       states: Mapping[str, str], columns: Mapping[str, str] | Sequence[str],
                       how: str = "left", strategy: str = "chain") -> DataFrame:
    """One filtered, prefixed lookup per state value (F1 × L3).

    ``states`` maps state value -> column prefix, e.g.
    ``{"LongTerm": "LGMT", "Coastal": "CSTL", "Actual": "ACTL"}``.

    ``chain``: one join per state; duplicate (key, state) rows multiply rows
    exactly as chained lookup joins do (S10).  ``pivot``: the table is
    aggregated to one row per key, joined once, and only keys with several
    rows for a state are joined as in ``chain`` (``pivot_join``): the same
    rows as ``chain`` for every input, duplicates included.
    """
    items = columns.items() if isinstance(columns, Mapping) else [(c, c) for c in columns]
    if strategy == "chain":
        out = df
        for value, prefix in states.items():
            lk = filtered_lookup(table, F.col(state_col) == F.lit(value), prefix, columns, keys)
            out = lookup_join(out, lk, keys, how=how)
        return out
    if strategy != "pivot":
        raise ValueError(strategy)
    held = {f"__{prefix}": (F.col(state_col) == F.lit(value),
                            F.struct(*[F.col(src).alias(f"{prefix}_{suffix}") for suffix, src in items]))
            for value, prefix in states.items()}
    return pivot_join(df, table, keys, keys, held, how=how)


def pivot_join(df: DataFrame, table: DataFrame, group: Sequence[str], keys: Sequence[str],
               held: Mapping[str, tuple[Column, Column]], anchor: str | None = None, how: str = "left") -> DataFrame:
    """``df`` with the fields of ``table``'s rows (structs) that meet each condition.

    ``held`` maps a working name to (condition, row).  The table becomes one
    row per ``group`` (``keys`` and what else tells its rows apart), with the
    row of each condition that one row meets and a mark where several do; this
    is written once, and the write says which conditions have marks.  The
    written rows are joined on ``keys``; a NULL key matches nothing and isn't
    grouped.  Only if there are marks, the table is read again for the rows of
    the marked groups, which are joined one by one (a join whose hot side Spark
    can split; no aggregate holds more than one row).  ``anchor``: groups
    without a row for it are left out.
    """
    known = table.where(reduce(and_, [F.col(k).isNotNull() for k in keys]))
    n = {h: F.count(F.when(cond, 1)) for h, (cond, _) in held.items()}
    wide = known.groupBy(*group).agg(*[F.when(n[h] == 1, F.first(F.when(cond, row), ignorenulls=True)).alias(h)
                                       for h, (cond, row) in held.items()],
                                     *[(n[h] > 1).alias(f"__several{i}") for i, h in enumerate(held)],
                                     *([n[anchor].alias("__anchor")] if anchor else []))
    if anchor:
        wide = wide.where(F.col("__anchor") > 0).drop("__anchor")
    marks = {h: f"__several{i}" for i, h in enumerate(held)}
    seen = Observation()
    wide = aggregated_lookup(wide.observe(seen, *[F.max(m).alias(m) for m in marks.values()]), "lookup_pivot")
    found = seen.get
    out = lookup_join(df, wide.drop(*marks.values()), keys, how=how)
    if any(found.values()):
        out = _join_several(out, known, wide, group, keys, {h: held[h] for h in held if found[marks[h]]}, marks)
    if how == "inner":
        out = out.where(reduce(and_, [F.col(h).isNotNull() for h in held]))
    return out.select(*[c for c in out.columns if c not in held], *[F.col(f"{h}.*") for h in held])


def _join_several(out: DataFrame, known: DataFrame, wide: DataFrame, group: Sequence[str], keys: Sequence[str],
                  held: Mapping[str, tuple[Column, Column]], marks: Mapping[str, str]) -> DataFrame:
    """``pivot_join`` where several rows of a group meet a condition."""
    places = range(len(group))
    g, k = [f"__g{i}" for i in places], [f"__k{i}" for i in places]
    which = (wide.where(reduce(or_, [F.col(marks[h]) for h in held]))
             .select(*[F.col(c).alias(a) for c, a in zip(group, k)], *[marks[h] for h in held]))
    rows = known.where(reduce(or_, [cond for cond, _ in held.values()])).select(
        *[F.col(c).alias(a) for c, a in zip(group, g)], *[F.when(cond, row).alias(h) for h, (cond, row) in held.items()])
    rows = rows.join(which, reduce(and_, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(g, k)])).drop(*k)
    rows = staged(rows, "lookup_several")                   # the one further read of the table
    for h in held:
        more = rows.where(F.col(h).isNotNull() & F.col(marks[h])).select(*g, F.col(h).alias("__more"))
        on = [F.col(c) == F.col(a) if c in keys else F.col(c).eqNullSafe(F.col(a)) for c, a in zip(group, g)]
        out = (out.join(more, reduce(and_, on), "left").withColumn(h, F.coalesce(F.col(h), F.col("__more")))
               .drop("__more", *g))
    return out
