"""Call-sequence numbering.

``row_number`` over (group, order), computed before any fan-out join so a
stop keeps its sequence however many carriers join later (S3).  Order
columns must make the order total (callers add an id as the last
tie-break), otherwise the numbering is not deterministic between runs.

``range`` (the default, one path for every size) is a window per sequence, in
which no task holds more than a slice of a large group:

1. the rows are counted; only if there are more than ``SLICE_ROWS``, a bounded
   sample of the group and order columns tells which groups may have more rows
   than that, and cuts each of them (e.g. the NULL group of all stops without
   an arrival voyage) at quantiles of its order;
2. a row of such a group gets the number of cuts at or before it, its slice;
   the exact number of rows of each slice is one aggregate, and the rows of a
   group's earlier slices one running sum of it;
3. sequence = ``row_number`` within (group, slice) + rows of earlier slices.

The sample decides where groups are cut, never a number: every row is counted
and numbered.  Values of any type pass unchanged and NULL, NaN and equal keys
group as in the window.  Each sequence moves the rows once, and nothing else of
their size: no ids are sent, joined back or written.  The input is read for the
count, the sample and, if there are large groups, the slices' counts: give a
written one (``staged``) if it is costly, or the written table it comes from
(``basis``).  Rows that are dealt by some of a sequence's groups already
(``dealt_by``) are not moved for it.

``window``: the same without cuts, one task for each group; for inputs whose
groups are known to be small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.session import checkpointed

_CUTS, _SLICE, _CNT = "__seq_cuts", "__seq_slice", "__seq_cnt"
#: A group of more rows is cut into slices of about as many.
SLICE_ROWS = 500_000
#: Rows of the sample that finds large groups and their quantiles.
SAMPLE_ROWS = 200_000


def with_sequence(df: DataFrame, out_col: str, partition_by: Sequence[str],
                  order_by: Sequence[str], strategy: str = "range",
                  num_ranges: int | None = None, row_id: Sequence[str] | None = None) -> DataFrame:
    return with_sequences(df, {out_col: (partition_by, order_by)}, strategy, num_ranges, row_id)


def with_sequences(df: DataFrame, specs: Mapping[str, tuple[Sequence[str], Sequence[str]]],
                   strategy: str = "range", num_ranges: int | None = None, row_id: Sequence[str] | None = None,
                   basis: DataFrame | None = None, dealt_by: Sequence[str] = ()) -> DataFrame:
    """Apply several sequences: ``{out_col: (partition_by, order_by)}``.

    ``row_id`` names the columns that tell rows apart; by default the last
    order column of the sequences, which then is the same unique id in all of
    them.  Rows of a group that follow each other with one id fail the job
    (``range``).  ``num_ranges`` cuts groups of more than that part of the rows.

    ``basis``: a written table of the same rows with the sequences' columns, which
    is read for the count, the sample and the slices' counts instead of ``df``.
    ``dealt_by``: columns that ``df`` is dealt by already.  A sequence that groups
    by them needs no move of its own; it gets one only if the sample shows that
    one value of them has more rows than a slice."""
    specs = {k: (list(p), list(o)) for k, (p, o) in specs.items()}
    if strategy == "window":
        for out_col, (part, order) in specs.items():
            df = df.withColumn(out_col, F.row_number().over(Window.partitionBy(*part).orderBy(*_ascending(order))))
        return df
    if strategy != "range":
        raise ValueError(strategy)
    if row_id is None:
        row_id = list(dict.fromkeys(order[-1] for _, order in specs.values()))
        if len(row_id) != 1:
            raise ValueError(f"the sequences end in different ids {row_id}: name the row_id")
    basis = df if basis is None else basis
    n = basis.count()
    most = max(1, n // num_ranges) if num_ranges else SLICE_ROWS
    sample, part_read = None, min(1.0, SAMPLE_ROWS / max(n, 1))
    if n > most:
        used = list(dict.fromkeys(c for part, order in specs.values() for c in [*part, *order]))
        sample = basis.select(*used)
        sample = checkpointed(sample.sample(part_read, seed=7) if part_read < 1 else sample)
    for out_col, (part, order) in specs.items():
        held = max(1, int(most * part_read))
        cuts = _cuts(sample, part, order, held) if sample is not None else None
        shares = bool(dealt_by) and set(dealt_by) <= set(part)
        apart = shares and sample is not None and not sample.groupBy(*dealt_by).count().where(F.col("count") > held).isEmpty()
        df = _numbered(df, out_col, part, order, list(row_id), cuts, basis, apart)
    return df


def _ascending(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns]


def _place(order: Sequence[str]) -> Column:
    """Structs compare as the order columns sort: field by field, NULL lowest."""
    return F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])


def _cuts(sample: DataFrame, group: list[str], order: list[str], most: int) -> DataFrame | None:
    """(group as __g0, ..., the places where it is cut) of each group that has
    more than ``most`` rows in the sample; None if there is none."""
    large = sample.groupBy(*group).agg(F.count("*").alias(_CNT)).where(F.col(_CNT) > most).drop(_CNT)
    names = [f"__g{i}" for i in range(len(group))]
    large = large.select(*[F.col(g).alias(a) for g, a in zip(group, names)])
    rows = sample.join(F.broadcast(large), _same(group, names)).select(*names, _place(order).alias("__at"))
    at = F.row_number().over(Window.partitionBy(*names).orderBy("__at"))
    cuts = checkpointed(rows.withColumn(_CNT, at).where((F.col(_CNT) > most) & (F.col(_CNT) % most == 1 % most))
                        .groupBy(*names).agg(F.array_sort(F.collect_set("__at")).alias(_CUTS)))
    return None if cuts.isEmpty() else cuts


def _same(columns: Sequence[str], others: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(o)) for c, o in zip(columns, others)])


def _numbered(df: DataFrame, out_col: str, group: list[str], order: list[str], row_id: list[str], cuts: DataFrame | None,
              basis: DataFrame, apart: bool = False) -> DataFrame:
    """``df`` with one sequence; ``apart``: its groups are dealt out anew."""
    columns, earlier = df.columns, F.lit(0)
    if cuts is not None:
        names = [f"__g{i}" for i in range(len(group))]

        def sliced(d: DataFrame) -> DataFrame:
            # there are at most as many cuts as slices of SLICE_ROWS rows in the input
            d = d.join(F.broadcast(cuts), _same(group, names), "left").drop(*names)
            return d.withColumn(_SLICE, F.size(F.filter(_CUTS, lambda c: c <= _place(order))))

        df = sliced(df)
        counts = sliced(basis).where(F.col(_CUTS).isNotNull()).groupBy(*group, _SLICE).agg(F.count("*").alias(_CNT))
        before = Window.partitionBy(*group).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
        counts = checkpointed(counts.select(*[F.col(g).alias(a) for g, a in zip(group, names)], F.col(_SLICE).alias("__s"),
                                            F.coalesce(F.sum(_CNT).over(before), F.lit(0)).alias("__before")))
        df = df.join(F.broadcast(counts), _same([*group, _SLICE], [*names, "__s"]), "left")
        group, earlier = [*group, _SLICE], F.coalesce(F.col("__before"), F.lit(0))
    df = df.repartition(*group) if apart else df
    window = Window.partitionBy(*group).orderBy(*_ascending(order))
    at, ident = F.row_number().over(window), F.struct(*row_id)
    repeated = F.raise_error(F.lit(f"rows with the same {row_id}: they don't tell rows apart")).cast("int")
    number = F.when((F.col("__at") > 1) & F.col("__last").eqNullSafe(ident), repeated).otherwise((F.col("__at") + earlier).cast("int"))
    return df.withColumns({"__at": at, "__last": F.lag(ident).over(window)}).select(*columns, number.alias(out_col))
