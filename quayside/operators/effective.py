"""Effective-dated operator resolution.

Given enriched schedule rows (voyage, service, vessel, carrier, departure),
find the operator of each (voyage, carrier):

1. first departure per (voyage, service, vessel, carrier)            (A2)
2. candidate operators from validity rows:                          (J3-J5)
   tier 1 -- rows for (service, vessel): start must be known, end may be
             open; tier 2 -- rows for the vessel with no service: either
             end may be open.  Bounds are inclusive.
   ``NVL(tier1, tier2)`` row-wise, then DISTINCT                   (X2, A4)
3. (voyage, carrier) groups with exactly one candidate mark their whole
   voyage as service-resolved; those voyages take the candidates, every
   other voyage takes the vessel's default operator.           (A3, F7-F9, U1)

The reference writes step 2 as one query with two LEFT JOINs of the
validity table onto the same row, which emits every (tier 1, tier 2) pair of
a vessel before DISTINCT.  That product is never built here.  For one row the
DISTINCT result is exactly

    { tier-1 operators that are valid }
  ∪ { tier-2 operators that are valid, if some tier-1 match is invalid or
      there is no tier-1 match }

(an invalid or missing tier-1 match yields NULL, and NVL then falls back to
the tier-2 value of every tier-2 match).  So the tiers are resolved
separately and unioned; the output and the S7 behaviour (an expired tier-1
row lets the tier-2 operator in too) are identical.

Nor is a departure joined with all validity rows of its vessel.  Keys with at
most ``MANY`` validity rows have them in one array, which a departure meets in
one join that adds no rows; only its valid operators become rows.  For the keys
with more, times are mapped to whole *bins* (days, or the leading digits of time text) without
changing their order.  A validity interval becomes the bins that it covers
whole, written with units of 1, ``BASE``, ``BASE``^2, ... bins so that long and
open intervals take few rows, and its two end bins with their bounds; equal
rows of one operator are one row after an aggregate, so overlapping and
repeated validity rows don't multiply.  A departure has one row for each unit;
the join is on (keys, unit, bin).  Every covering row met is a valid operator,
and only rows that begin or end in the departure's own bin are looked at in
vain.  A hot vessel's rows spread over the bins.  Whether some tier-1 match is
invalid needs no join with intervals: all are valid just when the departure
lies between the latest start and the earliest end of the (service, vessel).

The singleton voyage list is a semi join and its complement an anti join
(with SQL ``NOT IN`` NULL rules), so no list reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.operators.filters import in_keys, keys_with_count, not_in_keys
from quayside.operators.lookup import aggregated_lookup, lookup_join, merged_lookup
from quayside.session import staged


@dataclass(frozen=True)
class ScheduleCols:
    voyage: str = "VOY_CDE"
    service: str = "SVC_CDE"
    vessel: str = "VSL_CDE"
    carrier: str = "CARRIER_ID"
    departure: str = "CSTL_BERTH_DEP_IODT"
    first_dep: str = "F_BERTH_DEP_IODT"
    operator: str = "OPERATOR"


@dataclass(frozen=True)
class AssignmentCols:
    service: str = "SVC_LOOP_CODE"
    vessel: str = "VSL_CODE"
    operator: str = "OPERATOR"
    start: str = "EFF_START_IODT"
    end: str = "EFF_END_IODT"


def first_departure(df: DataFrame, c: ScheduleCols = ScheduleCols()) -> DataFrame:
    """A2: earliest departure per (voyage, service, vessel, carrier)."""
    return (df.groupBy(c.voyage, c.service, c.vessel, c.carrier)
            .agg(F.min(c.departure).alias(c.first_dep)))


def tier1_valid(start: Column, end: Column, t: Column) -> Column:
    """Tier 1: start required (NULL start never matches), end may be open."""
    return F.when(end.isNull(), start <= t).otherwise((start <= t) & (t <= end))


def tier2_valid(start: Column, end: Column, t: Column) -> Column:
    """Tier 2: both ends may be open; a fully open row matches even an
    unknown departure."""
    return (F.when(end.isNull() & start.isNull(), F.lit(True))
            .when(end.isNull(), start <= t)
            .when(start.isNull(), t <= end)
            .otherwise((start <= t) & (t <= end)))


#: Bins are written in units of powers of this; ``BASE ** UNITS`` bins hold every date of four-digit years.
BASE, UNITS = 16, 6
_LAST = BASE**UNITS


def time_bin(t: Column, dtype: str) -> Column:
    """A bin that never decreases with the time: days of a date or timestamp,
    the first six digits of text, the whole part of a number (0 to the last bin)."""
    if dtype == "string":
        digits = F.regexp_extract(t, "^([0-9]{0,6})", 1)
        # text that breaks off or goes on with a lower character sorts before all digits there, with a higher one behind them
        behind = F.substring(t, 7 - (6 - F.length(digits)), 1)
        return F.when(behind > "9", F.rpad(digits, 6, "9")).otherwise(F.rpad(digits, 6, "0")).cast("int")
    if dtype.startswith(("timestamp", "date")):
        whole = F.unix_date(t.cast("date")) + 719_528               # from the year 0
    else:
        whole = F.floor(t)
    return F.least(F.greatest(whole, F.lit(0)), F.lit(_LAST - 1)).cast("int")


def _covered(low: Column, high: Column) -> Column:
    """The bins from ``low`` to before ``high`` as few (unit, bin) structs: of
    each unit those that no larger unit inside the interval holds."""
    up = [F.floor((low + (BASE**k - 1)) / F.lit(float(BASE**k))).cast("int") for k in range(UNITS)]       # first whole one
    down = [F.floor(high / F.lit(float(BASE**k))).cast("int") for k in range(UNITS)]                      # behind the last

    def run(k: int, a: Column, b: Column) -> Column:
        found = F.transform(F.sequence(a, b - 1), lambda x: F.struct(F.lit(k).alias("unit"), x.alias("bin")))
        return F.when((up[k] < down[k]) & (a < b), found).otherwise(F.array().cast("array<struct<unit:int,bin:int>>"))

    parts = [run(UNITS - 1, up[-1], down[-1])]
    for k in range(UNITS - 1):
        larger = up[k + 1] < down[k + 1]
        parts.append(run(k, up[k], F.when(larger, up[k + 1] * BASE).otherwise(down[k])))
        parts.append(run(k, F.when(larger, down[k + 1] * BASE).otherwise(down[k]), down[k]))
    return F.concat(*parts)


def validity_bins(rows: DataFrame, keys: list[str], operator: str, start: str, end: str) -> DataFrame:
    """(keys, operator, unit, bin, from, to): where an operator is valid.  NULL
    ``from`` / ``to``: from the start / to the end of the bin.  ``start`` and
    ``end`` may be NULL (open); rows without an operator say nothing."""
    dtype = dict(rows.dtypes)[start]
    s, e = F.col(start), F.col(end)
    known = rows.where(F.col(operator).isNotNull() & (s.isNull() | e.isNull() | (s <= e)))
    known = known.withColumns({"__sb": time_bin(s, dtype), "__eb": time_bin(e, dtype)})
    low = F.when(s.isNull(), F.lit(0)).otherwise(F.col("__sb") + 1)
    high = F.when(e.isNull(), F.lit(_LAST)).otherwise(F.col("__eb"))
    own = [*keys, operator]
    whole = known.select(*own, F.explode(_covered(low, high)).alias("c")).select(
        *own, "c.unit", "c.bin", F.lit(None).cast(dtype).alias("__from"), F.lit(None).cast(dtype).alias("__to"), F.lit(False).alias("__in"))
    within = s.isNotNull() & e.isNotNull() & (F.col("__sb") == F.col("__eb"))
    ends = known.select(*own, F.explode(F.when(within, F.array(F.struct(F.col("__sb").alias("bin"), s.alias("f"), e.alias("t"), F.lit(True).alias("i"))))
                                        .otherwise(F.array(F.struct(F.col("__sb").alias("bin"), s.alias("f"), F.lit(None).cast(dtype).alias("t"), F.lit(False).alias("i")),
                                                           F.struct(F.col("__eb").alias("bin"), F.lit(None).cast(dtype).alias("f"), e.alias("t"), F.lit(False).alias("i"))))).alias("c"))
    ends = ends.where("c.bin IS NOT NULL").select(*own, F.lit(0).alias("unit"), "c.bin", F.col("c.f").alias("__from"), F.col("c.t").alias("__to"), F.col("c.i").alias("__in"))
    every = whole.unionByName(ends)
    # of rows of one kind in one bin the earliest start and the latest end say all; those that begin and end in it stay apart
    kind = [F.when(F.col("__in"), F.col(c)).alias(f"{c}_own") for c in ("__from", "__to")] + [F.col("__from").isNotNull().alias("__begins"), F.col("__to").isNotNull().alias("__ends")]
    return every.groupBy(*own, "unit", "bin", *kind).agg(F.min("__from").alias("__from"), F.max("__to").alias("__to")).select(*own, "unit", "bin", "__from", "__to")


#: A key's validity rows (or a stop's carriers, a vessel's operators) are held in one array up to this many of them, in bins (or row by row) beyond.
MANY = 64


def _gathered(rows: DataFrame, keys: list[str], operator: str, start: str, end: str) -> tuple[DataFrame, DataFrame | None]:
    """(keys, the validity rows of a key as ``__rows``) for keys with few rows,
    and the keys with many (None if there are none)."""
    known = rows.where(reduce(and_, [F.col(c).isNotNull() for c in [*keys, operator]]))
    many = staged(known.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > MANY).select(*keys), "validity_many")
    many = None if many.isEmpty() else many
    few = known.join(many, keys, "left_anti") if many is not None else known
    row = F.struct(F.col(operator).alias("op"), F.col(start).alias("s"), F.col(end).alias("e"))
    return few.groupBy(*keys).agg(F.collect_set(row).alias("__rows")), many


def _valid(gathered: Column, t: Column) -> Column:
    """The distinct operators of those rows that hold ``t``; a row that is open
    at both ends holds an unknown time, too."""
    holds = F.filter(gathered, lambda r: (r.s.isNull() | F.coalesce(r.s <= t, F.lit(False))) & (r.e.isNull() | F.coalesce(t <= r.e, F.lit(False))))
    return F.array_distinct(F.transform(holds, lambda r: r.op))


def valid_operators(departures: DataFrame, rows: DataFrame, keys: list[str], time: str, operator: str, start: str, end: str) -> DataFrame:
    """``departures`` with each ``operator`` that has a row of the same ``keys``
    whose interval holds ``time``; a departure may meet an operator more than
    once.  A row that is open at both ends holds an unknown time, too."""
    few, many = _gathered(rows, keys, operator, start, end)
    found = lookup_join(departures.where(reduce(and_, [F.col(k).isNotNull() for k in keys])),
                        aggregated_lookup(few, "validity_rows"), keys, how="inner")
    met = found.select(*departures.columns, F.explode(_valid(F.col("__rows"), F.col(time))).alias(operator))
    return met if many is None else met.unionByName(_by_bins(departures, rows, many, keys, time, operator, start, end))


def _by_bins(departures: DataFrame, rows: DataFrame, many: DataFrame, keys: list[str], time: str, operator: str, start: str, end: str) -> DataFrame:
    """``valid_operators`` of the keys in ``many``."""
    departures, rows = departures.join(many, keys, "left_semi").select(*departures.columns), rows.join(many, keys, "left_semi").select(*rows.columns)
    dtype = dict(departures.dtypes)[time]
    open_ = F.col(start).isNull() & F.col(end).isNull()
    always = rows.where(open_ & F.col(operator).isNotNull()).select(*keys, operator).distinct()
    bins = staged(validity_bins(rows.where(~open_), keys, operator, start, end), "validity_bins")
    units = sorted(r[0] for r in bins.select("unit").distinct().collect())                      # at most UNITS
    unit = F.transform(F.array(*[F.lit(u) for u in units or [0]]),
                       lambda u: F.struct(u.alias("unit"), F.floor(F.col("__bin") / F.pow(F.lit(float(BASE)), u)).cast("int").alias("bin")))
    at = (departures.where(F.col(time).isNotNull()).withColumn("__bin", time_bin(F.col(time), dtype))
          .select(*departures.columns, F.explode(unit).alias("__u")).select(*departures.columns, "__u.unit", "__u.bin"))
    holds = (F.col("__from").isNull() | (F.col("__from") <= F.col(time))) & (F.col("__to").isNull() | (F.col(time) <= F.col("__to")))
    met = at.join(bins, [*keys, "unit", "bin"]).where(holds).select(*departures.columns, operator)
    return met.unionByName(departures.join(always, keys).select(*departures.columns, operator))


def _tiers(assignments: DataFrame, c: ScheduleCols, a: AssignmentCols) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The validity rows under the schedule's names, those of tier 1 that have a
    start, those of tier 2, and of tier 1 the bounds of each (service, vessel)."""
    rows = assignments.select(F.col(a.service).alias(c.service), F.col(a.vessel).alias(c.vessel), F.col(a.operator).alias(c.operator),
                              F.col(a.start).alias("__s"), F.col(a.end).alias("__e"))
    tier1, tier2 = rows.where(F.col(c.service).isNotNull()), rows.where(F.col(c.service).isNull()).drop(c.service)
    bounds = tier1.groupBy(c.service, c.vessel).agg(
        F.max("__s").alias("__latest"), F.min("__e").alias("__earliest"),
        F.bool_or(F.col("__s").isNull() | F.col(c.operator).isNull()).alias("__lacking"))
    return rows, tier1.where(F.col("__s").isNotNull()), tier2, bounds


def _falls(lacking: Column, latest: Column, earliest: Column, t: Column) -> Column:
    """NVL falls through to tier 2 unless there are tier-1 matches, all valid at the departure, all with an operator."""
    all_valid = ~lacking & (latest <= t) & (earliest.isNull() | (t <= earliest))
    return ~F.coalesce(all_valid, F.lit(False))


def service_operators(first_dep: DataFrame, assignments: DataFrame,
                      c: ScheduleCols = ScheduleCols(),
                      a: AssignmentCols = AssignmentCols()) -> DataFrame:
    """Distinct (voyage, operator, carrier) candidates (JOB3 step 2).

    The departures meet the rows of their service and vessel, then the general
    rows of their vessel: two joins that add no rows."""
    out, t = [c.voyage, c.operator, c.carrier], F.col(c.first_dep)
    by_both, by_vessel = [c.service, c.vessel], [c.vessel]
    rows, started, tier2, bounds = _tiers(assignments, c, a)
    few1, many1 = _gathered(started, by_both, c.operator, "__s", "__e")
    few2, many2 = _gathered(tier2, by_vessel, c.operator, "__s", "__e")
    falls = _falls(F.col("__lacking"), F.col("__latest"), F.col("__earliest"), t)
    named = lookup_join(first_dep, merged_lookup([bounds, few1], by_both, "validity_bounds"), by_both)
    named = named.select(*first_dep.columns, _valid(F.col("__rows"), t).alias("__ops"), falls.alias("__falls"))
    general = lookup_join(named, aggregated_lookup(few2, "validity_rows"), by_vessel)
    none = F.array().cast(f"array<{dict(rows.dtypes)[c.operator]}>")
    met = F.array_union(F.coalesce("__ops", none), F.coalesce(F.when(F.col("__falls"), _valid(F.col("__rows"), t)), none))
    found = general.select(c.voyage, F.explode(met).alias(c.operator), c.carrier)
    if many1 is not None:
        found = found.unionByName(_by_bins(first_dep, started, many1, by_both, c.first_dep, c.operator, "__s", "__e").select(*out))
    if many2 is not None:
        fall_through = named.where("__falls").select(*first_dep.columns)
        found = found.unionByName(_by_bins(fall_through, tier2, many2, by_vessel, c.first_dep, c.operator, "__s", "__e").select(*out))
    return found.distinct().select(*out)


def voyage_operators(first_dep: DataFrame, svc_ops: DataFrame, vessels: DataFrame,
                     c: ScheduleCols = ScheduleCols()) -> DataFrame:
    """JOB3 step 3: per (voyage, carrier) operator rows.

    vessels -- (vessel, operator) default operator per vessel (L12).
    """
    single = keys_with_count(svc_ops, [c.voyage, c.carrier], 1, out_keys=[c.voyage])
    by_service = in_keys(
        first_dep.join(svc_ops, [c.voyage, c.carrier], "left")
        .select(c.voyage, c.carrier, c.operator), single, [c.voyage])
    by_vessel = not_in_keys(
        first_dep.join(vessels.select(c.vessel, c.operator), [c.vessel], "left")
        .select(c.voyage, c.carrier, c.operator), single, [c.voyage])
    return by_service.unionByName(by_vessel)


def resolve_operator(schedule: DataFrame, assignments: DataFrame, vessels: DataFrame,
                     c: ScheduleCols = ScheduleCols(), a: AssignmentCols = AssignmentCols(),
                     materialize: str | None = "small") -> DataFrame:
    """JOB3: attach OPERATOR to every schedule row (left join on voyage and
    carrier; a NULL carrier gets no operator, S4).

    The first-departure table feeds four branches and the candidate table
    two; Catalyst does not share such subplans once their optimised forms
    differ, so they are written once (``materialize="small"``).  The
    enriched schedule itself is then read twice: once column-pruned to the
    five columns the first departure needs, once whole for the final join.
    ``materialize="persist"`` also keeps the schedule (memory, spilling to
    disk; lost blocks are recomputed from lineage) so the chain upstream runs
    once; ``"all"`` writes it once to the shared checkpoint folder instead
    (survives executor loss without recomputation); ``None`` materialises
    nothing (tests on tiny inputs).
    """
    if materialize not in (None, "small", "persist", "all"):
        raise ValueError(materialize)
    if materialize == "all":
        sched = staged(schedule, "schedule")
    elif materialize == "persist":
        sched = schedule.persist(StorageLevel.MEMORY_AND_DISK)
    else:
        sched = schedule
    voy_ops = _operators_of(sched, assignments, vessels, c, a, materialize)
    return sched.join(voy_ops, [c.voyage, c.carrier], "left")


def _operators_of(departures: DataFrame, assignments: DataFrame, vessels: DataFrame, c: ScheduleCols, a: AssignmentCols,
                  materialize: str | None = "small") -> DataFrame:
    """(voyage, carrier, operator) of the departures."""
    fd = first_departure(departures, c)
    fd = staged(fd, "first_departures") if materialize else fd
    ops = service_operators(fd, assignments, c, a)
    ops = staged(ops, "operators") if materialize else ops
    return voyage_operators(fd, ops, vessels, c)


def resolve_operator_by_stop(calls: DataFrame, carriers: DataFrame, departures: DataFrame, assignments: DataFrame, vessels: DataFrame,
                             widen: Callable[[DataFrame], DataFrame], stop: str = "STOP_ID",
                             c: ScheduleCols = ScheduleCols(), a: AssignmentCols = AssignmentCols(),
                             narrow: DataFrame | None = None) -> DataFrame:
    """``resolve_operator(widen(calls), ...)`` without a move of the wide rows, nor
    of a row for each voyage and carrier.

    calls      -- rows of (voyage, service, vessel, stop, ...), one a call.
    carriers   -- (stop, carrier): the carriers that ``widen`` gives a stop's rows.
    departures -- (stop, departure): the departures that it gives them; only a stop's earliest counts.
    widen      -- joins the lookups, the carriers' among them, and keeps columns that it doesn't know.
    narrow     -- (voyage, service, vessel, stop) of the calls, if that is cheaper to read than ``calls``.

    A call gets its stop's carriers as one array, a voyage its calls and the validity
    rows of its services as arrays, and all of JOB3 is worked out on that one row
    (``_voyage_operators``).  It is joined to the calls by voyage, which they may
    already be dealt by, and a call keeps its own carriers' operators alone; a wide
    row takes its carrier's from these.  Voyages with more calls and carriers than
    ``MANY_A_VOYAGE`` or with a stop, service or vessel that has more than ``MANY``
    rows are left out of that and resolved as in ``resolve_operator``.
    """
    deps = departures.groupBy(stop).agg(F.min(c.departure).alias(c.departure))
    met = lookup_join((calls if narrow is None else narrow).where(F.col(c.voyage).isNotNull()).select(c.voyage, c.service, c.vessel, stop),
                      merged_lookup([_stop_carriers(carriers, stop, c), deps], [stop], "stop_carriers"), [stop])
    none = F.array(F.struct(F.lit(None).cast(dict(carriers.dtypes)[c.carrier]).alias("carrier")))
    met = staged(met.withColumn("__carriers", F.coalesce("__carriers", none)), "met_carriers")
    services, many = _services(met, assignments, vessels, c, a)
    n = F.size("__carriers")
    many = [met.groupBy(c.voyage).agg(F.sum(n).alias("__n"), F.max(n).alias("__most"))
            .where((F.col("__n") > MANY_A_VOYAGE) | (F.col("__most") > MANY)).select(c.voyage), *many]
    large = staged(reduce(DataFrame.unionByName, many).distinct(), "large_voyages")
    some_large = not large.isEmpty()
    if some_large:
        thin = lookup_join(met.join(large, c.voyage, "left_semi").drop("__carriers"), carriers.select(stop, c.carrier).distinct(), [stop])
        voy_ops = _operators_of(thin, assignments, vessels, c, a)
        met, services = met.join(large, c.voyage, "left_anti"), services.join(large, c.voyage, "left_anti")
    found = _voyage_operators(met, services, stop, c).withColumn("__many", F.lit(False))
    if some_large:
        found = found.unionByName(large.withColumn("__many", F.lit(True)), allowMissingColumns=True)
    at_stop = F.filter("__stops", lambda x: x.stop.eqNullSafe(F.col(stop)))
    ops = F.coalesce("__all", F.get(at_stop, F.lit(0)).ops)
    wide = widen(lookup_join(calls, staged(found, "voyage_operators"), [c.voyage]).select(*calls.columns, ops.alias("__ops"), "__many"))
    kept = [c.voyage, c.carrier, *[x for x in wide.columns if x not in (c.voyage, c.carrier, "__ops", "__many")]]
    own = F.filter("__ops", lambda o: F.coalesce(o.carrier, F.col(c.carrier)) == F.col(c.carrier))
    few = wide.where(~F.coalesce("__many", F.lit(False))) if some_large else wide
    out = few.select(*kept, F.explode_outer(F.transform(own, lambda o: o.operator)).alias(c.operator))
    if some_large:
        out = out.unionByName(wide.where("__many").select(*kept).join(voy_ops, [c.voyage, c.carrier], "left"))
    return out


#: A voyage's calls are worked out on one row up to this many carriers of calls.
MANY_A_VOYAGE = 256


def _stop_carriers(carriers: DataFrame, stop: str, c: ScheduleCols) -> DataFrame:
    """(stop, its carriers as ``__carriers``), of which there are ``MANY`` + 1 where a stop has more."""
    own = carriers.where(F.col(stop).isNotNull()).select(stop, c.carrier).distinct()
    at = F.row_number().over(Window.partitionBy(stop).orderBy(c.carrier))
    first = own.withColumn("__at", at).where(F.col("__at") <= MANY + 1)          # an array never holds more
    return first.groupBy(stop).agg(F.collect_list(F.struct(F.col(c.carrier).alias("carrier"))).alias("__carriers"))


def _services(met: DataFrame, assignments: DataFrame, vessels: DataFrame, c: ScheduleCols, a: AssignmentCols) -> tuple[DataFrame, list[DataFrame]]:
    """The services of each voyage with their validity rows and their vessels'
    default operators, and voyages of which some of these are too many."""
    by_both, by_vessel = [c.service, c.vessel], [c.vessel]
    _, started, tier2, bounds = _tiers(assignments, c, a)
    few1, many1 = _gathered(started, by_both, c.operator, "__s", "__e")
    few2, many2 = _gathered(tier2, by_vessel, c.operator, "__s", "__e")
    known = vessels.where(F.col(c.vessel).isNotNull()).select(c.vessel, c.operator)
    many3 = staged(known.groupBy(c.vessel).agg(F.count("*").alias("__n")).where(F.col("__n") > MANY).select(c.vessel), "vessels_many")
    many3 = None if many3.isEmpty() else many3
    known = known.join(many3, c.vessel, "left_anti") if many3 is not None else known
    defaults = known.groupBy(c.vessel).agg(F.collect_list(F.struct(F.col(c.operator).alias("op"))).alias("__defaults"))
    named = met.select(c.voyage, c.service, c.vessel).distinct()
    out = lookup_join(named, merged_lookup([bounds, few1.withColumnRenamed("__rows", "__tier1")], by_both, "validity_bounds"), by_both)
    out = lookup_join(out, merged_lookup([few2.withColumnRenamed("__rows", "__tier2"), defaults], by_vessel, "vessel_rows"), by_vessel)
    over = [named.join(m, k, "left_semi").select(c.voyage) for m, k in ((many1, by_both), (many2, by_vessel), (many3, by_vessel)) if m is not None]
    return out, over


def _voyage_operators(met: DataFrame, services: DataFrame, stop: str, c: ScheduleCols) -> DataFrame:
    """(voyage, ``__all``, ``__stops``): the (carrier, operator) entries of each
    stop, or once, without a carrier, if all carriers have the same operators."""
    call = F.struct(F.col(c.service).alias("svc"), F.col(c.vessel).alias("vsl"), F.col(stop).alias("stop"),
                    F.col(c.departure).alias("dep"), F.col("__carriers").alias("carriers"))
    held = F.struct(F.col(c.service).alias("svc"), F.col(c.vessel).alias("vsl"), "__tier1", "__tier2", "__latest", "__earliest", "__lacking", "__defaults")
    one = (met.repartition(c.voyage).groupBy(c.voyage).agg(F.collect_set(call).alias("__calls"))
           .join(services.groupBy(c.voyage).agg(F.collect_list(held).alias("__services")), c.voyage))
    kind, carrier_type = (dict(d.dtypes)[col].removeprefix("array<struct<").partition(":")[2][:-2] for d, col in ((services, "__defaults"), (met, "__carriers")))
    nothing = F.array().cast(f"array<{kind}>")

    def of(p: Column, x: Column) -> Column:                        # of the same service and vessel
        return x.svc.eqNullSafe(p.svc) & x.vsl.eqNullSafe(p.vsl)

    def first_dep(p: Column) -> Column:
        met_by = F.filter("__calls", lambda x: of(p, x) & F.exists(x.carriers, lambda k: k.carrier.eqNullSafe(p.carrier)))
        return F.array_min(F.transform(met_by, lambda x: x.dep))

    def candidates(w: Column, t: Column) -> Column:
        falls = _falls(w["__lacking"], w["__latest"], w["__earliest"], t)
        return F.array_union(F.coalesce(_valid(w["__tier1"], t), nothing), F.coalesce(F.when(falls, _valid(w["__tier2"], t)), nothing))

    def entries(carrier: Column, operators: Column) -> Column:     # of a left join: NULL if there is no operator
        return F.transform(F.when(F.size(operators) > 0, operators).otherwise(F.array(F.lit(None).cast(kind))),
                           lambda o: F.struct(carrier.alias("carrier"), o.alias("operator")))

    def short(pairs: Column) -> Column:                            # NULL unless all carriers have the same operators
        known = F.array_distinct(F.transform(pairs, lambda o: o.carrier))
        lists = F.array_distinct(F.transform(known, lambda k: F.transform(F.filter(pairs, lambda o: o.carrier == k), lambda o: o.operator)))
        return F.when(F.size(lists) == 1, F.transform(F.get(lists, F.lit(0)), lambda o: F.struct(F.lit(None).cast(carrier_type).alias("carrier"), o.alias("operator"))))

    met_by = F.flatten(F.transform("__calls", lambda x: F.transform(x.carriers, lambda k: F.struct(x.svc.alias("svc"), x.vsl.alias("vsl"), k.carrier.alias("carrier")))))
    one = one.select("*", F.array_distinct(met_by).alias("__met"))
    one = one.select("*", F.transform("__met", lambda p: F.struct(p.carrier.alias("carrier"), first_dep(p).alias("t"),
                                                                  F.get(F.filter("__services", lambda w: of(p, w)), F.lit(0)).alias("w"))).alias("__first"))
    one = one.select(c.voyage, "__calls", F.transform("__first", lambda p: F.struct(
        p.carrier.alias("carrier"), candidates(p.w, p.t).alias("ops"), F.coalesce(F.transform(p.w["__defaults"], lambda d: d.op), nothing).alias("defaults"))).alias("__found"))
    # a carrier's candidates under any service of the voyage
    every = F.transform("__found", lambda q: F.struct(q.carrier.alias("carrier"), q.defaults.alias("defaults"), F.array_distinct(F.flatten(F.transform(
        F.filter("__found", lambda r: r.carrier.eqNullSafe(q.carrier)), lambda r: r.ops))).alias("ops")))
    one = one.select(c.voyage, "__calls", every.alias("__found"))
    pairs = F.when(F.exists("__found", lambda q: F.size(q.ops) == 1), F.flatten(F.transform("__found", lambda q: entries(q.carrier, q.ops)))) \
        .otherwise(F.flatten(F.transform("__found", lambda q: entries(q.carrier, q.defaults))))
    one = one.select(c.voyage, "__calls", F.filter(pairs, lambda o: o.carrier.isNotNull()).alias("__pairs"))
    own = F.transform("__calls", lambda x: F.struct(x.stop.alias("stop"), F.filter("__pairs", lambda o: F.exists(x.carriers, lambda k: k.carrier == o.carrier)).alias("ops")))
    one = one.select(c.voyage, short(F.col("__pairs")).alias("__all"), F.array_distinct(own).alias("__own"))
    least = F.transform("__own", lambda x: F.struct(x.stop.alias("stop"), F.coalesce(short(x.ops), x.ops).alias("ops")))
    return one.select(c.voyage, "__all", F.when(F.col("__all").isNull(), F.filter(least, lambda x: F.size(x.ops) > 0)).alias("__stops"))
