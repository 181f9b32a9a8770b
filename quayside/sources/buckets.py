"""Load buckets (SRC8-SRC11) that know which values of the raw column they hold.

A bucket is an expression over a raw column, which a scan can't be pruned by.
These classes give the way back: the span of a bucket in whole days or keys,
and the condition on the raw column for a range of them, which the scan gets as
a pushed filter.  ``changed_rows`` turns the changed buckets into few merged
ranges that way.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.scalar import DAY_LABEL, MONTH_LABEL, bucket_start, key_range

#: Ranges that a scan's filter names at most; more are merged across their smallest gaps.
MAX_RANGES = 64
_EPOCH = _dt.date(1970, 1, 1)
_MIN, _MAX = -(1 << 63), (1 << 63) - 1


@dataclass(frozen=True)
class TimeBucket:
    """``days`` wide within a month (31: the month), of a date, a timestamp,
    or ``yyyyMMdd...`` text."""
    raw: str
    days: int = 31
    text: bool = False

    def column(self) -> Column:
        return bucket_start(self.raw, self.days, from_string=self.text)

    def span(self, bucket: Column) -> tuple[Column, Column]:
        """First day, and the day after the last one, since 1970."""
        first = F.to_date(bucket, MONTH_LABEL if self.days >= 31 else DAY_LABEL)
        next_month = F.add_months(F.trunc(first, "month"), 1)
        last = next_month if self.days >= 31 else F.least(F.date_add(first, self.days), next_month)
        return F.unix_date(first).cast("long"), F.unix_date(last).cast("long")

    def within(self, low: int, high: int, raw_type: str) -> Column:
        days = [_EPOCH + _dt.timedelta(days=n) for n in (low, high)]
        if self.text:
            low_, high_ = (F.lit(d.strftime("%Y%m%d").zfill(8)) for d in days)
        else:
            low_, high_ = (F.lit(f"{d.isoformat()}").cast(raw_type) for d in days)
        return (F.col(self.raw) >= low_) & (F.col(self.raw) < high_)

    def unknown(self) -> Column | None:
        """The rows of the NULL bucket, if a scan can find them: of text that
        isn't a time it can't."""
        return None if self.text else F.col(self.raw).isNull()


@dataclass(frozen=True)
class KeyRange:
    """``size`` neighbouring integer keys."""
    raw: str
    size: int

    def column(self) -> Column:
        return key_range(self.raw, self.size)

    def span(self, bucket: Column) -> tuple[Column, Column]:
        size, one = F.lit(self.size).cast("long"), F.lit(1).cast("long")
        low, high = F.try_multiply(bucket, size), F.try_multiply(F.try_add(bucket, one), size)     # NULL beyond the range of a long
        return F.coalesce(low, F.lit(_MIN)), F.coalesce(high, F.lit(_MAX))

    def within(self, low: int, high: int, raw_type: str) -> Column:
        cond = F.col(self.raw) >= F.lit(low)
        return cond if high == _MAX else cond & (F.col(self.raw) < F.lit(high))

    def unknown(self) -> Column | None:
        return F.col(self.raw).isNull()


Bucket = TimeBucket | KeyRange


def merged_ranges(buckets: DataFrame, bucket: Bucket, most: int = MAX_RANGES) -> list[tuple[int, int]]:
    """The spans of ``buckets`` (column ``bucket``, one row each) as at most
    ``most`` ranges: neighbours are joined, and what is beyond that across the
    smallest gaps.  Only the ``most`` - 1 widest gaps and the two ends meet the
    driver."""
    low, high = bucket.span(F.col("bucket"))
    spans = buckets.where(F.col("bucket").isNotNull()).select(low.alias("low"), high.alias("high"))
    ends = spans.agg(F.min("low").alias("low"), F.max("high").alias("high")).first()
    if ends["low"] is None:
        return []
    before = Window.orderBy("low").rowsBetween(Window.unboundedPreceding, -1)       # one row a bucket
    gaps = spans.withColumn("upto", F.max("high").over(before)).where(F.col("low") > F.col("upto"))
    width = F.col("low").cast("decimal(20,0)") - F.col("upto").cast("decimal(20,0)")
    cuts = sorted((g["upto"], g["low"]) for g in gaps.orderBy(width.desc(), "low").limit(most - 1).collect())
    return list(zip([ends["low"], *[c[1] for c in cuts]], [*[c[0] for c in cuts], ends["high"]]))


def changed_rows(source: DataFrame, bucket: Bucket, changed: DataFrame) -> DataFrame:
    """The rows of ``source`` in the ``changed`` buckets, with their ``bucket``.

    The scan gets the merged ranges of the raw column as a filter; the join
    that follows leaves the rows of the changed buckets alone, so a range that
    covers more costs reading and never a wrong row.
    """
    todo = changed.select(F.col("bucket").alias("__b"))
    raw_type = dict((c.lower(), t) for c, t in source.dtypes)[bucket.raw.lower()]
    known = [bucket.within(low, high, raw_type) for low, high in merged_ranges(changed, bucket)]
    null_changed = bool(changed.where(F.col("bucket").isNull()).limit(1).count())
    parts = []
    if null_changed and bucket.unknown() is None:
        # found by the expression alone: a read of its own, so that the other one stays pruned
        parts.append(source.where(bucket.column().isNull()))
    elif null_changed:
        known.append(bucket.unknown())
    if known or not parts:
        parts.append(source.where(reduce(or_, known) if known else F.lit(False)))
    rows = reduce(DataFrame.unionByName, [p.withColumn("bucket", bucket.column()) for p in parts])
    return rows.join(todo, rows["bucket"].eqNullSafe(todo["__b"]), "left_semi")
