"""Scalar column functions (X2, X3, X5, X6, X8, X9, SRC9, SRC11).

All are compositions of built-in Catalyst expressions, so they stay inside
whole-stage code generation and are constant-folded when given literals.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The landing time-string layout and bucket label formats.
IODT_FORMAT = "yyyyMMddHHmmss"
IODT_DAY_FORMAT = "yyyyMMdd"
MONTH_LABEL = "yyyyMM"
DAY_LABEL = "yyyyMMdd"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nvl(a, b) -> Column:
    """``NVL(a, b)``."""
    return F.coalesce(_c(a), _c(b))


def first_chars(x, n: int) -> Column:
    """``SUBSTR(x, 1, n)``."""
    return F.substring(_c(x), 1, n)


def parse_iodt_day(x) -> Column:
    """Day part of a ``yyyyMMdd...`` time string as a timestamp; NULL for a
    malformed value instead of a failure (ANSI mode, S9)."""
    return F.try_to_timestamp(F.substring(_c(x), 1, 8), F.lit(IODT_DAY_FORMAT))


def bucket_start(x, days: int = 31, fmt: str | None = None, from_string: bool = False) -> Column:
    """SRC11: start of the ``days``-wide bucket within the month of ``x``.

    ``date_add(trunc(x, 'month'), floor((dayofmonth(x) - 1) / days) * days)``
    rendered with ``fmt``.  ``x`` is a timestamp / date column, or a
    ``yyyyMMdd...`` string when ``from_string`` (malformed -> NULL bucket).  With days >= 31 every day maps to the first of
    the month, so the default label is ``yyyyMM``; a smaller bucket needs the
    ``yyyyMMdd`` label to stay distinct, which is the default then.
    """
    col = _c(x)
    d = F.to_date(parse_iodt_day(col) if from_string else col)
    if fmt is None:
        fmt = MONTH_LABEL if days >= 31 else DAY_LABEL
    offset = (F.floor((F.dayofmonth(d) - 1) / F.lit(days)) * F.lit(days)).cast("int")
    return F.date_format(F.date_add(F.trunc(d, "month"), offset), fmt)


def month_label(x) -> Column:
    """X9 / SRC9: ``to_char(d, 'yyyyMM')``."""
    return F.date_format(_c(x), MONTH_LABEL)


def key_range(pk, rows_per_range: int) -> Column:
    """SRC10: key-range bucket ``floor(pk / rows_per_range)``, in integers
    (a double does not hold every long), also for negative keys."""
    k, n = _c(pk).cast("long"), F.lit(rows_per_range).cast("long")
    # pmod is the distance to the range's start; the quotient of what is left is exact
    whole = F.call_function("div", k, n)
    return F.when((k < 0) & (F.pmod(k, n) != 0), whole - 1).otherwise(whole)


def run_timestamp(at: _dt.datetime | None = None) -> Column:
    """Audit timestamp.  ``current_timestamp()`` unless a fixed run time
    is injected (tests and oracle comparisons)."""
    if at is None:
        return F.current_timestamp()
    return F.lit(at).cast("timestamp_ntz")


def nested_get(m, outer: str, inner: str) -> Column:
    """``m[outer][inner]`` (a missing key gives NULL)."""
    return _c(m)[outer][inner]
