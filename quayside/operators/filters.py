"""Row filters.

All of these are plain Catalyst predicates or semi/anti joins, so they push
into the parquet scan (literal comparisons) or run as distributed joins.
The reference's ``collect()`` of a key list followed by ``IN``/``NOT IN`` is
replaced by ``left_semi`` / ``left_anti`` joins: no list ever reaches the
driver, and the plan does not grow with the number of keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_suffix(col: str, suffix: str) -> Column:
    """``col NOT LIKE '%suffix'``; a NULL value is dropped (3-valued logic)."""
    return ~F.col(col).endswith(suffix)


def not_deleted(col: str = "is_deleted") -> Column:
    """soft-delete flag equal to 0."""
    return F.col(col) == F.lit(0)


def equals(col: str, value) -> Column:
    """literal equality."""
    return F.col(col) == F.lit(value)


def any_present(*cols: str) -> Column:
    """at least one of the columns is non-NULL."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNotNull()
    return cond


def keys_with_count(df: DataFrame, keys: Sequence[str], n: int = 1,
                    out_keys: Sequence[str] | None = None) -> DataFrame:
    """A3 + F9: distinct ``out_keys`` of groups (by ``keys``) holding exactly
    ``n`` rows — ``GROUP BY keys HAVING count(*) = n``."""
    out = list(out_keys or keys)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__cnt"))
            .where(F.col("__cnt") == n).select(*out).distinct())


def in_keys(df: DataFrame, keys_df: DataFrame, on: Sequence[str]) -> DataFrame:
    """``col IN (list)`` as a left-semi join (NULL keys never match)."""
    return df.join(keys_df.select(*on), on=list(on), how="left_semi")


def not_in_keys(df: DataFrame, keys_df: DataFrame, on: Sequence[str]) -> DataFrame:
    """F8: ``col NOT IN (list)`` with SQL NULL semantics.

    An anti join alone would keep rows whose key is NULL; ``NOT IN`` drops
    them whenever the list is non-empty.  The "list is empty" test is a
    scalar ``EXISTS`` subquery, so nothing is collected to the driver.
    """
    listed = keys_df.select(*on)
    kept = df.join(listed, on=list(on), how="left_anti")
    key_present = F.lit(True)
    for c in on:
        key_present = key_present & F.col(c).isNotNull()
    return kept.where(key_present | ~listed.exists())
