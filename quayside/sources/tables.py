"""Table resolution and alias-projection scans (SRC1, SRC2).

A job never hard-codes where its inputs live: it receives a *table source*,
a callable ``name -> DataFrame``.  On a cluster that is the metastore
(``catalog_tables``); in tests and the bench it is a folder of parquet files
(``parquet_tables``).  Both return lazy scans, so the projection and filters a
job applies afterwards reach the parquet reader (``ReadSchema`` /
``PushedFilters`` in ``explain``).
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TableSource = Callable[[str], DataFrame]


def parquet_tables(spark: SparkSession, folder: str) -> TableSource:
    """Resolve ``name`` to ``{folder}/{name}.parquet`` (a file or a folder)."""

    def resolve(name: str) -> DataFrame:
        return spark.read.parquet(os.path.join(folder, f"{name.lower()}.parquet"))

    return resolve


def catalog_tables(spark: SparkSession, database: str | None = None) -> TableSource:
    """Resolve unqualified names against ``database`` (the job's current
    database), qualified ``db.table`` names as given."""

    def resolve(name: str) -> DataFrame:
        if "." in name or database is None:
            return spark.table(name)
        return spark.table(f"{database}.{name}")

    return resolve


def scan_alias(df: DataFrame, columns: Mapping[str, str | Column] | Iterable,
               where: Column | str | None = None) -> DataFrame:
    """``SELECT src AS dst, ... FROM t [WHERE ...]`` as a DataFrame.

    ``columns`` maps output name -> source column name (or a Column
    expression); a plain list keeps names.  The filter is applied before the
    projection so it may use columns that are not kept; Catalyst pushes both
    into the scan.
    """
    if where is not None:
        df = df.where(where)
    cols = []
    for dst, src in _pairs_out(columns):
        expr = src if isinstance(src, Column) else F.col(src)
        cols.append(expr.alias(dst))
    return df.select(*cols)


def _pairs_out(columns):
    if isinstance(columns, Mapping):
        return list(columns.items())
    return [(c, c) if isinstance(c, str) else (c[0], c[1]) for c in columns]
