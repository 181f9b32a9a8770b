"""Table writes (SNK1-SNK3, SNK6).

``write_table`` is the one writer: path-based or catalog (``table=``),
optional partition columns, optional file count, static or dynamic
partition overwrite.  Delta / Iceberg are format strings here; their jars are
not on this image, so tests write parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str | None = None, *, table: str | None = None,
                fmt: str = "parquet", partition_by: list[str] | None = None,
                num_files: int | None = None, mode: str = "overwrite",
                dynamic: bool = False, max_records_per_file: int | None = None) -> None:
    """SNK1: overwrite (default) a path or an external catalog table.

    partition_by -- SNK3; rows are clustered on these columns with a
                    ``rebalance`` hint: AQE then splits a partition value that
                    holds a large share of the rows across several writer
                    tasks (and merges tiny ones), so one hot month never lands
                    in a single task, and most values still get one file.
    num_files    -- SNK2: total output partitions (``repartition(n)``), or,
                    with ``partition_by``, a fixed number of files per
                    partition value (hash salt).
    dynamic      -- replace only the partitions present in ``df``; otherwise
                    an overwrite replaces the whole table.
    """
    if partition_by:
        if num_files:
            salt = F.pmod(F.xxhash64(*df.columns), F.lit(num_files)).alias("__salt")
            df = df.repartition(*[F.col(c) for c in partition_by], salt)
        else:
            df = df.hint("rebalance", *partition_by)
    elif num_files:
        df = df.repartition(num_files)
    # always said, so that no session setting decides what an overwrite replaces
    w = df.write.format(fmt).mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if table is not None:
        if path is not None:
            w = w.option("path", path)
        w.saveAsTable(table)
    else:
        w.save(path)
