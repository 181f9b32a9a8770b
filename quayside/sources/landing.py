"""Landing jobs (SRC6-SRC11, SNK1-SNK3, SNK5).

* ``snapshot_load``      -- copy a source to a target, optionally with derived
                            columns and a partition column (SRC6, SRC7).
* ``bucket_stats``       -- per-bucket fingerprint: row count, newest update,
                            and an order-independent key hash (SNK5 ledger).
* ``changed_buckets``    -- buckets whose fingerprint differs from the ledger.
* ``incremental_load``   -- reload only the changed buckets with a dynamic
                            partition overwrite, then record the new ledger
                            (SRC8, SRC9; SRC10 with a key-range bucket).

The ledger holds one row per bucket (months, or key ranges of millions of
rows), so it is tiny; the fingerprint is a partial+final hash aggregate, so
computing it over the whole source is one scan with a small shuffle.  The
reload is a semi join of the source on the changed buckets; with a bucket of
``sources.buckets`` its scan is pruned to their ranges of the raw column.  When
the target is partitioned by bucket, only those partitions are rewritten.

``incremental_load`` replaces partitions in place, for table formats that
commit them together; on plain files a reader can meet a load half done.
``sources.landed.LandedTable`` publishes a load as one commit.

The key hash uses ``xxhash64`` summed as DECIMAL(38,0) (no overflow under
ANSI mode); together with the count and the newest update it detects a
delete paired with an insert that leaves count and max unchanged.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from quayside.session import checkpointed, scratch_path
from quayside.sinks.tables import write_table
from quayside.sources.buckets import Bucket, changed_rows

LEDGER_COLS = ["bucket", "row_count", "max_update", "pk_hash"]


def bucket_stats(df: DataFrame, bucket: Column | str, update_col: str, pk: str) -> DataFrame:
    b = F.col(bucket) if isinstance(bucket, str) else bucket
    return (df.groupBy(b.alias("bucket"))
            .agg(F.count(F.lit(1)).alias("row_count"),
                 F.max(update_col).alias("max_update"),
                 F.sum(F.xxhash64(F.col(pk)).cast("decimal(38,0)")).alias("pk_hash")))


def changed_buckets(current: DataFrame, ledger: DataFrame) -> DataFrame:
    """Full outer join of two small per-bucket tables; a bucket is changed
    when it is new, gone, or any fingerprint field differs (NULL-safe)."""
    c = current.select(*[F.col(x).alias(f"src_{x}") for x in LEDGER_COLS])
    l_ = ledger.select(*[F.col(x).alias(f"led_{x}") for x in LEDGER_COLS])
    # NULL-safe: rows whose bucket expression is NULL (malformed time) form a bucket too
    j = (c.join(l_, c["src_bucket"].eqNullSafe(l_["led_bucket"]), "full_outer")
         .withColumn("bucket", F.coalesce("src_bucket", "led_bucket"))
         .drop("src_bucket", "led_bucket"))
    same = F.lit(True)
    for x in LEDGER_COLS[1:]:
        same = same & F.col(f"src_{x}").eqNullSafe(F.col(f"led_{x}"))
    return j.withColumn("changed", ~same)


def snapshot_load(source: DataFrame, path: str, *, fmt: str = "parquet",
                  derived: dict[str, Column] | None = None, partition_by: list[str] | None = None,
                  num_files: int | None = None, max_records_per_file: int | None = None,
                  mode: str = "overwrite") -> DataFrame:
    """SRC6 / SRC7: write ``source`` (plus derived columns) to ``path``.

    With ``partition_by`` the rows are clustered on the partition columns
    (``rebalance``: AQE splits a large partition value over several writer
    tasks); ``num_files`` fixes the file count instead (SNK2, small tables);
    ``max_records_per_file`` bounds file size either way.
    """
    df = source.withColumns(derived) if derived else source
    write_table(df, path, fmt=fmt, partition_by=partition_by, num_files=num_files, mode=mode,
                max_records_per_file=max_records_per_file)
    return df


def incremental_load(spark: SparkSession, source: DataFrame, target_path: str, ledger_path: str | None,
                     bucket: Column | Bucket, update_col: str, pk: str, *, fmt: str = "parquet",
                     ledger: DataFrame | None = None) -> DataFrame:
    """SRC8 / SRC10: reload the buckets whose fingerprint changed.

    Returns the bucket comparison (one row per bucket).  The target is
    partitioned by ``bucket``; the write is a dynamic partition overwrite of
    the changed buckets only.  The current fingerprint is checkpointed (to the
    cluster's checkpoint folder) so the ledger written afterwards is exactly
    the one the reload was decided on, without a second scan.
    """
    by = bucket if isinstance(bucket, Column) else bucket.column()
    stats = checkpointed(bucket_stats(source, by, update_col, pk))
    if ledger is None:
        if ledger_path is None:
            raise ValueError("need a ledger or a ledger path")
        if path_exists(spark, ledger_path):        # a ledger that can't be read fails the load
            ledger = spark.read.schema(stats.schema).parquet(ledger_path)
        else:                                      # first run: no ledger yet
            ledger = spark.createDataFrame([], stats.schema)
    diff = checkpointed(changed_buckets(stats, ledger))
    todo = diff.where("changed AND src_row_count IS NOT NULL")
    if isinstance(bucket, Column):               # any expression: the whole source is read again
        rows, todo = source.withColumn("bucket", bucket), todo.select(F.col("bucket").alias("__b"))
        rows = rows.join(todo, rows["bucket"].eqNullSafe(todo["__b"]), "left_semi")
    else:
        rows = changed_rows(source, bucket, todo)
    write_table(rows, target_path, fmt=fmt, partition_by=["bucket"], mode="overwrite",
                dynamic=True)
    _drop_emptied(spark, target_path, diff)
    if ledger_path is not None:
        # the old ledger was read into the checkpointed comparison above, so
        # overwriting its folder now is safe
        write_table(stats, ledger_path, fmt="parquet", num_files=1, mode="overwrite")
    return diff


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _drop_emptied(spark: SparkSession, target_path: str, diff: DataFrame) -> None:
    """Remove the partitions of buckets that the source has no rows of any
    more.  Their numbers come to the driver one partition of ``diff`` at a time."""
    gone = diff.where("changed AND src_row_count IS NULL").select(F.col("bucket").cast("string").alias("b"))
    jvm = spark._jvm
    for r in gone.toLocalIterator():
        name = "__HIVE_DEFAULT_PARTITION__" if r.b is None else \
            jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(r.b)
        p = jvm.org.apache.hadoop.fs.Path(f"{target_path.rstrip('/')}/bucket={name}")
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def read_landed(spark: SparkSession, target_path: str, ledger_path: str, fmt: str = "parquet",
                schema: StructType | None = None) -> DataFrame:
    """Read an incrementally loaded table through its ledger.

    ``incremental_load`` removes the partition of a bucket that the source
    emptied before it writes the new ledger; between the two a reader that
    semi-joins the target with the ledger's buckets still sees one state.  The
    bucket has the ledger's type (``007`` stays text); ``schema``: of the other
    columns, inferred otherwise."""
    buckets = spark.read.parquet(ledger_path).select(F.col("bucket").alias("__b"))
    own = schema or spark.read.format(fmt).load(target_path).drop("bucket").schema
    landed = spark.read.format(fmt).schema(StructType([*own.fields, StructField("bucket", buckets.schema[0].dataType)])).load(target_path)
    return landed.join(buckets, landed["bucket"].eqNullSafe(buckets["__b"]), "left_semi")


def scratch_table_path(spark: SparkSession, kind: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return scratch_path(spark, "quayside", kind, uuid.uuid4().hex)
