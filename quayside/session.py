"""Session construction and cluster-shared folders.

Nothing here is needed on a managed cluster: jobs accept any SparkSession.
``build_session`` exists for tests and the bench so local runs use the same
optimizer settings a cluster run would (AQE on, skew-join splitting on,
partition coalescing on).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package is designed around.
SCALE_CONF = {
    # Runtime re-planning: coalesce tiny shuffle partitions, split skewed
    # join partitions, and turn a sort-merge join into a broadcast join only
    # once the *measured* shuffle output of one side is below the threshold.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lookup chains join on one key again and again; without this a hot key's
    # partition is left whole wherever a later join reuses the partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # Static broadcast decisions use file-size estimates; keep them bounded.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Column names in the source systems are upper case, lookups lower case.
    "spark.sql.caseSensitive": "false",
    "spark.sql.session.timeZone": "UTC",
    # Reliable checkpoints of intermediates are deleted once unreferenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", app: str = "quayside",
                  shuffle_partitions: int = 8, extra: dict | None = None,
                  driver_memory: str = "16g") -> SparkSession:
    """Local session for tests and the bench (local mode: the driver JVM is
    the only executor, so its heap is the memory knob)."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.driver.memory", driver_memory)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session.  Only in plain local mode (one process), when it
    is unset (tests), a private scratch folder is created and registered; on
    any cluster an unset folder is an error, because a machine-local folder
    would not survive the loss of that machine and is invisible to the other
    executors.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="quayside-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for written intermediates)."""
    base = checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), *parts)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (to ``spark.checkpoint.dir``) of a *small*
    intermediate read by several branches of one job, so it is computed once
    and its lineage is cut (an executor lost later does not recompute it)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, name: str = "stage", fmt: str = "parquet") -> DataFrame:
    """Write a *large* intermediate once as a table in the shared checkpoint
    folder and read it back: a columnar file is cheaper to write and re-read
    than recomputing the joins and shuffles that produced it, and it survives
    executor loss."""
    spark = df.sparkSession
    path = scratch_path(spark, "quayside", name, uuid.uuid4().hex)
    df.write.format(fmt).save(path)
    return spark.read.format(fmt).load(path)


#: Rows that a task of a join and aggregate over one key may hold.
TASK_ROWS = 1_000_000


def dealt(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` by ``keys`` in as many partitions as give a task about
    ``TASK_ROWS`` rows, if the session's number of partitions gives it more.
    (The rows are counted: for a plain scan that reads the files' footers.)"""
    need = -(-df.count() // TASK_ROWS)
    return df.repartition(need, *keys) if need > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df
