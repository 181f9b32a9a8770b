"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quayside.session import checkpoint_dir, scratch_path, staged

__all__ = ["checkpoint_dir", "scratch_path", "staged", "ranked", "partition_offsets", "table", "hash_unit",
           "worker_state", "release_worker_state", "trim_worker", "set_small_batches",
           "small_batches", "WHITE"]

#: Rows of an Arrow batch that holds whole texts.
TEXT_ROWS = 512
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: The white space of every contract here: space and the five controls from tab to carriage return.
WHITE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read through Spark (any path Spark can open)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def partition_offsets(per_partition: DataFrame, order: str, total: str, out: str) -> DataFrame:
    """Exclusive running sum of ``total`` by ``order`` over a table of one row
    per Spark partition.  It has as many rows as there were partitions, never
    as many as there were records, which is why one task may order it."""
    before = W.orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return per_partition.select(order, F.coalesce(F.sum(total).over(before), F.lit(0)).alias(out))


def ranked(df: DataFrame, order: list[Column], out: str, name: str = "ranked") -> DataFrame:
    """``df`` with ``out``: each row's place from 0 in the global ``order``.

    A range exchange sorts the rows; a place is the row's position in its own
    partition plus the row counts of the partitions before it.  The sorted
    table is written once, so that positions and counts are of one run.
    """
    cut = (df.repartitionByRange(*order).sortWithinPartitions(*order)
           .withColumn("_at", F.monotonically_increasing_id()))
    cut = staged(cut.withColumn("_part", F.shiftright("_at", 33)), name)
    starts = partition_offsets(cut.groupBy("_part").agg(F.count("*").alias("_n")), "_part", "_n", "_start")
    place = F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1)
    return (cut.join(F.broadcast(starts), "_part")   # one row per partition of the exchange
            .withColumn(out, place).drop("_part", "_at", "_start"))


def hash_unit(*cols: Column) -> Column:
    """A number in (0, 1) that the columns alone decide."""
    bits = F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double")
    return (bits + 0.5) / float(1 << 53)


def worker_state(kind: str, key, make: Callable):
    """What a Python worker keeps between its tasks (a memo, a model): made at
    the first task that asks for it.  A worker keeps one at a time, so that of
    an operator that has ended nothing is left when the next one's tasks come."""
    kept = sys.modules.setdefault("_quayside_worker", types.ModuleType("_quayside_worker"))
    if getattr(kept, "of", None) != (kind, key):
        release_worker_state()
        kept.state, kept.of = make(), (kind, key)
    return kept.state


def release_worker_state() -> None:
    """For tasks that need the memory and keep nothing."""
    kept = sys.modules.get("_quayside_worker")
    if kept is not None and getattr(kept, "of", None) is not None:
        kept.state = kept.of = None
    trim_worker()


def trim_worker() -> None:
    """Give freed memory back to the system at the end of a task: workers wait
    for the next one while the JVM's own stages want it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc alone has it
    if trim is not None:
        trim(0)


def set_small_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> str:
    """From now on at most ``rows`` rows are sent to a Python worker at a time:
    batches of whole texts are held in full by the executor, outside its heap,
    and by the worker.  The session's own setting, which is returned, stays if
    it is smaller."""
    own = spark.conf.get(_BATCH)
    if not 0 < int(own) <= rows:
        spark.conf.set(_BATCH, str(rows))
    return own


@contextmanager
def small_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> Iterator[None]:
    """``set_small_batches`` for what is run inside."""
    own = set_small_batches(spark, rows)
    try:
        yield
    finally:
        spark.conf.set(_BATCH, own)
