"""Source readers (SRC6, SRC10, ST2): JDBC snapshots split by key range and
change feeds with a starting position.

Both are option sets on ``spark.read`` / ``spark.readStream``; the format is
a parameter (JDBC and Kafka jars are not on this image, so tests use files).
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from quayside.sources.positions import kafka_offsets


def key_range_partitions(lower: int, upper: int, rows_per_range: int) -> int:
    """Number of key ranges of ``rows_per_range`` keys between the bounds
    (the reference sizes ranges at 2,000,000 and 4,000,000 keys)."""
    return max(1, math.ceil((upper - lower + 1) / rows_per_range))


def jdbc_table(spark: SparkSession, url: str, table: str, *, key: str | None = None,
               lower: int | None = None, upper: int | None = None,
               rows_per_range: int = 2_000_000, properties: dict | None = None) -> DataFrame:
    """SRC6 / SRC10: read a source table over JDBC.  With ``key`` and bounds
    the read is split into one query per key range, each a Spark task, so a
    large table is pulled in parallel instead of through one connection."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if key is not None and lower is not None and upper is not None:
        r = (r.option("partitionColumn", key).option("lowerBound", str(lower))
             .option("upperBound", str(upper))
             .option("numPartitions", str(key_range_partitions(lower, upper, rows_per_range))))
    return r.load()


def feed_stream(spark: SparkSession, *, fmt: str = "kafka", options: dict | None = None,
                starting_timestamp_ms: int | None = None, topic: str | None = None,
                positions: Mapping[str, int] | None = None, schema=None, path: str | None = None) -> DataFrame:
    """ST1 / ST2: a change-feed stream.  For Kafka, the recorded ``positions``
    of ``topic`` become ``startingOffsets``, or ``starting_timestamp_ms`` (e.g.
    the snapshot's time less the 4320-minute lookback) ``startingTimestamp``:
    where a stream without a checkpoint begins.  With a checkpoint, that owns
    the positions.  Other formats get the same start from ``refresh_stream``."""
    r = spark.readStream.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    if fmt == "kafka":
        if topic is not None:
            r = r.option("subscribe", topic)
        if positions:
            r = r.option("startingOffsets", kafka_offsets(topic, positions))
        elif starting_timestamp_ms is not None:
            r = r.option("startingTimestamp", str(starting_timestamp_ms))
    return r.load(path) if path is not None else r.load()
