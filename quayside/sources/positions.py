"""The ledger of feed positions (SNK5, SRC7): how far a feed had come when a
snapshot was taken, one row per part of the feed.

A load records the positions *before* it reads its source, so every change
that the snapshot misses lies at or behind them; a refresh starts there
(``streaming.refresh``), and a Kafka source is told so by its options.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.sinks.tables import write_table
from quayside.streaming.refresh import Feed, feed_positions

LEDGER_SCHEMA = "part string, position long, recorded_at timestamp"


def record_positions(spark: SparkSession, ledger_path: str, changes: DataFrame, feed: Feed) -> dict[str, int]:
    """Write the feed's positions as they are now to its ledger, and give them."""
    now = feed_positions(changes, feed)
    rows = spark.createDataFrame(list(now.items()), "part string, position long").withColumn("recorded_at", F.current_timestamp())
    write_table(rows, ledger_path, num_files=1)
    return now


def read_positions(spark: SparkSession, ledger_path: str) -> dict[str, int]:
    """The recorded positions; a ledger that can't be read fails."""
    return {r.part: r.position for r in spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path).collect()}


def kafka_offsets(topic: str, positions: Mapping[str, int]) -> str:
    """Positions of a topic's partitions as Kafka's ``startingOffsets``."""
    return json.dumps({topic: {p: positions[p] for p in sorted(positions, key=int)}})
