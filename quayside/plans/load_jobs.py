"""Load and refresh jobs over a table catalogue (SRC6-SRC10, SNK5, ST1-ST5).

The catalogue is a JSON object, one entry per table::

    {"orders": {"source": "ops_orders", "key": "order_id", "update": "upd_ts",
                "bucket": {"kind": "time", "column": "cre_ts", "days": 31},
                "payload": ["status", "amount"], "lookback_minutes": 4320,
                "part": "partition", "offset": "offset"}}

``bucket`` is ``time`` (``column``, ``days``, ``text`` true for
``yyyyMMdd...`` strings), ``month`` (``column``) or ``range`` (``size`` keys).
``part`` and ``offset`` name a change's place in the feed, if it has one.

Commands::

    snapshot     copy the source table to the target (partitioned by the bucket
                 with ``--partitioned``); with ``--feed`` the feed's positions are
                 recorded first, in a ledger beside the target
    load         reload the buckets that changed since the last load and publish
                 them together (read with ``landed``)
    bootstrap    make the keyed state from the source table, with ``--position``
                 as free text; with ``--feed`` the feed's positions are recorded
                 first and kept with the state
    refresh      apply the change feed of ``--feed`` to the keyed state, from the
                 positions that the state has
    redeal       deal the keyed state into as many buckets as its size needs
    vacuum       delete what only older commits than the last ``--keep`` of the
                 target (a load's or a state's) refer to
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.sinks.state import StateTable
from quayside.sources.buckets import Bucket, KeyRange, TimeBucket
from quayside.sources.landed import LandedTable
from quayside.sources.landing import snapshot_load
from quayside.sources.positions import record_positions
from quayside.sources.readers import feed_stream
from quayside.sources.tables import TableSource
from quayside.streaming.refresh import Feed, bootstrap_state, refresh_stream, state_schema


@dataclass(frozen=True)
class TableSpec:
    source: str
    key: str
    update: str | None = None
    bucket: Mapping = field(default_factory=dict)
    payload: tuple[str, ...] = ()
    lookback_minutes: int | None = None
    tombstone_minutes: int | None = None
    buckets: int | None = None
    part: str | None = None
    offset: str | None = None

    @property
    def feed(self) -> Feed:
        return Feed(pk=self.key, payload=self.payload, part=self.part, offset=self.offset)

    def bucket_of(self) -> Bucket:
        b = dict(self.bucket)
        kind = b.get("kind")
        if kind == "time":
            return TimeBucket(b["column"], int(b.get("days", 31)), bool(b.get("text", False)))
        if kind == "month":
            return TimeBucket(b["column"])
        if kind == "range":
            return KeyRange(self.key, int(b["size"]))
        raise ValueError(f"unknown bucket kind {kind!r} for {self.source}")


def parse_catalogue(text: str) -> dict[str, TableSpec]:
    return {name: TableSpec(**{**spec, "payload": tuple(spec.get("payload", ()))}) for name, spec in json.loads(text).items()}


def read_catalogue(spark: SparkSession, path: str) -> dict[str, TableSpec]:
    return parse_catalogue(spark.read.text(path, wholetext=True).first()[0])


def record(spec: TableSpec, feed: DataFrame | None, target: str) -> dict[str, int]:
    """The feed's positions before a load, written to the ledger beside its target."""
    if feed is None or spec.part is None:
        return {}
    return record_positions(feed.sparkSession, f"{target.rstrip('/')}_positions", feed, spec.feed)


def snapshot(spec: TableSpec, tables: TableSource, target: str, fmt: str = "parquet", partitioned: bool = False,
             feed: DataFrame | None = None) -> DataFrame:
    record(spec, feed, target)
    derived = {"bucket": spec.bucket_of().column()} if partitioned else None
    return snapshot_load(tables(spec.source), target, fmt=fmt, derived=derived, partition_by=["bucket"] if partitioned else None)


def load(spec: TableSpec, tables: TableSource, target: str, fmt: str = "parquet") -> DataFrame:
    """The target is a ``LandedTable``; ``landed`` reads it."""
    source = tables(spec.source)
    return LandedTable(source.sparkSession, target, fmt).load(source, spec.bucket_of(), spec.update, spec.key)


def landed(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    """What the last load that wasn't cut off left in ``target``."""
    return LandedTable(spark, target, fmt).read()


def bootstrap(spec: TableSpec, tables: TableSource, target: str, fmt: str = "parquet", position: str | None = None,
              feed: DataFrame | None = None) -> None:
    """The snapshot's change position is its update column; its sequence 0 loses against every change of that time."""
    taken_at = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    positions = record(spec, feed, target)
    source = tables(spec.source).withColumns({"change_ts": F.col(spec.update), "seq": F.lit(0).cast("long")})
    bootstrap_state(source.sparkSession, target, source, spec.feed, buckets=spec.buckets, fmt=fmt, position=position,
                    positions=positions, taken_at=taken_at)


def redeal(spec: TableSpec, spark: SparkSession, target: str, feed: DataFrame, fmt: str = "parquet") -> None:
    """``feed``: for the types of the state's columns."""
    StateTable(spark, target, fmt=fmt).redeal(state_schema(feed, spec.feed), spec.key, spec.buckets)


def vacuum(spark: SparkSession, target: str, keep: int = 2) -> None:
    """Both kinds of target lay their commits out alike; a landed one has ledgers, too."""
    LandedTable(spark, target).vacuum(keep)


def refresh(spec: TableSpec, feed: DataFrame, target: str, checkpoint: str, fmt: str = "parquet", available_now: bool = True):
    """``feed``: a stream with the key, the payload, ``op``, ``change_ts`` and ``seq``."""
    return refresh_stream(feed.sparkSession, feed, target, checkpoint, spec.feed, buckets=spec.buckets, fmt=fmt,
                          available_now=available_now, lookback_minutes=spec.lookback_minutes,
                          tombstone_minutes=spec.tombstone_minutes)


def main(argv: list[str] | None = None) -> None:
    import argparse

    from quayside.plans.jobs import job_session
    from quayside.sources.tables import catalog_tables
    ap = argparse.ArgumentParser(prog="quayside.plans.load_jobs")
    ap.add_argument("command", choices=["snapshot", "load", "bootstrap", "refresh", "redeal", "vacuum"])
    ap.add_argument("table")
    ap.add_argument("--catalogue", required=True)
    ap.add_argument("--target", required=True)
    ap.add_argument("--source-db")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--partitioned", action="store_true")
    ap.add_argument("--position")
    ap.add_argument("--feed", help="folder of change files (their schema is that of the files there)")
    ap.add_argument("--stream-checkpoint")
    ap.add_argument("--keep", type=int, default=2)
    a = ap.parse_args(argv)
    spark = job_session(f"quayside-{a.command}-{a.table}")
    spec = read_catalogue(spark, a.catalogue)[a.table]
    if a.command == "vacuum":
        vacuum(spark, a.target, a.keep)
        return
    feed = spark.read.format(a.format).load(a.feed) if a.feed else None
    if a.command == "refresh":
        if not (a.feed and a.stream_checkpoint):
            ap.error("refresh needs --feed and --stream-checkpoint")
        refresh(spec, feed_stream(spark, fmt=a.format, schema=feed.schema, path=a.feed), a.target, a.stream_checkpoint,
                a.format).awaitTermination()
        return
    if a.command == "redeal":
        if not a.feed:
            ap.error("redeal needs --feed")
        redeal(spec, spark, a.target, feed, a.format)
        return
    tables = catalog_tables(spark, a.source_db)
    if a.command == "snapshot":
        snapshot(spec, tables, a.target, a.format, a.partitioned, feed)
    elif a.command == "load":
        load(spec, tables, a.target, a.format)
    else:
        bootstrap(spec, tables, a.target, a.format, a.position, feed)


if __name__ == "__main__":
    main()
