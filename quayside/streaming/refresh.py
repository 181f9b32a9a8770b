"""Keyed change-feed refresh (ST1-ST5, SNK4), batch and streaming.

Feed contract: one row per change with the key, an operation
(``I``/``U``/``D``), a change timestamp, a tie-break sequence and the payload.
The newest (change_ts, seq) per key wins; ``D`` leaves a tombstone.

State contract: one row per key with the payload, ``change_ts``, ``seq`` and
``is_deleted``.  Tombstones are kept (at least as long as the feed can replay,
ST2) so a late, older update cannot resurrect a deleted row; live rows are
``is_deleted = false``.

``apply_changes`` is the whole algorithm: one aggregate over the state and
the batch that keeps the newest row per key.  It has a map-side partial step,
so a key with a third of all changes costs no more than any other, and it is
idempotent: replaying a batch (``foreachBatch`` after a restart) or splitting
it into k batches gives the same state.

On files the state is a ``sinks.state.StateTable``: hash buckets of the key,
of which a batch reads and rewrites those it touches, in a new version
published with the stream's identity and the batch's number.  A batch that a
crash cut off left nothing published and is applied again; one that was
published is skipped when it comes again.  Numbers start again with a new
stream checkpoint, which is another stream: its batches are applied.

Where a stream begins (SNK5, ST2).  A feed's parts (``Feed.part``) give their
changes in the order of their positions (``Feed.offset``); the state knows how
far each part was applied, from the snapshot's positions on.  A new stream
starts there, or, by ``lookback_minutes``, at the changes of so long before the
snapshot, whichever lets more in; without either it reads the whole feed.
This is fixed when the stream first begins and published with the state, so a
backlog is applied whole however old it is when the stream comes back.  A payload column (a month, say) may be the
table's partitioning for readers: it is data here, so a row that moves to
another month, or a delete that doesn't carry the month, meets its old row by
key (ST3).
"""

from __future__ import annotations

import datetime as _dt
import json
import threading
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quayside.operators.latest import latest_per_key
from quayside.sinks.state import Commit, StateTable, buckets_for


@dataclass(frozen=True)
class Feed:
    pk: str
    payload: tuple[str, ...]
    ts: str = "change_ts"
    seq: str = "seq"
    op: str = "op"
    part: str | None = None            # with ``offset``: a change's place in the feed
    offset: str | None = None

    @property
    def state_cols(self) -> list[str]:
        return [self.pk, *self.payload, self.ts, self.seq, "is_deleted"]


def as_state(changes: DataFrame, feed: Feed) -> DataFrame:
    """Changes as state rows; a change without an operation is an update."""
    return changes.select(feed.pk, *feed.payload, feed.ts, feed.seq,
                          F.col(feed.op).eqNullSafe(F.lit("D")).alias("is_deleted"))


def apply_changes(state: DataFrame | None, changes: DataFrame, feed: Feed) -> DataFrame:
    """New state = newest row per key over state and changes."""
    rows = as_state(changes, feed)
    if state is not None:
        rows = state.select(*feed.state_cols).unionByName(rows)
    return latest_per_key(rows, [feed.pk], order=[feed.ts], tiebreak=[feed.seq], values=feed.state_cols[1:])


def live_rows(state: DataFrame, feed: Feed) -> DataFrame:
    return state.where(~F.col("is_deleted")).drop("is_deleted")


def within_lookback(changes: DataFrame, ts_col: str, minutes: int, now: _dt.datetime) -> DataFrame:
    """ST2: keep changes at most ``minutes`` old relative to ``now`` (the
    reference passes -4320 / -1440).  Replay is safe: the upsert is
    idempotent."""
    return changes.where(F.col(ts_col) >= F.lit(now - _dt.timedelta(minutes=abs(minutes))))


def purge_tombstones(state: DataFrame, feed: Feed, older_than: _dt.datetime) -> DataFrame:
    """Drop tombstones older than the feed's replay horizon."""
    return state.where(~(F.col("is_deleted") & (F.col(feed.ts) < F.lit(older_than))))


def state_schema(changes: DataFrame, feed: Feed) -> StructType:
    return as_state(changes, feed).schema


def read_state(spark: SparkSession, state_path: str, schema: StructType, buckets: int | None = None,
               fmt: str = "parquet") -> DataFrame:
    """The state as last published."""
    return StateTable(spark, state_path, buckets, fmt).read(schema)


def feed_positions(changes: DataFrame, feed: Feed) -> dict[str, int]:
    """The first position behind ``changes`` in each part of the feed (a row
    for a part, of which a feed has a fixed number)."""
    if feed.part is None:
        return {}
    known = changes.where(F.col(feed.offset).isNotNull()).groupBy(F.col(feed.part).cast("string").alias("part"))
    return {r["part"]: r["at"] + 1 for r in known.agg(F.max(feed.offset).alias("at")).collect() if r["part"] is not None}


def stream_start(commit: Commit | None, lookback_minutes: int | None = None) -> dict | None:
    """Where a new stream begins on a state: its positions, and the time so
    long before its snapshot.  None: at the beginning of the feed."""
    if commit is None:
        return None
    since = None
    if lookback_minutes is not None and commit.snapshot_at:
        since = (_dt.datetime.fromisoformat(commit.snapshot_at) - _dt.timedelta(minutes=abs(lookback_minutes))).isoformat()
    return {"positions": commit.positions, "since": since} if commit.positions or since else None


def from_start(feed: Feed, start: Mapping | None) -> Column:
    """Whether a change lies at or behind a start.  Changes without a place or
    a time, and those of parts that the start doesn't know, do."""
    if not start:
        return F.lit(True)
    keep = []
    if start["positions"] and feed.part is not None:
        part, at = F.col(feed.part).cast("string"), F.col(feed.offset)
        keep += [part.isNull(), at.isNull(), ~part.isin(list(start["positions"]))]
        keep += [(part == F.lit(p)) & (at >= F.lit(n)) for p, n in start["positions"].items()]
    if start["since"]:
        keep += [F.col(feed.ts).isNull(), F.col(feed.ts) >= F.lit(_dt.datetime.fromisoformat(start["since"]))]
    return reduce(or_, keep) if keep else F.lit(True)


def refresh_state(spark: SparkSession, state_path: str, changes: DataFrame, feed: Feed, *, batch_id: int | None = None,
                  stream: str = "", start: Mapping | None = None, buckets: int | None = None, fmt: str = "parquet",
                  purge_before: _dt.datetime | None = None) -> bool:
    """SNK4 + ST3 on a path: rewrite the buckets that the batch touches (at
    most as many numbers as there are buckets meet the driver).  False if
    ``batch_id`` of ``stream`` was applied before.  ``purge_before``: tombstones
    of the touched buckets that are older go.  ``buckets``: of a new state."""
    table = StateTable(spark, state_path, buckets, fmt)
    now = table.latest()
    last = now.batch(stream) if now else None
    if batch_id is not None and last is not None and batch_id <= last:
        return False
    touched = [r[0] for r in changes.select(table.bucket(feed.pk).alias("b")).distinct().collect()]
    state = table.read(state_schema(changes, feed), now, touched) if now else None
    new = apply_changes(state, changes, feed)
    if purge_before is not None:
        new = purge_tombstones(new, feed, purge_before)
    table.commit(new, feed.pk, touched, batch_id, stream=stream, start=start, positions=feed_positions(changes, feed))
    return True


def bootstrap_state(spark: SparkSession, state_path: str, snapshot: DataFrame, feed: Feed, *, buckets: int | None = None,
                    fmt: str = "parquet", position: str | None = None, positions: Mapping[str, int] | None = None,
                    taken_at: _dt.datetime | None = None) -> None:
    """ST4: the state becomes that of a snapshot load, whatever it was before.

    ``snapshot`` has the key, the payload and the snapshot's change position
    (``feed.ts`` / ``feed.seq``); every row is live.  ``positions`` (SNK5) are
    the feed's as they were before the snapshot was read, ``taken_at`` is when
    that was (UTC, now by default): streams start there or earlier, replayed
    older changes lose against the snapshot rows, newer ones win.  ``position``
    is kept as free text.  ``buckets``: by default as many as the snapshot's
    rows need."""
    taken_at = taken_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    rows = snapshot.select(feed.pk, *feed.payload, feed.ts, feed.seq).withColumn("is_deleted", F.lit(False))
    StateTable(spark, state_path, buckets, fmt).commit(
        rows, feed.pk, None, position=position, positions=positions, snapshot_at=taken_at, buckets=buckets or buckets_for(rows.count()))


def start_position(spark: SparkSession, state_path: str, buckets: int | None = None) -> str | None:
    """The feed position kept by the last snapshot load."""
    commit = StateTable(spark, state_path, buckets).latest()
    return commit.position if commit else None


def checkpoint_stream(spark: SparkSession, checkpoint_location: str) -> str | None:
    """The identity of the stream that a checkpoint belongs to; None if it is new."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_location.rstrip('/')}/metadata")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return json.loads(spark.read.text(str(path.toString())).first()[0])["id"]


def refresh_stream(spark: SparkSession, feed_stream: DataFrame, state_path: str, checkpoint_location: str, feed: Feed, *,
                   buckets: int | None = None, fmt: str = "parquet", available_now: bool = True, interval: str = "1 minute",
                   lookback_minutes: int | None = None, tombstone_minutes: int | None = None):
    """ST1 / ST5: Structured Streaming ``readStream`` -> ``foreachBatch``
    upsert.  The stream checkpoint holds what was read (SNK5's offset
    ledger); ``availableNow`` drains what is there and stops (tests, cron
    runs), otherwise it runs continuously, one micro-batch per ``interval``.

    A new checkpoint is a new stream; it begins as the module says, and the
    condition is part of the streaming plan, so a source that can leaves the
    rows before it unread.  ``tombstone_minutes`` is how long a deleted key is
    remembered (longer than the feed can replay)."""
    commit = StateTable(spark, state_path, buckets, fmt).latest()
    known = checkpoint_stream(spark, checkpoint_location)
    if known and commit and known in commit.streams:
        start = commit.streams[known]["start"]
    else:
        start = stream_start(commit, lookback_minutes)
    identity, started = [], threading.Event()

    def upsert(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        # the batch is read more than once (touched buckets, positions, then the
        # changes): keep one copy instead of fetching it from the feed again
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
            purge = now - _dt.timedelta(minutes=tombstone_minutes) if tombstone_minutes else None
            refresh_state(batch.sparkSession, state_path, batch, feed, batch_id=batch_id, stream=identity[0], start=start,
                          buckets=buckets, fmt=fmt, purge_before=purge)
        finally:
            batch.unpersist()

    changes = feed_stream.where(from_start(feed, start)) if start else feed_stream
    w = changes.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint_location)
    query = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)).start()
    identity.append(str(query.id))
    started.set()
    return query


def as_feed(df: DataFrame, pk: str, ts: str, seq: str, op: Column,
            payload: Sequence[str], **place: Column) -> DataFrame:
    """Shape a change table into the feed contract; ``place``: the columns of
    the change's part and position, by name."""
    return df.select(F.col(pk), *[F.col(p) for p in payload], F.col(ts).alias("change_ts"),
                     F.col(seq).alias("seq"), op.alias("op"), *[c.alias(name) for name, c in place.items()])
