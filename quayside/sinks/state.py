"""A keyed state table on plain files that survives crashes and replays.

Rows lie in buckets (a hash of the key), whose number is that of the newest
commit: chosen when the state is first written, changed by ``redeal``.  A
commit writes the rows of the buckets it replaces to a version folder of its
own and then publishes one small text file that says, for every bucket, which
version holds it; for every stream that fed the state, the last batch applied
and where the stream began; and how far each part of the feed has been
applied.  The text file is written aside and renamed, so readers and a rerun
after a crash see the state before the commit or after it, never between;
files of a commit that didn't finish belong to no published version.  Reads
name the folders of the wanted buckets and pass the schema, so nothing is
inferred, and a file that can't be read fails the read.

Layout: ``data/<version>/bucket=<b>/`` and ``commits/<version>``.
"""

from __future__ import annotations

import datetime as _dt
import math
import uuid
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quayside.sinks.tables import write_table
from quayside.sinks.versions import Commits

BUCKETS = 256
#: Rows that a bucket of a new or re-dealt state gets, about.
BUCKET_ROWS = 2_000_000


def buckets_for(rows: int) -> int:
    """Buckets of a state of so many rows."""
    return max(1, math.ceil(rows / BUCKET_ROWS))


@dataclass(frozen=True)
class Commit:
    number: int
    buckets: int
    where: dict[int, str] = field(default_factory=dict)     # bucket -> version folder
    streams: dict[str, dict] = field(default_factory=dict)  # stream -> {"batch": last applied, "start": where it began}
    positions: dict[str, int] = field(default_factory=dict)  # part of the feed -> its first position not applied yet
    position: str | None = None          # a snapshot's feed position as free text
    snapshot_at: str | None = None       # when the last snapshot was taken (UTC)

    def batch(self, stream: str = "") -> int | None:
        """The last batch of a stream that was applied."""
        return self.streams.get(stream, {}).get("batch")

    @property
    def batch_id(self) -> int | None:
        return self.batch()


class StateTable:
    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, fmt: str = "parquet"):
        """``buckets`` is for a new state; one that exists has its own number."""
        self.spark, self.path, self.fmt = spark, path.rstrip("/"), fmt
        self.commits = Commits(spark, path)
        now = self.latest()
        self.buckets = now.buckets if now else buckets or BUCKETS

    def bucket(self, key: str) -> Column:
        """The bucket of a key; a null key has one too."""
        return F.pmod(F.xxhash64(F.col(key)), F.lit(self.buckets)).cast("int")

    def latest(self) -> Commit | None:
        """The newest published commit; None if there is none."""
        c = self.commits.newest()
        if c is None:
            return None
        if "batch_id" in c:                  # written before streams had names
            last = c.pop("batch_id")
            c["streams"] = {} if last is None else {"": {"batch": last, "start": None}}
        return Commit(**{**c, "where": {int(k): v for k, v in c["where"].items()}})

    def read(self, schema: StructType, commit: Commit | None = None, only: list[int] | None = None) -> DataFrame:
        """The state's rows (of some buckets) as of a commit, the newest by default."""
        commit = commit or self.latest()
        where = commit.where if commit else {}
        paths = [f"{self.path}/data/{v}/bucket={b}" for b, v in sorted(where.items()) if only is None or b in set(only)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.format(self.fmt).schema(schema).load(paths)

    def commit(self, rows: DataFrame, key: str, replaced: list[int] | None, batch_id: int | None = None,
               position: str | None = None, *, stream: str = "", start: Mapping | None = None,
               positions: Mapping[str, int] | None = None, snapshot_at: _dt.datetime | None = None,
               buckets: int | None = None) -> Commit:
        """Publish ``rows`` as the whole content of the ``replaced`` buckets
        (None: of all, dealt into ``buckets``), with the batch of ``stream``
        that they contain, where that stream began, and the feed ``positions``
        that they reach.  ``snapshot_at``: the rows are a new snapshot, and what
        was known of streams and positions before doesn't hold for them."""
        before = self.latest()
        if replaced is None:
            self.buckets = buckets or self.buckets
        version = f"{(before.number if before else 0) + 1:012d}-{uuid.uuid4().hex}"
        folder = f"{self.path}/data/{version}"
        write_table(rows.withColumn("bucket", self.bucket(key)), folder, fmt=self.fmt, partition_by=["bucket"], mode="errorifexists")
        held = {int(n.split("=")[1]) for n in self.commits.names(f"data/{version}") if n.startswith("bucket=")}
        where = {} if replaced is None or before is None else {b: v for b, v in before.where.items() if b not in set(replaced)}
        where |= dict.fromkeys(held, version)
        anew = before is None or snapshot_at is not None
        streams, reached = ({}, {}) if anew else (dict(before.streams), dict(before.positions))
        if batch_id is not None:
            began = streams.get(stream, {}).get("start", start)
            streams[stream] = {"batch": batch_id, "start": dict(began) if began else None}
        for part, at in (positions or {}).items():
            reached[part] = max(at, reached.get(part, at))
        now = Commit((before.number if before else 0) + 1, self.buckets, where, streams, reached,
                     position if position is not None else (before.position if before else None),
                     snapshot_at.isoformat() if snapshot_at else (before.snapshot_at if before else None))
        self._publish(now)
        return now

    def redeal(self, schema: StructType, key: str, buckets: int | None = None) -> Commit:
        """The same rows in more (or fewer) buckets, as one commit.  By default
        as many as a new state of its size gets."""
        now = self.latest()
        rows = self.read(schema, now)
        return self.commit(rows, key, None, buckets=buckets or buckets_for(rows.count()))

    def _publish(self, c: Commit) -> None:
        self.commits.publish(c.number, asdict(c))

    def vacuum(self, keep: int = 2) -> None:
        """Delete data that none of the ``keep`` newest commits refers to."""
        self.commits.keep_newest(keep, lambda c: c["where"].values())
