"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line without white space (``[\\x20\\x09-\\x0D]``) at both
ends and with A-Z in lower case; keys go by their 128-bit BLAKE2 hash.  A key
of at least ``min_chars`` code points that ``min_docs`` documents hold loses
all its lines in every document.

Runs.  ``LineRuns`` keeps (key hash, documents) as sorted runs in levels, each
run a Parquet table dealt into hash buckets and sorted in them.  A new batch
of documents is counted by key, merge-anti-joined with the runs (a key that a
run already has ``min_docs`` times is settled and isn't added again), and what
is left becomes a run of level 0.  ``fanout`` runs of a level are merged into
one of the next.  All runs share their buckets, so a merge join or a merge of
runs moves no row; only the new batch is shuffled.  A manifest, written after
each batch, names the live runs: a job that is cut off leaves the ones before
it, and ``LineRuns.open`` goes on from there.

``remove_lines`` deals the documents' partitions into ``BATCHES`` batches,
adds them one after another, merges all runs, joins the settled keys with the
documents' line keys and these with the documents, by the SHA-256 of the text.
Both joins have plain exchanges on both sides, so Spark splits a hot line or a
text that a third of all documents hold.

Edge cases: a null or empty text is one empty line; an empty key (blank line)
is dropped only if ``min_chars`` is 0; a document is a row, so rows that
repeat an id or a text count one by one; a text whose lines all go becomes
empty; an empty table gives an empty result; columns of the input that are
named like result columns (``text``, ``n_lines``, ``n_dropped``) are replaced
unless they are carried, which is an error.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import scratch_path, staged

BATCHES = 6
FANOUT = 3
SPACE = b" \t\n\x0b\x0c\r"
RESULT = ["text", "n_lines", "n_dropped"]


def line_key(line: bytes) -> bytes:
    """The key of a line of UTF-8 bytes (``lower`` on bytes changes A-Z only)."""
    return line.strip(SPACE).lower()


def _hash(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)


class LineRuns:
    """Runs of (``key`` binary, ``n`` long) in levels under ``path``."""

    def __init__(self, spark: SparkSession, path: str, min_docs: int, buckets: int | None = None, fanout: int = FANOUT):
        self.spark, self.path, self.min_docs, self.fanout = spark, path.rstrip("/"), min_docs, fanout
        # as many as an exchange has partitions: the counted batch then meets the runs without another one
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.batches = 0

    @staticmethod
    def open(spark: SparkSession, path: str) -> LineRuns:
        """The runs as the newest manifest under ``path`` has them."""
        found = spark.read.text(f"{path.rstrip('/')}/manifest/*").select("value").collect()   # one short row per batch
        state = max((json.loads(r.value) for r in found), key=lambda s: s["batches"])
        runs = LineRuns(spark, path, state["min_docs"], state["buckets"], state["fanout"])
        runs.levels, runs.batches = state["levels"], state["batches"]
        return runs

    def _publish(self) -> None:
        state = {"batches": self.batches, "min_docs": self.min_docs, "buckets": self.buckets, "fanout": self.fanout, "levels": self.levels}
        row = self.spark.createDataFrame([(json.dumps(state),)], "value string")
        row.coalesce(1).write.mode("overwrite").text(f"{self.path}/manifest/{self.batches:08d}")

    def _table(self, run: str) -> DataFrame:
        """A run with its buckets and order; Spark learns of a run that another session wrote by its folder."""
        name = f"line_run_{run}"
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(f"CREATE TABLE {name} (key BINARY, n BIGINT) USING parquet CLUSTERED BY (key) SORTED BY (key) "
                           f"INTO {self.buckets} BUCKETS LOCATION '{self.path}/runs/{run}'")
        return self.spark.table(name)

    def _write(self, rows: DataFrame) -> str:
        run = uuid.uuid4().hex
        (rows.write.format("parquet").bucketBy(self.buckets, "key").sortBy("key")
         .option("path", f"{self.path}/runs/{run}").saveAsTable(f"line_run_{run}"))
        return run

    def _merged(self, runs: Sequence[str]) -> DataFrame:
        """The runs as one.  They share buckets, so a full merge join of two moves no row."""
        def both(a: DataFrame, b: DataFrame) -> DataFrame:
            b = b.select(F.col("key").alias("_key"), F.col("n").alias("_n"))
            joined = a.join(b.hint("merge"), F.col("key") == F.col("_key"), "full_outer")
            return joined.select(F.coalesce("key", "_key").alias("key"), (F.coalesce("n", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("n"))
        tables = [self._table(r) for r in runs]
        while len(tables) > 1:           # pairs, so that no side of a merge is itself a long chain
            tables = [both(*tables[i:i + 2]) if i + 1 < len(tables) else tables[i] for i in range(0, len(tables), 2)]
        return tables[0]

    def add(self, keys: DataFrame) -> None:
        """A batch: one row (``key``) for each key of each document."""
        fresh = keys.groupBy("key").agg(F.count("*").alias("n"))
        for run in [r for level in reversed(self.levels) for r in level]:
            settled = self._table(run).where(F.col("n") >= self.min_docs).select(F.col("key").alias("_key"))
            # always true, but it keeps the join above the count: a hot key is counted in each task before the exchange
            counted = F.col("n") > 0
            fresh = fresh.join(settled.hint("merge"), (F.col("key") == F.col("_key")) & counted, "left_anti")
        self._put(0, self._write(fresh))
        self.batches += 1
        self._publish()

    def _put(self, level: int, run: str) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._put(level + 1, self._write(self._merged(full)))

    def settled(self) -> DataFrame:
        """(``key``) of all keys that reach ``min_docs``; merges all runs into one first."""
        runs = [r for level in self.levels for r in level]
        if not runs:
            return self.spark.createDataFrame([], "key binary")
        if len(runs) > 1:
            runs = [self._write(self._merged(runs))]
            self.levels = [[] for _ in self.levels] + [runs]
            self._publish()
        # read as plain files: the join that follows deals it out anew and can be split
        return self.spark.read.schema("key binary, n long").parquet(f"{self.path}/runs/{runs[0]}").where(F.col("n") >= self.min_docs).select("key")


def text_hash(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _document_keys(docs: DataFrame, min_chars: int, batches: int) -> DataFrame:
    """(``batch``, ``text_hash``, ``key``), a row for each key of each document."""
    def split(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = TaskContext.get().partitionId() % batches
        for b in rows:
            texts, keys = [], []
            for h, data in zip(b.column(0).to_pylist(), b.column(1).cast(pa.large_binary()).to_pylist()):
                own = {line_key(x) for x in data.split(b"\n")}
                own = [_hash(k) for k in own if _long_enough(k, min_chars)]
                keys += own
                texts += [h] * len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch] * len(keys), pa.int32()), pa.array(texts, pa.binary()), pa.array(keys, pa.binary())],
                names=["batch", "text_hash", "key"])

    return docs.select("_hash", "_text").mapInArrow(split, "batch int, text_hash binary, key binary")


def remove_lines(docs: DataFrame, carry: Sequence[str] = ("doc_id",), text_col: str = "text", min_chars: int = 1,
                 min_docs: int = 10, batches: int = BATCHES) -> DataFrame:
    """The ``carry`` columns of every row of ``docs``, its remaining ``text``,
    ``n_lines`` (before dropping) and ``n_dropped``."""
    clash = {c.lower() for c in carry} & set(RESULT)
    if clash:
        raise ValueError(f"carried columns are named like result columns: {sorted(clash)}")
    spark = docs.sparkSession
    docs = docs.select(*[F.col(f"`{c}`") for c in carry], F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    docs = docs.withColumn("_hash", text_hash(F.col("_text")))

    folder = scratch_path(spark, "quayside", "line_dedup", uuid.uuid4().hex)
    _document_keys(docs, min_chars, batches).write.partitionBy("batch").parquet(f"{folder}/keys")
    keys = spark.read.schema("text_hash binary, key binary, batch int").parquet(f"{folder}/keys")
    runs = LineRuns(spark, f"{folder}/runs", min_docs)
    for b in range(batches):
        runs.add(keys.where(F.col("batch") == b).select("key"))

    gone = keys.join(runs.settled().hint("merge"), "key").select("text_hash", "key")
    gone = staged(gone.groupBy("text_hash").agg(F.collect_set("key").alias("_gone")), "lines_gone")

    def drop(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            n = b.num_columns - 2
            kept, n_lines, n_dropped = [], [], []
            for data, out in zip(b.column(n).cast(pa.large_binary()).to_pylist(), b.column(n + 1).to_pylist()):
                n_lines.append(data.count(b"\n") + 1)
                if out:
                    out = set(out)
                    lines = [x for x in data.split(b"\n") if _hash(line_key(x)) not in out]
                    n_dropped.append(n_lines[-1] - len(lines))
                    kept.append(b"\n".join(lines))
                else:
                    n_dropped.append(0)
                    kept.append(data)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:n], pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                names=[*carry, *RESULT])

    joined = docs.join(gone.withColumnRenamed("text_hash", "_hash").hint("merge"), "_hash", "left")
    joined = joined.select(*[F.col(f"`{c}`") for c in carry], "_text", "_gone")
    schema = joined.drop("_text", "_gone").withColumns({"text": F.lit(""), "n_lines": F.lit(0).cast("long"), "n_dropped": F.lit(0).cast("long")}).schema
    return joined.mapInArrow(drop, schema)
