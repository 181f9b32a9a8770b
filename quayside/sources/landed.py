"""A landed table that readers never see half loaded (SRC8-SRC10, SNK5).

``load`` compares the source's buckets with the ledger of the load before,
reads the changed ones (``sources.buckets``: a pruned scan) into a version
folder of their own, writes the new ledger beside, and then publishes one
commit that says for each bucket which version holds it, and which ledger
belongs to them.  A load that is cut off anywhere before that leaves the table
as it was and is simply run again; buckets that the source emptied leave with
the commit.  Text buckets stay text: a row carries its own bucket.

Layout: ``data/<version>/part=<label>/``, ``ledger/<version>/``, ``commits/<number>``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quayside.session import checkpointed
from quayside.sinks.tables import write_table
from quayside.sinks.versions import Commits
from quayside.sources.buckets import Bucket, changed_rows
from quayside.sources.landing import bucket_stats, changed_buckets


def _label(bucket: Column) -> Column:
    """A bucket's folder; no value has that of NULL."""
    return F.coalesce(F.concat(F.lit("b-"), bucket.cast("string")), F.lit("null"))


class LandedTable:
    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet"):
        self.spark, self.path, self.fmt = spark, path.rstrip("/"), fmt
        self.commits = Commits(spark, path)

    def read(self, number: int | None = None) -> DataFrame:
        """The table as last published, or as of a commit."""
        now = self.commits.newest() if number is None else self.commits.read(f"{number:012d}")
        if now is None:
            raise ValueError(f"nothing was loaded into {self.path}")
        schema = StructType.fromJson(now["schema"])
        paths = [f"{self.path}/data/{v}/{name}" for name, v in sorted(now["where"].items())]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.format(self.fmt).schema(schema).load(paths)

    def ledger(self) -> DataFrame | None:
        now = self.commits.newest()
        return self.spark.read.parquet(f"{self.path}/ledger/{now['ledger']}") if now else None

    def load(self, source: DataFrame, bucket: Bucket, update_col: str, pk: str) -> DataFrame:
        """Bring the table to the state of ``source``; the comparison of the
        buckets, one row each."""
        now = self.commits.newest()
        stats = checkpointed(bucket_stats(source, bucket.column(), update_col, pk))
        before = self.ledger() if now else self.spark.createDataFrame([], stats.schema)
        diff = checkpointed(changed_buckets(stats, before))
        rows = changed_rows(source, bucket, diff.where("changed AND src_row_count IS NOT NULL"))
        number = (now["number"] if now else 0) + 1
        version = f"{number:012d}-{uuid.uuid4().hex}"
        write_table(rows.withColumn("part", _label(F.col("bucket"))), f"{self.path}/data/{version}", fmt=self.fmt,
                    partition_by=["part"], mode="errorifexists")
        write_table(stats, f"{self.path}/ledger/{version}", num_files=1, mode="errorifexists")
        held = [n for n in self.commits.names(f"data/{version}") if n.startswith("part=")]
        escape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        left = {f"part={escape(r.label)}" for r in diff.where("changed").select(_label(F.col("bucket")).alias("label")).toLocalIterator()}
        where = {n: v for n, v in (now["where"] if now else {}).items() if n not in left} | dict.fromkeys(held, version)
        self._publish(number, {"number": number, "where": where, "ledger": version, "schema": rows.schema.jsonValue()})
        return diff

    def _publish(self, number: int, content: dict) -> None:
        self.commits.publish(number, content)

    def vacuum(self, keep: int = 2) -> None:
        """Delete what none of the ``keep`` newest commits refers to."""
        ledgers = {self.commits.read(n).get("ledger") for n in self.commits.numbers()[-keep:]}
        self.commits.keep_newest(keep, lambda c: c["where"].values())
        for name in self.commits.names("ledger"):
            if name not in ledgers:
                self.commits.fs.delete(self.commits.at(f"ledger/{name}"), True)
