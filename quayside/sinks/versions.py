"""Numbered commits of a table on plain files: a small text file each, written
aside and renamed, so that a reader sees the commit before or the one after.

One writer at a time: on HDFS and local disks the rename lets only one of two
writers publish a number; an object store without atomic renames doesn't.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Commits:
    """The commits under ``{path}/commits``, as JSON objects by their number."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self._path(f"{self.path}/{name}")

    def names(self, folder: str) -> list[str]:
        """The entries of a folder; none if it isn't there."""
        if not self.fs.exists(self.at(folder)):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.at(folder)))

    def numbers(self) -> list[str]:
        return [n for n in self.names("commits") if n.isdigit()]

    def read(self, number: str) -> dict:
        stream = self.fs.open(self.at(f"commits/{number}"))
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def newest(self) -> dict | None:
        """The newest published commit."""
        numbers = self.numbers()
        return self.read(numbers[-1]) if numbers else None

    def publish(self, number: int, content: dict) -> None:
        aside, target = self.at(f"commits/.{uuid.uuid4().hex}"), self.at(f"commits/{number:012d}")
        self.fs.mkdirs(self.at("commits"))
        out = self.fs.create(aside, False)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        if self.fs.exists(target) or not self.fs.rename(aside, target):
            self.fs.delete(aside, False)
            raise RuntimeError(f"another writer published commit {number} of {self.path}")

    def keep_newest(self, keep: int, used) -> None:
        """Forget all but the ``keep`` newest commits, and delete the folders
        under ``data`` that ``used(commit)`` of none of those has."""
        numbers = self.numbers()
        live = {v for n in numbers[-keep:] for v in used(self.read(n))}
        for n in numbers[:-keep]:
            self.fs.delete(self.at(f"commits/{n}"), False)
        for name in self.names("data"):
            if name not in live:
                self.fs.delete(self.at(f"data/{name}"), True)
