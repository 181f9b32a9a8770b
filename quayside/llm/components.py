"""Connected components by alternating large-star and small-star rounds.

Edges live in tables; nothing but two numbers of each write, which the write
itself observes, meets the driver.  Each round is written to the shared folder, so lineage stays short and a lost
executor costs at most a round.  A hot centre is met by a partial aggregate
(its smallest neighbour) and a join whose hot side Spark can split.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quayside.llm.common import staged

#: Edges that a writing task gets at least.
TASK_EDGES = 100_000


def _written(edges: DataFrame, name: str, most: int | None = None) -> tuple[DataFrame, int, int]:
    """The edges, written, with their number and a digest that the write itself
    observes.  ``most``: a bound of the number, for the tasks to write with."""
    seen = Observation()
    edges = edges.observe(seen, F.count("*").alias("n"), F.sum(F.shiftright(F.xxhash64("a", "b"), 20)).alias("h"))
    if most is not None:
        edges = edges.coalesce(max(1, math.ceil(most / TASK_EDGES)))
    out = staged(edges, name)
    return out, seen.get["n"], seen.get["h"] or 0


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # written, so that the join has plain exchanges on both sides and a hot centre's is split
    least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    out = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # every edge of a large star points down: b < a
    least = staged(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of the edges (a, b); a component is
    named by its smallest node.  No edges: an empty table."""
    now, *seen = _written(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    most = 2 * seen[0]
    while seen[0]:
        large, n, _ = _written(_large_star(now), "large_star", most)
        now, *got = _written(_small_star(large), "small_star", 2 * n)
        if got == seen:
            break
        seen, most = got, 2 * got[0]
    roots = now.select(F.col("b").alias("node")).distinct()
    return (now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(roots.select("node", F.col("node").alias("component"))))
