"""Exact top-k inner-product search in M-trees.

Vectors become integers, ``floor(64 * x)`` of each component.  Each block of
``BLOCK`` rows gets an M-tree over Euclidean space: with ``R`` the largest
norm of the block, a vector ``c`` gets one more coordinate, ``sqrt(R^2 -
|c|^2)``, and a query ``q`` a zero there, so ``d(q, c)^2 = |q|^2 + R^2 - 2 q.c``
and the nearest vectors are those of the highest inner product.

A tree's nodes are pages.  A node has a routing vector, a covering radius and
the distance to its parent's routing vector; a leaf page's entries have their
distances to the leaf's routing vector.  A search takes nodes best first, by
the least distance that the radius allows, and ends when no node can hold a
score that reaches the k-th best.  Before a distance or an inner product is
computed, the triangle inequality on the stored parent distances must leave
the child or entry a chance.  Scores are exact integers; bounds have a slack
above their rounding error, and a bound must lie strictly below the k-th
score to leave anything out, so ties go to the smaller id.

The trees are files in the shared folder (one per block).  Queries meet the
trees as blocks: a task searches some chunk of queries in one tree, and the
best of all trees are ranked per query.

Edge cases: rows whose vector is null, or holds a null, NaN or infinite
component, take no part; a shorter vector counts as filled up with zeros; a
query's own row is left out, other rows with its id are not; equal scores
are ordered by id (null last); fewer candidates give fewer rows; scores are
longs, saturated beyond their range; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import io
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quayside.llm.common import scratch_path, staged

SCALE = 64
BLOCK = 16_384
PAGE = 512
FANOUT = 16
QUERIES = 128
#: Up to here sums of products are exact in doubles.
EXACT = float(1 << 52)


def _store(folder: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(folder if folder.startswith("file:") or "://" in folder else f"file://{folder}")


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(uid, vec_id, v): rows that take part, with integer components as doubles."""
    v = F.col(vector_col)
    # NaN and the infinities are no number below the largest double
    good = F.forall(v, lambda x: x.isNotNull() & (F.abs(x.cast("double")) <= F.lit(1.7976931348623157e308)) & ~F.isnan(x.cast("double")))
    whole = F.transform(v, lambda x: F.expr("0D") + F.floor(x.cast("double") * SCALE).cast("double"))
    rows = vectors.filter(v.isNotNull()).filter(good).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"))
    return rows.withColumn("uid", F.monotonically_increasing_id())


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column, filled up with zeros."""
    lens = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    wide = int(lens.max()) if len(lens) else 0
    out = np.zeros((len(lens), wide))
    out[np.arange(wide)[None, :] < lens[:, None]] = flat
    return out


def build(points: np.ndarray, uid: np.ndarray, vec_id: np.ndarray, null: np.ndarray) -> dict[str, np.ndarray]:
    """The pages of one tree, bulk-loaded top down: routing vectors are rows
    that lie apart from each other, and each row goes to the nearest."""
    n = len(points)
    most = float(np.abs(points).max()) if points.size else 0.0
    if points.shape[1] * most * most >= EXACT:   # too large for exact sums of doubles: no tree, see ``Tree.brute``
        none = np.zeros(0)
        return {"points": points, "entry_d": none, "uid": uid, "vec_id": vec_id, "null": null, "r2": np.zeros(1), "most": np.array([most]),
                "router": np.zeros((0, 0)), "radius": none, "parent_d": none, "parent": none.astype(np.int64),
                "lo": none.astype(np.int64), "hi": none.astype(np.int64), "leaf": none.astype(bool)}
    norm2 = (points ** 2).sum(axis=1)
    r2 = float(norm2.max()) if n else 0.0
    space = np.hstack([points, np.sqrt(np.maximum(r2 - norm2, 0))[:, None]])
    rng = np.random.default_rng(n)
    order, router, radius, parent_d, parent, lo, hi, leaf = [], [], [], [], [], [], [], []
    entry_d = np.zeros(n)
    todo = [(np.arange(n), -1)] if n else []
    at = 0
    while todo:
        rows, up = todo.pop()
        mean = space[rows].mean(axis=0)
        r = rows[np.argmin(((space[rows] - mean) ** 2).sum(axis=1))]
        d = np.sqrt(((space[rows] - space[r]) ** 2).sum(axis=1))
        me = len(router)
        router.append(r)
        radius.append(d.max())
        parent.append(up)
        parent_d.append(0.0 if up < 0 else np.sqrt(((space[r] - space[router[up]]) ** 2).sum()))
        if len(rows) > PAGE:
            k = min(FANOUT, -(-len(rows) // (PAGE // 2)))
            seeds = [int(np.argmax(d))]
            near = np.sqrt(((space[rows] - space[rows[seeds[0]]]) ** 2).sum(axis=1))
            side = np.zeros(len(rows), np.int64)
            some = rng.permutation(len(rows))[:4 * k]     # farthest-first among a few
            while len(seeds) < k:
                s = int(some[np.argmax(near[some])])
                if near[s] == 0:
                    break
                e = np.sqrt(((space[rows] - space[rows[s]]) ** 2).sum(axis=1))
                side[e < near] = len(seeds)
                near = np.minimum(near, e)
                seeds.append(s)
            parts = [rows[side == s] for s in range(len(seeds))]
            parts = [p for p in parts if len(p)]
            if len(parts) < 2:                             # rows in one place: cut evenly
                parts = np.array_split(rows, -(-len(rows) // PAGE))
            lo.append(0), hi.append(0), leaf.append(False)
            todo += [(p, me) for p in parts]
        else:
            order.append(rows)
            lo.append(at), hi.append(at + len(rows)), leaf.append(True)
            entry_d[at:at + len(rows)] = d
            at += len(rows)
    perm = np.concatenate(order) if order else np.zeros(0, np.int64)
    return {"points": points[perm], "entry_d": entry_d, "uid": uid[perm], "vec_id": vec_id[perm], "null": null[perm],
            "r2": np.array([r2]), "most": np.array([most]), "router": space[router] if router else np.zeros((0, space.shape[1])),
            "radius": np.array(radius), "parent_d": np.array(parent_d), "parent": np.array(parent, np.int64),
            "lo": np.array(lo, np.int64), "hi": np.array(hi, np.int64), "leaf": np.array(leaf, bool)}


class Tree:
    def __init__(self, pages: dict[str, np.ndarray]):
        self.__dict__.update({k: pages[k] for k in pages})
        self.r2, self.most = float(self.r2[0]), float(self.most[0])
        kids: list[list[int]] = [[] for _ in self.radius]
        for k, up in enumerate(self.parent.tolist()):
            if up >= 0:
                kids[up].append(k)
        self.kids = [np.array(k, np.int64) for k in kids]
        self.computed = 0     # distances and products, for tests

    def search(self, q: np.ndarray, uid: int, k: int) -> list[tuple[float, int, int, int]]:
        """(score, null, id, row) of the best ``k``, any order."""
        dim = self.points.shape[1]
        if dim * self.most * float(np.abs(q).max(initial=0)) >= EXACT or dim * float(np.abs(q).max(initial=0)) ** 2 >= EXACT:
            return self.brute(q, uid, k)
        if not len(self.radius):
            return self.brute(q, uid, k) if len(self.points) else []
        q = q[:dim] if len(q) > dim else np.pad(q, (0, dim - len(q)))   # what is beyond the block's width meets zeros
        q2 = float(q @ q)
        far = q2 + self.r2
        slack = 1e-7 * (far + 1)
        best: list[tuple[float, int, int, int]] = []     # a heap, the worst first
        floor = -np.inf

        def chance(least: np.ndarray | float):
            """The highest score at that distance or more."""
            return (far - np.maximum(least, 0) ** 2) / 2 + slack

        space = np.append(q, 0.0)
        d0 = float(np.sqrt(((self.router[0] - space) ** 2).sum()))
        heap = [(max(0.0, d0 - self.radius[0]), 0, d0)]
        self.computed += 1
        while heap:
            least, node, d = heapq.heappop(heap)
            if chance(least) < floor:
                break
            if self.leaf[node]:
                rows = np.arange(self.lo[node], self.hi[node])
                if len(best) == k:
                    rows = rows[chance(np.abs(d - self.entry_d[rows])) >= floor]
                if not len(rows):
                    continue
                whole = slice(self.lo[node], self.hi[node])
                if 4 * len(rows) > 3 * (whole.stop - whole.start):     # nearly the whole page: no copy of its rows
                    rows = np.arange(whole.start, whole.stop)
                    scores = self.points[whole] @ q
                else:
                    scores = self.points[rows] @ q
                self.computed += len(rows)
                for i in np.flatnonzero(scores >= floor).tolist():
                    r = int(rows[i])
                    if self.uid[r] == uid:
                        continue
                    item = (float(scores[i]), -int(self.null[r]), -int(self.vec_id[r]), r)
                    if len(best) < k:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)
                if len(best) == k:
                    floor = best[0][0]
                continue
            kids = self.kids[node]
            if len(best) == k:
                kids = kids[chance(np.abs(d - self.parent_d[kids]) - self.radius[kids]) >= floor]
            if len(kids):
                dk = np.sqrt(((self.router[kids] - space) ** 2).sum(axis=1))
                self.computed += len(kids)
                for c, x in zip(kids.tolist(), dk.tolist()):
                    heapq.heappush(heap, (max(0.0, x - self.radius[c]), c, x))
        return best

    def brute(self, q: np.ndarray, uid: int, k: int) -> list[tuple[int, int, int, int]]:
        """For components so large that doubles don't hold their products: Python's integers, all rows."""
        dim = min(len(q), self.points.shape[1])
        own = [int(x) for x in q[:dim]]
        items = ((_long(sum(int(a) * b for a, b in zip(p[:dim], own))), -int(z), -int(v), r)
                 for r, (p, z, v, u) in enumerate(zip(self.points, self.null, self.vec_id, self.uid)) if u != uid)
        return heapq.nlargest(k, items)


def _long(x: float | int) -> int:
    return max(-(1 << 63), min((1 << 63) - 1, int(x)))


def top_k(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
          block: int = BLOCK, folder: str | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best of all other rows for
    each row where ``is_query`` (a condition on ``vec_id``) holds."""
    spark = vectors.sparkSession
    folder = folder or scratch_path(spark, "quayside", "mtree", uuid.uuid4().hex)
    rows = staged(usable(vectors, id_col, vector_col), "vectors")
    n = rows.count()

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        task = TaskContext.get()

        def plant(part: pa.Table, k: int) -> pa.RecordBatch:
            part = part.combine_chunks()
            ids = part["vec_id"].chunk(0)
            null = ids.is_null().to_numpy(zero_copy_only=False)
            pages = build(matrix(part["v"].chunk(0)), part["uid"].chunk(0).to_numpy(), ids.fill_null(0).to_numpy(),
                          null.astype(np.int64))
            name = f"{task.partitionId():06d}-{k:04d}-{task.taskAttemptId()}.npz"
            data = io.BytesIO()
            np.savez(data, **pages)
            with store.open_output_stream(f"{root}/{name}") as out:
                out.write(data.getvalue())
            return pa.RecordBatch.from_pydict({"file": [name], "n": [part.num_rows]})

        held, done = [], 0
        for b in batches:       # rows are dealt evenly; a task far above ``block`` rows still plants bounded trees
            held.append(b)
            if sum(x.num_rows for x in held) >= 2 * block:
                yield plant(pa.Table.from_batches(held), done)
                held, done = [], done + 1
        if sum(x.num_rows for x in held):
            yield plant(pa.Table.from_batches(held), done)

    trees = rows.repartition(max(1, -(-n // block))).mapInArrow(grow, "file string, n long")
    trees = staged(trees, "trees").select("file")
    queries = staged(rows.filter(is_query).withColumn("at", F.monotonically_increasing_id()), "queries")
    inside = F.floor(F.col("at").bitwiseAND((1 << 33) - 1) / QUERIES)
    queries = queries.select("uid", F.col("vec_id").alias("query_id"), "v", F.shiftright("at", 33).alias("part"), inside.alias("chunk"))
    # every chunk of queries meets every tree: one row per query and tree, of the query's size
    files = trees.agg(F.sort_array(F.collect_list("file")).alias("files"))
    units = queries.join(F.broadcast(files)).withColumn("file", F.explode("files")).drop("files")

    def search(unit: pa.Table) -> pa.Table:
        store, root = _store(folder)
        with store.open_input_stream(f"{root}/{unit['file'][0].as_py()}") as f:
            tree = Tree(dict(np.load(io.BytesIO(f.read()))))
        unit = unit.combine_chunks()
        out: list[tuple] = []
        for q, uid, name in zip(matrix(unit["v"].chunk(0)), unit["uid"].to_pylist(), unit["query_id"].to_pylist()):
            out += [(uid, name, None if z else -v, int(tree.uid[r]), _long(s)) for s, z, v, r in tree.search(q, uid, k)]
        cols = list(zip(*out)) or [()] * 5
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["quid", "query_id", "vec_id", "uid", "score"])

    # searching is long work on few bytes: as many tasks as there are full units, whatever the bytes
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-queries.count() * trees.count() // QUERIES))
    units = units.repartition(tasks, "file", "part", "chunk")
    found = units.groupBy("file", "part", "chunk").applyInArrow(search, "quid long, query_id long, vec_id long, uid long, score long")
    order = W.partitionBy("quid").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "uid")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
