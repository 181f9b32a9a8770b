"""Sharding by fixed virtual slots.

Records are hashed into ``SLOTS`` virtual slots, whose number never changes.
Bytes and rows are summed per slot, and a slot-to-shard map says which shard
holds each slot.  The map is a small versioned table in the shared folder;
rebalancing or adding a shard writes a new version in which some slots have
another shard, so records move only with their slot.

The map keeps the law of ``bytes``: the slots are given out heaviest first,
each to the shard with the fewest bytes so far.

Only the table of slots (``SLOTS`` rows, whatever the input) meets the
driver.  A record's place in its shard is its place in its slot plus the row
counts of the shard's slots before it, so no task ever orders a whole shard.

Edge cases: a null text has size 1; rows with a null id are spread by the
hash of their text; equal rows get different places; an empty table gives an
empty result and a map of empty slots.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quayside.llm.common import scratch_path, staged

SLOTS = 4096
MAP_SCHEMA = "version int, vslot int, shard int, bytes long, n_rows long, before long"


def virtual_slot(id_col: Column, text_crc: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(id_col, text_crc), F.lit(slots)).cast("int")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """(id, size, text_crc32, vslot) of every record."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32")) \
        .withColumn("vslot", virtual_slot(F.col("doc_id"), F.col("text_crc32"), slots))


def slot_sizes(records: DataFrame) -> list[tuple[int, int, int]]:
    """(vslot, bytes, rows), one per slot in use."""
    got = records.groupBy("vslot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    return sorted((r.vslot, r.b, r.n) for r in got)


def assign(sizes: list[tuple[int, int, int]], shards: int, slots: int = SLOTS) -> dict[int, int]:
    """Slot -> shard; heaviest slot first, to the lightest shard."""
    bytes_of = {v: b for v, b, _ in sizes}
    heap = [(0, s) for s in range(shards)]
    out = {}
    for v in sorted(range(slots), key=lambda v: (-bytes_of.get(v, 0), v)):
        load, s = heapq.heappop(heap)
        out[v] = s
        # an empty slot counts as one byte, so that empty slots are spread too
        heapq.heappush(heap, (load + max(1, bytes_of.get(v, 0)), s))
    return out


def rebalance(current: dict[int, int], sizes: list[tuple[int, int, int]], shards: int) -> dict[int, int]:
    """The map edited for new sizes or more shards: the heaviest slots that
    fit move from the fullest shard to the emptiest, until no such move makes
    the two more equal.  Slots of shards beyond ``shards`` move first."""
    bytes_of = {v: max(1, b) for v, b, _ in sizes}
    new = dict(current)
    load = dict.fromkeys(range(shards), 0)
    homeless = []
    for v, s in current.items():
        if s in load:
            load[s] += bytes_of.get(v, 1)
        else:
            homeless.append(v)
    for v in sorted(homeless, key=lambda v: (-bytes_of.get(v, 1), v)):
        s = min(load, key=lambda s: (load[s], s))
        new[v] = s
        load[s] += bytes_of.get(v, 1)
    held: dict[int, list[int]] = {s: [] for s in load}
    for v, s in new.items():
        held[s].append(v)
    while True:
        full, low = max(load, key=lambda s: (load[s], -s)), min(load, key=lambda s: (load[s], s))
        gap = load[full] - load[low]
        fits = [v for v in held[full] if bytes_of.get(v, 1) < gap]
        if not fits:
            return new
        v = min(fits, key=lambda v: (abs(gap - 2 * bytes_of.get(v, 1)), v))
        held[full].remove(v)
        held[low].append(v)
        new[v] = low
        load[full] -= bytes_of.get(v, 1)
        load[low] += bytes_of.get(v, 1)


def store_map(spark: SparkSession, assigned: dict[int, int], sizes: list[tuple[int, int, int]], version: int,
              path: str) -> DataFrame:
    """Write one version of the map (a folder of its own; older versions stay)."""
    by = {v: (b, n) for v, b, n in sizes}
    seen: dict[int, int] = {}
    rows = []
    for v in sorted(assigned):
        b, n = by.get(v, (0, 0))
        s = assigned[v]
        rows.append((version, v, s, b, n, seen.get(s, 0)))
        seen[s] = seen.get(s, 0) + n
    at = f"{path}/version={version}"
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).drop("version").write.mode("errorifexists").parquet(at)
    return load_map(spark, path, version)


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return (spark.read.schema("vslot int, shard int, bytes long, n_rows long, before long")
            .parquet(f"{path}/version={version}").withColumn("version", F.lit(version)))


def place(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Records with ``shard`` and ``slot``, their place in the shard from 0."""
    order = W.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    at = F.row_number().over(order) - 1
    # the map has one row per virtual slot: SLOTS rows
    m = F.broadcast(slot_map.select("vslot", "shard", "before"))
    return records.withColumn("_at", at).join(m, "vslot").withColumn("slot", F.col("before") + F.col("_at")).drop("_at", "before")


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
          slots: int = SLOTS) -> DataFrame:
    """All records with their shard under a new map, stored as version 0."""
    import uuid
    spark = docs.sparkSession
    path = path or scratch_path(spark, "quayside", "slot_map", uuid.uuid4().hex)
    records = staged(sized(docs, id_col, text_col, slots), "sharding")
    sizes = slot_sizes(records)
    return place(records, store_map(spark, assign(sizes, shards, slots), sizes, 0, path))
