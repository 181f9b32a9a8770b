"""MinHash near-dedup by a signature-coordinate inverted join.

A text's set holds its distinct shingles of five words (runs of
``[^\\x20\\x09-\\x0D]``, A-Z lower-cased); a shorter text's whole word sequence
is its one shingle.  Texts with 100 * intersection >= 75 * union are linked.

1. Texts with the same set form a class; all that follows is on classes.
2. A class has ``COORDS`` MinHash coordinates.  Each (coordinate, value) pair
   is a posting key.  Of two sets with similarity 0.75 or more at least
   ``MATCHES`` coordinates agree, but for a chance below 1e-6 (binomial tail,
   see ``miss_chance``).
3. Prefix and skip: keys are ordered by how many classes post them.  Two
   classes that agree in ``MATCHES`` keys share one among the
   ``COORDS - MATCHES + 1`` rarest of each, so only those are kept; keys that
   one class alone has are never posted, and the long lists (of a passage
   that a third of the corpus quotes) are skipped by every class that has
   enough rare keys.
4. Each member of a list is paired with the list's most typical class (whose
   coordinates are posted most often).  The pair's collisions are counted over
   all coordinates, those of the skipped lists included (``colliding``), and
   pairs with ``MATCHES`` or more are retained and confirmed on the full sets.
   The confirmed links are joined to components.
5. Classes that share a list with another component are looked at again,
   with their shingles as keys: of two sets with similarity 0.75 or more each
   has a shingle of the other among its rarest quarter (and one), so a passage
   must be most of a text to bring its quoters together.  Classes that are
   connected by such lists form a group.  In each group the classes outside
   its largest component are compared with all others, block by block, as
   products of 0-1 matrices; only links come out, at most one for a class and
   another component.  Pairs inside a component could not change it, so no
   list is ever expanded into its pairs, and no list is capped.

Edge cases: null, empty or wordless texts have an empty set and are linked
with nothing; null ids take part, and a component's id is the smallest
non-null one; rows that repeat an id keep one row each in the result of
``decide``, whose ``kept`` goes by id, while ``drop_near`` goes by row; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import release_worker_state, small_batches, staged, trim_worker
from quayside.llm.components import components
from quayside.llm.exact_dedup import mark_suspects

WORDS = 5
COORDS = 48
MATCHES = 20
PERCENT = 75
SEED = 20240229
MEMO_WORDS = 500_000
FILTER_BITS = 1 << 26
#: Classes whose keys a task counts.
TASK_CLASSES = 4096
#: A block of sets that is compared with another: so many sets, or so many items if they are long.
BLOCK_SETS, BLOCK_ITEMS = 512, 1_000_000


def miss_chance(similarity: float = PERCENT / 100, coords: int = COORDS, matches: int = MATCHES) -> float:
    """Chance that two sets of this similarity agree in fewer coordinates."""
    return sum(comb(coords, k) * similarity ** k * (1 - similarity) ** (coords - k) for k in range(matches))


class _Words(dict):
    """Word -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = h
        return h


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def shingles(text: str | None, words: dict | None = None) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()   # bytes: A-Z and ASCII white space only
    if not tokens:
        return np.zeros(0, np.uint64)
    words = _Words() if words is None else words
    w = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens))
    n = max(1, len(w) - WORDS + 1)
    h = np.full(n, min(len(w), WORDS), np.uint64)
    for k in range(min(WORDS, len(w))):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[k:k + n]
        h ^= h >> np.uint64(32)
    return np.unique(_mixed(h))


def _coordinates(coords: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return (rng.integers(0, 1 << 63, coords, np.uint64) * np.uint64(2) + rng.integers(0, 2, coords, np.uint64),
            rng.integers(0, 1 << 63, coords, np.uint64) * np.uint64(2) + np.uint64(1))


def signatures(flat: np.ndarray, starts: np.ndarray, coords: int = COORDS) -> np.ndarray:
    """(sets, coords) MinHash values of non-empty sets laid end to end."""
    out = np.empty((len(starts), coords), np.uint64)
    for k, (flip, times) in enumerate(zip(*_coordinates(coords))):
        h = (flat ^ flip) * times
        h ^= h >> np.uint64(32)
        h *= times
        out[:, k] = np.minimum.reduceat(h, starts)
    return out


_SIGNED = "doc_id long, row long, n_shingles long, node binary, text_key long, sig array<long>"


def signed(docs: DataFrame, coords: int = COORDS) -> DataFrame:
    """One row per document: the set's size, its digest and its signature.
    ``docs``: (doc_id, text, row)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker_state()
        words = _Words()
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                sets = [shingles(t, words) for t in part.column(2).to_pylist()]
                full = [s for s in sets if len(s)]
                lens = np.array([len(s) for s in full], np.int64)
                sig = signatures(np.concatenate(full), np.cumsum(lens) - lens, coords) if full else np.zeros((0, coords), np.uint64)
                nodes = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                ends = np.cumsum([0] + [coords if len(s) else 0 for s in sets])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.binary()), part.column(3),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(sig.view(np.int64).ravel()))],
                    names=["doc_id", "row", "n_shingles", "node", "text_key", "sig"])
        words.clear()
        trim_worker()

    return docs.select("doc_id", "row", "text", F.xxhash64("text").alias("text_key")).mapInArrow(run, _SIGNED)


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, n, items) of the classes in ``wanted`` (text_key): the texts are
    read again, and a fixed-size filter lets only those through that may be
    wanted; the others aren't moved."""
    words = (wanted.select(F.explode(F.array(*_cells(F.col("text_key")))).alias("cell")).distinct()
             .groupBy(F.shiftright("cell", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(cell % 64 as int))")).alias("mask")))
    rows = docs.select("text", F.xxhash64("text").alias("text_key"))
    rows = mark_suspects(rows, "text_key", staged(words, "wanted_words"), FILTER_BITS).filter("_suspect")
    rows = rows.join(wanted, "text_key", "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker_state()
        words = _Words()
        for b in batches:
            for i in range(0, b.num_rows, 256):
                sets = [shingles(t, words) for t in b.column(0).slice(i, 256).to_pylist()]
                sets = [s for s in sets if len(s)]
                ends = np.cumsum([0] + [len(s) for s in sets])
                flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], names=["node", "n", "items"])
        words.clear()
        trim_worker()

    return rows.mapInArrow(run, "node binary, n long, items array<long>")


def _cells(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(FILTER_BITS)) for seed in (1, 2)]


def _fits(n: str, m: str) -> Column:
    """Sets of these sizes can be similar enough."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links, on their full sets."""
    one = sets.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("items").alias("items_a"))
    two = sets.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("items").alias("items_b"))
    both = F.size(F.array_intersect("items_a", "items_b"))
    joined = pairs.select("a", "b").join(one, "a").join(two, "b").withColumn("both", both)
    return joined.filter(F.col("both") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("both")) * PERCENT).select("a", "b")


def colliding(pairs: DataFrame, classes: DataFrame, matches: int) -> DataFrame:
    """The pairs (a, b) whose signatures agree in ``matches`` coordinates at
    least: the collisions in the lists of their prefixes and in the lists that
    were skipped, counted together."""
    one = classes.select(F.col("id").alias("a"), F.col("sig").alias("sig_a"))
    two = classes.select(F.col("id").alias("b"), F.col("sig").alias("sig_b"))
    same = F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int"))
    joined = pairs.select("a", "b").join(one, "a").join(two, "b")
    return joined.filter(F.aggregate(same, F.lit(0), lambda n, x: n + x) >= matches).select("a", "b")


def _rarest(posted: DataFrame, size: Column) -> DataFrame:
    """Of each class's keys the ``size`` rarest, where that many aren't its
    alone.  ``posted``: (id, n, whole, key), ``whole`` the number of keys."""
    shared = posted.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1")
    own = (posted.join(shared, "key").groupBy("id", "n", "whole")
           .agg(F.sort_array(F.collect_list(F.struct("c", "key"))).alias("held"), F.sum("c").alias("typical")))
    # keys that nobody else has are the rarest; they fill the prefix first
    left = size - (F.col("whole") - F.size("held"))
    return (own.filter(left > 0).select("id", "n", "typical", F.explode(F.slice("held", F.lit(1), left.cast("int"))).alias("e"))
            .select("id", "n", "typical", F.col("e.key").alias("key")))


def _open(lists: DataFrame, comp: DataFrame, name: str) -> DataFrame:
    """The lists (key, id, n) that hold several components, with each member's
    component and the list's largest one (``main``)."""
    placed = lists.join(comp, lists["id"] == comp["node"], "left").withColumn("component", F.coalesce("component", "id"))
    placed = staged(placed.select("key", "id", "n", "component"), name)
    per = placed.groupBy("key", "component").agg(F.count("*").alias("c"))
    main = staged(per.groupBy("key").agg(F.max(F.struct("c", "component")).alias("m"), F.count("*").alias("parts"))
                  .filter("parts > 1").select("key", F.col("m.component").alias("main")), "list_mains")
    return placed.join(main, "key")


def _between(open_: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between components among the classes of ``open_``: at
    least one for each class and other component that it has a link to."""
    least = open_.groupBy("key").agg(F.min("id").alias("b"))
    group = staged(components(open_.join(least, "key").select(F.col("id").alias("a"), "b")), "groups")
    whole = sets.join(open_.select("id", "component").distinct(), "id").join(
        group.select(F.col("node").alias("id"), F.col("component").alias("g")), "id")
    whole = staged(whole, "group_sets")
    per = whole.groupBy("g", "component").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    sizes = per.groupBy("g").agg(F.max(F.struct("c", "component")).alias("m"), F.sum("c").alias("c"), F.sum("s").alias("s"), F.count("*").alias("parts"))
    sizes = staged(sizes.filter("parts > 1").select("g", F.col("m.component").alias("main"), F.ceil(
        F.greatest(F.col("c") / BLOCK_SETS, F.col("s") / BLOCK_ITEMS)).cast("int").alias("blocks")), "group_sizes")
    cut = whole.join(sizes, "g").withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    left = cut.filter("component <> main").select("g", "id", "n", "component", "items", "mine", every).select(
        "g", F.col("mine").alias("i"), F.col("other").alias("j"), "id", "n", "component", "items")
    right = cut.select("g", "id", "n", "component", "items", "mine", every).select(
        "g", F.col("other").alias("i"), F.col("mine").alias("j"), "id", "n", "component", "items")
    right = right.toDF(*[f"{c}_" for c in right.columns])       # other names, as both sides come from one table
    pairs = left.groupBy("g", "i", "j").cogroup(right.groupBy("g_", "i_", "j_")).applyInArrow(compare_blocks, "a long, b long")
    return pairs.distinct()


def _flat(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(member, item) of all items of a block."""
    column = rows["items"].combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    lens = np.diff(column.offsets.to_numpy())
    return np.repeat(np.arange(len(lens)), lens), column.flatten().to_numpy()


def compare_blocks(left: pa.Table, right: pa.Table) -> pa.Table:
    """The links of the sets of one block to those of another: intersections
    as products of 0-1 matrices over the items that both blocks have."""
    none = pa.table([pa.array([], pa.int64())] * 2, names=["a", "b"])
    right = right.rename_columns([c.rstrip("_") for c in right.column_names])
    if not left.num_rows or not right.num_rows:
        return none
    (who, items), (whom, others) = _flat(left), _flat(right)
    common = np.intersect1d(items, others)
    at, to = np.searchsorted(common, items), np.searchsorted(common, others)
    keep = np.flatnonzero((at < len(common)) & (common[np.minimum(at, len(common) - 1)] == items)) if len(common) else []
    keep_to = np.flatnonzero((to < len(common)) & (common[np.minimum(to, len(common) - 1)] == others)) if len(common) else []
    both = np.zeros((left.num_rows, right.num_rows), np.int64)
    if len(common):
        who, at, whom, to = who[keep], at[keep], whom[keep_to], to[keep_to]
        by, by_to = np.argsort(at, kind="stable"), np.argsort(to, kind="stable")
        who, at, whom, to = who[by], at[by], whom[by_to], to[by_to]
        for low in range(0, len(common), 4096):
            x, y = (np.zeros((rows.num_rows, min(4096, len(common) - low)), np.float32) for rows in (left, right))
            s, t = (slice(*np.searchsorted(v, [low, low + 4096])) for v in (at, to))
            x[who[s], at[s] - low] = 1
            y[whom[t], to[t] - low] = 1
            both += (x @ y.T).astype(np.int64)          # exact: a product of 4,096 zeros and ones
    n, m = left["n"].to_numpy()[:, None], right["n"].to_numpy()[None, :]
    link = both * 100 >= (n + m - both) * PERCENT
    mine, theirs = left["component"].to_numpy(), right["component"].to_numpy()
    link &= mine[:, None] != theirs[None, :]
    x, y = np.nonzero(link)
    if not len(x):
        return none
    # one link for a class and another component is enough
    _, one = np.unique(np.stack([x, theirs[y]]), axis=1, return_index=True)
    a, b = left["id"].to_numpy()[x[one]], right["id"].to_numpy()[y[one]]
    return pa.table([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def links(docs: DataFrame, coords: int = COORDS, matches: int = MATCHES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with their class, classes with their component, confirmed links between classes).
    ``docs``: (doc_id, text) and, if the caller needs it again, a number ``row`` of each row."""
    docs = docs if "row" in docs.columns else docs.withColumn("row", F.monotonically_increasing_id())
    with small_batches(docs.sparkSession):
        rows = staged(signed(docs, coords), "signed")
    classes = (rows.filter("node IS NOT NULL").groupBy("node")
               .agg(F.min("text_key").alias("text_key"), F.max("n_shingles").alias("n"), F.first("sig").alias("sig")))
    classes = staged(classes.withColumn("id", F.monotonically_increasing_id()), "classes")

    # dealt before each row becomes ``coords`` keys, so that a task aggregates no more than fits a few pages
    tasks = max(1, -(-classes.count() // TASK_CLASSES))
    keys = classes.select("id", "n", "sig").repartition(tasks, "id").select("id", "n", F.posexplode("sig").alias("k", "v")).select(
        "id", "n", F.lit(coords).alias("whole"), F.xxhash64("k", "v").alias("key"))
    lists = staged(_rarest(keys, F.lit(coords - matches + 1)), "lists")
    top = staged(lists.groupBy("key").agg(F.max(F.struct("typical", "id", "n")).alias("top"), F.count("*").alias("c"))
                 .filter("c > 1").select("key", F.col("top.id").alias("b"), F.col("top.n").alias("n_b")), "list_tops")
    lists = staged(lists.join(top.select("key"), "key").select("key", "id", "n"), "shared_lists")
    wanted = staged(classes.join(lists.select("id").distinct(), "id", "left_semi").select("id", "node", "text_key"), "wanted")
    sets = full_sets(docs, wanted.select("text_key")).dropDuplicates(["node"])
    with small_batches(docs.sparkSession):
        sets = staged(sets.join(wanted.select("node", "id"), "node").select("id", "n", "items"), "sets")

    stars = (lists.join(top, "key").filter((F.col("id") != F.col("b")) & _fits("n", "n_b"))
             .select(F.col("id").alias("a"), "b").distinct())
    first = staged(confirmed(staged(colliding(stars, classes, matches), "stars"), sets), "star_links")
    comp = staged(components(first), "star_components")

    # what is left: classes that share a list with another component, now by the rarest quarter of their sets
    some = _open(lists, comp, "placed_lists").select("id").distinct()
    items = sets.join(some, "id", "left_semi").select("id", "n", F.col("n").alias("whole"), F.explode("items").alias("key"))
    rarest = _rarest(items, F.col("whole") - F.ceil(F.col("whole") * PERCENT / 100) + 1).select("key", "id", "n")
    open_ = staged(_open(rarest, comp, "placed_items"), "open_items")
    late = _between(open_, sets)
    found = staged(first.union(late), "links")
    return rows, classes.select("node", "id").join(
        components(found).withColumnRenamed("node", "id"), "id", "left").select(
        "node", F.coalesce("component", "id").alias("component")), found


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``."""
    rows, comp, _ = links(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))
    least = rows.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"))
    least = staged(least.join(comp, "node"), "class_ids")
    whole = least.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = staged(least.join(whole, "component").select("node", "component_id"), "component_ids")
    out = rows.select("doc_id", "n_shingles", "node").join(ids, "node", "left")
    out = out.withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are kept, with their own columns: of each component
    one row, the one with the smallest id (a null id comes last), of several
    such rows any one; and all rows that are linked with nothing.  It goes by
    row, so rows that share an id or have none are decided each by its text."""
    # written first, so that the rows' numbers are the same at each reading
    numbered = staged(docs.withColumn("_near_row", F.monotonically_increasing_id()), "near_rows")
    rows, comp, _ = links(numbered.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                                          F.col("_near_row").alias("row")))
    linked = rows.filter("node IS NOT NULL")
    first = linked.groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
    best = (staged(first.join(comp, "node"), "class_firsts").groupBy("component").agg(F.min("first").alias("first"))
            .select(F.col("first.row").alias("_near_row")))
    gone = staged(linked.select(F.col("row").alias("_near_row")).join(best, "_near_row", "left_anti"), "near_gone")
    return numbered.join(gone, "_near_row", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
