"""Divergence audit of the sources of a language.

Terms are runs of ASCII letters and code points beyond ASCII, A-Z in lower
case.  A language keeps its V terms that at least ``min_docs`` of its documents
hold.  A group, a (language, source), and each language as a whole, give every
kept term ``p = 1 + floor(SCALE * (count + 1) / (N + V))`` with N the sum of
their counts of kept terms.  The divergence of a term with p in a group from q
elsewhere is ``floor((p - q)^2 / q)``; all arithmetic is in integers.

* ``pairs``: the sum over all kept terms, of each group from every other source
  of its language.
* ``terms``: the kept terms that a group uses more than its language does, by
  their divergence from the language, the first ``top`` of each group.

Method.  Kept terms get ids, and each group's sorted (term id, count) arrays
lie in blocks of ``BLOCK`` ids.  Per unordered pair of sources the two groups'
arrays are co-grouped, as many blocks in a task as ``TASK_ENTRIES`` allows, and
merged once for both directions: a galloping intersection finds the terms that
both have; those, and the terms of one side, are priced one by one; terms that
neither has all cost the same and are priced by their number.  No task holds a
whole group, and what a pair task gets doesn't grow with the corpus.

Counts are exact up to 9e15 words in a language; a sum of prices fits a long up
to 2e9 kept terms in a language.

Edge cases: null text, language or source is ''; a group without terms, or a
language with V = 0, still has its pairs (value 0 if V = 0); a language with
one source has no pairs; a document is a row, repeated ids or not; an empty
table gives empty results; other columns aren't read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quayside.llm.common import staged

SCALE = 10**9
BLOCK = 1 << 16
#: Entries of one side that a pair task holds, about.
TASK_ENTRIES = 4_000_000
#: Distinct (group, term) entries that a counting task holds before it passes them on.
HELD = 600_000
#: In UTF-8, every byte of a code point beyond ASCII is 0x80 or more.
TERM = re.compile(rb"[a-z\x80-\xff]+")


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, summed in each
    task; a group's row without a term says that the group occurs."""
    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict = {}
        docs_: dict = {}
        seen = set()

        def flush():
            for g, c in n.items():
                d = docs_[g]
                terms = pa.array(list(c), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[0]] * len(c), pa.string()), pa.array([g[1]] * len(c), pa.string()), terms,
                     pa.array(list(c.values()), pa.int64()), pa.array([d[t] for t in c], pa.int64())], names=names)
            n.clear(), docs_.clear()

        names = ["lang", "source", "term", "n", "docs"]
        for b in rows:
            texts = b.column(2).cast(pa.large_binary())
            for at in range(0, b.num_rows, 256):
                part = [x.slice(at, 256).to_pylist() for x in (b.column(0), b.column(1), texts)]
                for lang, source, text in zip(*part):
                    g = (lang, source)
                    if g not in n:
                        n[g], docs_[g] = Counter(), Counter()
                        seen.add(g)
                    found = TERM.findall(text.lower())
                    n[g].update(found)
                    docs_[g].update(set(found))
                if sum(map(len, n.values())) > HELD:
                    yield from flush()
        yield from flush()
        none = [None] * len(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([g[0] for g in seen], pa.string()), pa.array([g[1] for g in seen], pa.string()), pa.array(none, pa.string()),
             pa.array(none, pa.int64()), pa.array(none, pa.int64())], names=names)

    none = F.lit("")
    own = docs.select(F.coalesce(F.col(lang_col), none).alias("lang"), F.coalesce(F.col(source_col), none).alias("source"),
                      F.coalesce(F.col(text_col), none).alias("text"))
    return own.mapInArrow(count, "lang string, source string, term string, n long, docs long")


class Audit:
    """The counts of a corpus, written once; ``pairs`` and ``terms`` read them."""

    def __init__(self, docs: DataFrame, min_docs: int = 3, **columns: str):
        counted = staged(term_counts(docs, **columns), "term_counts")
        used = counted.where("term IS NOT NULL").repartition("lang", "term")
        per_source = used.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        # a row for a kept term; its list has at most one entry for each source
        self.kept = staged(per_source.groupBy("lang", "term")
                           .agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("by_source"))
                           .where(F.col("docs") >= min_docs).drop("docs"), "kept_terms")
        langs = self.kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("n_lang"))
        held = self.kept.select("lang", F.explode("by_source").alias("s")).groupBy("lang", "s.source").agg(F.sum("s.n").alias("n_group"))
        groups = counted.where("term IS NULL").select("lang", "source").distinct()
        zero = F.lit(0).cast("long")
        #: One row for each occurring group: its N, its language's N and V.
        self.groups = staged(groups.join(held, ["lang", "source"], "left").join(langs, "lang", "left")
                             .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("n_group", "n_lang", "v")]), "audit_groups")

    def pairs(self) -> DataFrame:
        """(lang, source, item, value): ``item`` is another source of the language."""
        g = self.groups
        a = g.select("lang", F.col("source").alias("a"), F.col("n_group").alias("n_a"), "v")
        b = g.select("lang", F.col("source").alias("b"), F.col("n_group").alias("n_b"))
        both = staged(a.join(b, "lang").where("a < b"), "audit_pairs")        # the rows asked for, each once for two

        blocks = staged(group_blocks(self.kept), "audit_blocks")
        # as many parts as hold the largest group's entries: a number that Spark sums, one row
        entries = blocks.groupBy("lang", "source").agg(F.sum("entries").alias("e")).agg(F.max("e")).first()[0] or 0
        parts = F.pmod(F.hash("block"), F.lit(1 + int(entries) // TASK_ENTRIES)).alias("part")
        blocks = blocks.select("lang", "source", "block", parts, "ids", "counts")
        left, right = (blocks.withColumnRenamed("source", s).join(both, ["lang", s]) for s in "ab")
        right = right.select(*[F.col(c).alias(c) for c in right.columns])       # columns of its own, as both sides read one table
        pair = ["lang", "a", "b", "part"]
        priced = left.groupBy(*pair).cogroup(right.groupBy(*pair))\
            .applyInArrow(_price_pair, "lang string, a string, b string, n_any long, ab long, ba long")
        priced = priced.groupBy("lang", "a", "b").agg(*[F.sum(c).alias(c) for c in ("n_any", "ab", "ba")])

        all_ = both.join(priced, ["lang", "a", "b"], "left").na.fill(0, ["n_any", "ab", "ba"])
        none = F.lit(0).cast("long")
        p, q = share(none, F.col("n_a") + F.col("v")), share(none, F.col("n_b") + F.col("v"))
        all_ = all_.where("v > 0").select("*", p.alias("p"), q.alias("q"))
        absent = F.col("v") - F.col("n_any")
        rows = [all_.select("lang", F.col(s).alias("source"), F.col(t).alias("item"), (F.col(s + t) + absent * price(F.col(x), F.col(y))).alias("value"))
                for s, t, x, y in (("a", "b", "p", "q"), ("b", "a", "q", "p"))]
        empty = both.where("v = 0")
        rows += [empty.select("lang", F.col(s).alias("source"), F.col(t).alias("item"), none.alias("value")) for s, t in ("ab", "ba")]
        return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])

    def terms(self) -> DataFrame:
        """(lang, source, item, value) of all terms that a group uses more than its language."""
        used = self.kept.select("lang", F.col("term").alias("item"), "total", F.explode("by_source").alias("s"))
        used = used.select("lang", "s.source", "item", "total", "s.n").join(self.groups, ["lang", "source"])
        used = used.select("lang", "source", "item", share(F.col("n"), F.col("n_group") + F.col("v")).alias("p"),
                           share(F.col("total"), F.col("n_lang") + F.col("v")).alias("q"))
        return used.where("p > q").select("lang", "source", "item", price(F.col("p"), F.col("q")).alias("value"))


def audit(docs: DataFrame, min_docs: int = 3, top: int = 200, **columns: str) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` in full, part
    ``term`` up to rank ``top``.  Strings are ordered by their UTF-8 bytes."""
    a = Audit(docs, min_docs, **columns)
    by = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    # Spark keeps the first ``top`` of each group in each task before the exchange
    terms = a.terms().withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
    pairs = a.pairs().withColumn("rank", F.row_number().over(by))
    return (pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term")))
            .select("lang", "source", "part", "item", "value", "rank"))


def share(count: Column, whole: Column) -> Column:
    """``1 + floor(SCALE * (count + 1) / whole)`` in three divisions, so that no product leaves the range of a long."""
    out, rest = F.lit(0).cast("long"), count + 1
    for _ in range(3):
        out, rest = out * 1000 + F.call_function("div", rest * 1000, whole), F.pmod(rest * 1000, whole)
    return out + 1


def price(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def shares(counts: np.ndarray, whole: int) -> np.ndarray:
    """``share`` of an array."""
    out, rest = np.zeros(len(counts), np.int64), counts.astype(np.int64) + 1
    for _ in range(3):
        out, rest = out * 1000 + rest * 1000 // whole, rest * 1000 % whole
    return out + 1


def group_blocks(kept: DataFrame) -> DataFrame:
    """(lang, source, block, entries, ids, counts): the sorted term ids of a
    group in a block of the kept terms, as 16-bit places, with their counts.

    A task's rows are cut into blocks as they come; to be written once.
    """
    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, at, number = TaskContext.get().partitionId(), 0, 0
        held: dict = {}

        def flush():
            nonlocal number
            out = {k: [] for k in ("lang", "source", "block", "entries", "ids", "counts")}
            for (lang, source), (ids, counts) in held.items():
                c = np.array(counts, np.int64)
                width = next(w for w in ("u1", "<u2", "<u4", "<i8") if c.max() <= np.iinfo(w).max)
                for k, v in zip(out, (lang, source, task << 32 | number, len(ids), np.array(ids, "<u2").tobytes(), c.astype(width).tobytes())):
                    out[k].append(v)
            number += 1
            held.clear()
            return pa.RecordBatch.from_pydict(out, schema=schema)

        for b in rows:
            langs, lists = b.column(0).to_pylist(), b.column(1)
            ends = np.asarray(lists.offsets)
            flat = lists.values
            sources, counts = flat.field(0).to_pylist(), flat.field(1).to_pylist()
            for i, lang in enumerate(langs):
                for j in range(ends[i], ends[i + 1]):
                    ids, ns = held.setdefault((lang, sources[j]), ([], []))
                    ids.append(at)
                    ns.append(counts[j])
                at += 1
                if at == BLOCK:
                    yield flush()
                    at = 0
        if held:
            yield flush()

    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("block", pa.int64()), ("entries", pa.int64()),
                        ("ids", pa.binary()), ("counts", pa.binary())])
    return kept.select("lang", "by_source").mapInArrow(cut, "lang string, source string, block long, entries long, ids binary, counts binary")


def gallop(small: np.ndarray, large: np.ndarray, stride: int = 32) -> np.ndarray:
    """For each value of ``small`` the first place in ``large`` that isn't below
    it.  Every ``stride``-th value is looked up; the others start from the one
    before and take steps of doubling length, then halve the last one."""
    n = len(large)
    low = np.repeat(np.searchsorted(large, small[::stride]), stride)[:len(small)].astype(np.int64)
    step, high, live = 1, low.copy(), np.arange(len(small))
    while len(live):                                    # high: the first probe that isn't below the value
        ahead = np.minimum(high[live], n - 1) if n else high[live]
        live = live[(high[live] < n) & (large[ahead] < small[live])] if n else live[:0]
        low[live] = high[live] + 1
        high[live] += step
        step *= 2
    high = np.minimum(high, n)
    while (open_ := np.flatnonzero(low < high)).size:
        mid = (low[open_] + high[open_]) // 2
        below = large[mid] < small[open_]
        low[open_[below]] = mid[below] + 1
        high[open_[~below]] = mid[~below]
    return low


def _side(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The sorted (ids, counts) of one group's blocks."""
    ids, counts = [], []
    blocks = rows.column("block").to_pylist()
    packed = [rows.column(c).to_pylist() for c in ("ids", "counts")]
    for i in np.argsort(blocks, kind="stable").tolist():
        places = np.frombuffer(packed[0][i], "<u2")
        width = {1: "u1", 2: "<u2", 4: "<u4", 8: "<i8"}[len(packed[1][i]) // len(places)]
        ids.append(places.astype(np.int64) + (blocks[i] << 16))
        counts.append(np.frombuffer(packed[1][i], width).astype(np.int64))
    none = np.zeros(0, np.int64)
    return np.concatenate(ids or [none]), np.concatenate(counts or [none])


def _prices(p: np.ndarray | int, q: np.ndarray | int) -> int:
    return int(((p - q) * (p - q) // q).sum())


def merge_prices(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], whole_a: int, whole_b: int) -> tuple[int, int, int]:
    """(terms that a side has, their prices from a to b, from b to a) of two
    sorted (ids, counts) sides; ``whole`` is a group's N + V."""
    swap = len(a[0]) > len(b[0])
    if swap:
        a, b, whole_a, whole_b = b, a, whole_b, whole_a
    p, q = shares(a[1], whole_a), shares(b[1], whole_b)
    p0, q0 = int(shares(np.zeros(1, np.int64), whole_a)[0]), int(shares(np.zeros(1, np.int64), whole_b)[0])
    at = gallop(a[0], b[0])
    met = at < len(b[0])
    met[met] = b[0][at[met]] == a[0][met]
    shared = at[met]
    only_b = np.ones(len(q), bool)
    only_b[shared] = False
    ab = _prices(p[met], q[shared]) + _prices(p[~met], q0) + _prices(p0, q[only_b])
    ba = _prices(q[shared], p[met]) + _prices(q0, p[~met]) + _prices(q[only_b], p0)
    any_ = len(p) + int(only_b.sum())
    return (any_, ba, ab) if swap else (any_, ab, ba)


def _price_pair(left: pa.Table, right: pa.Table) -> pa.Table:
    """Co-grouped blocks of sources a (left) and b (right)."""
    row = {c: (left if left.num_rows else right).column(c)[0].as_py() for c in ("lang", "a", "b", "n_a", "n_b", "v")}
    any_, ab, ba = merge_prices(_side(left), _side(right), row["n_a"] + row["v"], row["n_b"] + row["v"])
    return pa.table({"lang": [row["lang"]], "a": [row["a"]], "b": [row["b"]], "n_any": pa.array([any_], pa.int64()),
                     "ab": pa.array([ab], pa.int64()), "ba": pa.array([ba], pa.int64())})
