"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source has a target number of words.  A document's key is
``-ln(u) / w``, with ``u`` from a hash of its id (reruns agree) and ``w`` its
quality weight; documents in ascending order of key are a weighted sample
without replacement.  A source takes as many complete epochs of all its
documents as its target holds; then the rest of the target is filled with
documents in order of key, by a prefix sum of their sizes.  The document at
the edge gives only as many of its words as are still missing.

A hot source is never ordered by one task: its keys are cut into ranges of
about ``RANGE_ROWS`` documents, sums run inside a range, and the totals of
the ranges before it are added.

Edge cases: null text has size 0; null sources are one source, the last;
a null id is hashed by its text; a null or non-positive quality weight counts
as 1; equal rows are taken one after another; an empty table gives an empty
result; a source without words has target 0.
"""

from __future__ import annotations

import itertools
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import StringType

from quayside.llm.common import WHITE, hash_unit, ranked, staged

RANGE_ROWS = 5_000
_WORD = re.compile(f"[^{WHITE}]+")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{WHITE}]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """(source, place, source_size, n, target) from (source, source_size, n).

    Weights repeat over the sources by code point, null last.  The words to
    give out are ``share`` of all; a source that would get more than ``cap``
    times its own size stops there, and what is left is shared again by
    weight.  Each round is one aggregate over the table of sources; the
    driver keeps two numbers.
    """
    places = ranked(sizes, [F.col("source").asc_nulls_last()], "place", "sources")
    by_place = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    src = staged(places.withColumn("weight", by_place), "source_weights")
    total = src.agg(F.sum("source_size")).first()[0] or 0
    rate, stopped = 0.0, -1
    while True:
        full = F.col("weight") * rate > F.col("source_size") * cap if stopped >= 0 else F.lit(False)
        r = src.agg(F.sum(F.when(full, F.col("source_size")).otherwise(0)).alias("s"),
                    F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("w"),
                    F.sum(full.cast("int")).alias("n")).first()
        if not r["w"] or r["n"] == stopped:
            break
        stopped = r["n"]
        rate = (total * share - r["s"] * cap) / r["w"]
    target = F.least(F.col("weight") * rate, F.col("source_size") * cap).cast("double")
    return src.select("source", "place", "source_size", "n", target.alias("target"))


def text_digest(text: Column) -> Column:
    """With the id, what tells a document from another one."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0,
        quality: DataFrame | None = None, seed: int = 17, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target,
    epochs`` (whole copies taken), ``part`` (words of one more copy),
    ``taken`` (all words taken).  ``quality``: (doc_id, weight)."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       n_words(F.col(text_col)).alias("size"),
                       text_digest(F.col(text_col)).alias("digest"))
    base = staged(base, "mix_sizes")
    if quality is None:
        base = base.withColumn("w", F.lit(1.0))
    else:
        q = quality.groupBy(F.col("doc_id").alias("_q")).agg(F.max("weight").alias("w"))
        base = base.join(q, F.col("doc_id") == F.col("_q"), "left").drop("_q")
        base = base.withColumn("w", F.when(F.col("w") > 0, F.col("w").cast("double")).otherwise(1.0))
    u = hash_unit(F.coalesce(F.col("doc_id").cast("string"), F.hex("digest")), F.lit(seed))
    base = base.withColumn("key", -F.log(u) / F.col("w"))
    targets = staged(source_targets(base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")),
                                    weights, share, cap), "targets")
    t = targets.withColumnRenamed("source", "_src")
    rows = base.join(t, F.col("source").eqNullSafe(F.col("_src"))).drop("_src")
    ranges = F.ceil(F.col("n") / RANGE_ROWS)
    rows = rows.withColumn("range", F.floor((1 - F.exp(-F.col("key"))) * ranges))
    rows = staged(rows, "mix_keys")
    sums = rows.groupBy("place", "range").agg(F.sum("size").alias("total"))
    before = W.partitionBy("place").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(F.col("place").alias("_p"), F.col("range").alias("_r"),
                       F.coalesce(F.sum("total").over(before), F.lit(0)).alias("ahead"))
    inside = (W.partitionBy("place", "range").orderBy("key", "doc_id", "size", "digest")
              .rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(sums, (F.col("place") == F.col("_p")) & (F.col("range") == F.col("_r")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rows = rows.withColumn("epochs", epochs)
    rest = F.round(F.col("target")).cast("long") - F.col("epochs") * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("ahead") - F.col("inside")))
    rows = rows.withColumn("part", part.cast("long"))
    return rows.select("doc_id", "source", "size", "source_size", "target", "epochs", "part", "digest",
                       (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"))


@F.pandas_udf(StringType())
def _head(texts: pd.Series, words: pd.Series) -> pd.Series:
    """The first ``words`` words of each text, as they stand there."""
    out = []
    for text, k in zip(texts, words):
        ends = (m.end() for m in _WORD.finditer(text))
        out.append(text[:next(itertools.islice(ends, k - 1, None))])
    return pd.Series(out, dtype="object")


def materialise(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The mixture itself: each document as often as it is taken, with its
    own columns; the partly taken copy holds its first ``part`` words.  Rows
    with one id and one text count as one document taken for all of them."""
    own = docs.columns
    key = lambda i, digest: F.concat_ws(":", F.coalesce(F.col(i).cast("string"), F.lit("null")), F.hex(digest))
    d = (docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("_doc"),
                     key(id_col, text_digest(F.col(text_col))).alias("_key"))
         .groupBy("_key").agg(F.first("_doc").alias("_doc")))
    m = mixed.groupBy(key("doc_id", F.col("digest")).alias("_key")).agg(
        F.sum("epochs").alias("epochs"), F.sum("part").alias("part"), F.max("size").alias("size"))
    whole = F.when(F.col("size") > 0, F.floor(F.col("part") / F.col("size"))).otherwise(0)
    left = F.when(F.col("size") > 0, F.col("part") % F.col("size")).otherwise(0)
    j = d.join(m, "_key").select("_doc", (F.col("epochs") + whole).cast("int").alias("times"), left.cast("long").alias("left"))
    full = j.filter("times > 0").select("_doc", F.explode(F.sequence(F.lit(1), F.col("times")))).select("_doc.*")
    cut = j.filter("left > 0").select("_doc.*", F.col("left").alias("_left"))
    cut = cut.withColumn(text_col, _head(F.col(text_col), F.col("_left"))).select(*own)
    return full.unionByName(cut)
