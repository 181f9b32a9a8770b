"""Exact dedup by two passes over a Bloom filter.

Texts are equal when they are the same after every white-space character
(``[\\x20\\x09-\\x0D]``) is deleted; a null text counts as empty.  Of equal
texts the row with the most code points in its original text stays, then the
one with the smallest id (a null id comes last), then any one row.

Pass 1 sets two filter cells for each row (from a hash of the normalised
text) and keeps the cells that were hit at least twice.  Pass 2 looks both
cells of each row up: a row with a cell that was hit once has no equal and
goes straight through, without a shuffle.  Only the others ("suspects") are
grouped, by the SHA-256 of the normalised text, so a false positive of the
filter costs a shuffled row and never a wrong result.

The filter has ``FILTER_BITS`` cells whatever the input, 64 to a row, so its
broadcast has at most ``FILTER_BITS / 64`` rows (about 50 MB).  Beyond some
10^8 rows more and more rows become suspects, and the work goes over into a
plain grouped dedup.  Raise the parameter with the memory of the executors.

Everything here is DataFrame functions: no Python runs on the executors.

Edge cases: empty table -> empty result; null and empty texts are equal to
each other; rows that repeat an id are rows like others (one of equal rows
is kept); columns of the input with the name of a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import WHITE, staged

FILTER_BITS = 1 << 26
RESULT = ["keep_id", "group_size", "kept", "text_sha256"]


def text_key(text: Column) -> Column:
    """SHA-256 (lowercase hex) of the normalised text."""
    return F.sha2(F.encode(F.regexp_replace(F.coalesce(text, F.lit("")), f"[{WHITE}]", ""), "UTF-8"), 256)


def _cells(key: str, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(bits)) for seed in (1, 2)]


def repeated_cells(keys: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """Pass 1: the filter of cells hit at least twice, as (word, mask) rows of
    64 cells.  A hot key is counted in each task before the exchange."""
    hit = (keys.select(F.explode(F.array(*_cells(key, bits))).alias("cell"))
           .groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1"))
    bit = F.expr("shiftleft(1L, cast(cell % 64 as int))")
    return hit.groupBy(F.shiftright("cell", 6).alias("word")).agg(F.bit_or(bit).alias("mask"))


def mark_suspects(df: DataFrame, key: str, words: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """Pass 2: ``df`` with ``_suspect``, without an exchange of its rows."""
    for i, cell in enumerate(_cells(key, bits)):
        w = F.broadcast(words.select(F.col("word").alias(f"_w{i}"), F.col("mask").alias(f"_m{i}")))
        df = df.withColumn(f"_c{i}", cell)
        df = df.join(w, F.shiftright(f"_c{i}", 6) == F.col(f"_w{i}"), "left")
    hit = [F.expr(f"coalesce(shiftright(_m{i}, cast(_c{i} % 64 as int)) & 1L, 0L) = 1L") for i in (0, 1)]
    return df.withColumn("_suspect", hit[0] & hit[1]).drop(*[f"_{x}{i}" for x in "wmc" for i in (0, 1)])


def _rank(id_col: Column, more: Column) -> Column:
    """Greatest for the row that stays."""
    return F.struct(F.col("_chars"), id_col.isNotNull().alias("has"), F.bitwise_not(id_col).alias("id"), more.alias("row"))


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = FILTER_BITS) -> DataFrame:
    """One row per row of ``docs``: the id, ``keep_id`` (id of the row that
    stays), ``group_size``, ``kept``, ``text_sha256``.  ``id_col`` holds integers."""
    rows = staged(docs.select(
        F.col(id_col).cast("long").alias("_id"),
        F.coalesce(F.char_length(text_col), F.lit(0)).alias("_chars"),
        text_key(F.col(text_col)).alias("_key"),
    ).withColumn("_row", F.monotonically_increasing_id()), "exact_rows")
    marked = mark_suspects(rows, "_key", repeated_cells(rows, "_key", bits), bits)
    alone = marked.filter(~F.col("_suspect")).select(
        F.col("_id").alias(id_col), F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("_key").alias("text_sha256"))
    suspects = marked.filter("_suspect")
    # written first, so that the join below deals both sides anew and a hot group's side can be split
    groups = staged(suspects.groupBy(F.col("_key").alias("_group"))
                    .agg(F.max(_rank(F.col("_id"), F.col("_row"))).alias("_best"), F.count("*").alias("group_size")),
                    "exact_groups")
    grouped = suspects.join(groups, F.col("_key") == F.col("_group")).select(
        F.col("_id").alias(id_col),
        F.when(F.col("_best.has"), F.bitwise_not(F.col("_best.id"))).alias("keep_id"),
        "group_size", (F.col("_row") == F.col("_best.row")).alias("kept"),
        F.col("_key").alias("text_sha256"))
    return alone.unionByName(grouped)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns.

    Rows that the filter clears aren't moved; of the suspects each group's
    best row is found by a partial aggregate of whole rows.
    """
    own = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("_doc"),
                       F.col(id_col).cast("long").alias("_id"),
                       F.coalesce(F.char_length(text_col), F.lit(0)).alias("_chars"),
                       text_key(F.col(text_col)).alias("_key"))
    keys = staged(rows.select("_key"), "exact_keys")
    marked = mark_suspects(rows, "_key", repeated_cells(keys, "_key", bits), bits)
    best = (marked.filter("_suspect").groupBy("_key")
            .agg(F.max_by("_doc", _rank(F.col("_id"), F.lit(0))).alias("_doc")))
    return (marked.filter(~F.col("_suspect")).select("_doc")
            .unionByName(best.select("_doc")).select("_doc.*"))
