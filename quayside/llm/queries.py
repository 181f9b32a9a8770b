"""The named queries of this subpackage: each applies one operator, with its
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import (divergence, exact_dedup, html_extract, langid, line_dedup, mixing, near_dedup, packing, sharding,
                          suffix_dedup, token_align, token_binary, topk)
from quayside.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


@query("op1_token_binary")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_binary.token_digest(table(spark, sf_dir, "documents"))


def quality_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling weights from the quality labels: good 2, bad 0.5, unlabelled 1."""
    labels = table(spark, sf_dir, "labels")
    return labels.select("doc_id", F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5).alias("weight"))


@query("op2_mixing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), quality=quality_weights(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "epochs", "part")


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out(F.col("doc_id")))
    return langid.identify(docs, carry=["doc_id", "held_out"])


@query("op4_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.decide(table(spark, sf_dir, "documents"))


@query("op5_suffix_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                       F.size("span_starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_sharding")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), 8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "vslot")


@query("op7_html_extraction")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op9_exact_dedup", r"""
WITH n AS (
  SELECT doc_id, CAST(length(coalesce(text, '')) AS BIGINT) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(table(spark, sf_dir, "documents"))


@query("op10_topk", """
WITH v AS (
  SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(CAST(x AS DOUBLE))]) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query("op11_token_align")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align_digest(table(spark, sf_dir, "documents"))


@query("op12_divergence", r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
o AS (SELECT r, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT g.lang, g.source, k.term, k.total, count(o.r) AS n
      FROM g JOIN k ON k.lang = g.lang LEFT JOIN o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term
      GROUP BY g.lang, g.source, k.term, k.total),
s AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS n_group, count(*) OVER (PARTITION BY lang, source) AS v,
             sum(total) OVER (PARTITION BY lang, source) AS n_lang FROM c),
p AS (SELECT lang, source, term, n, CAST(1 + (1000000000::HUGEINT * (n + 1)) // (n_group + v) AS BIGINT) AS p,
             CAST(1 + (1000000000::HUGEINT * (total + 1)) // (n_lang + v) AS BIGINT) AS q FROM s),
x AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM p WHERE n > 0 AND p > q),
f AS (SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
             CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM u)
SELECT * FROM f WHERE part = 'pair' OR rank <= 200""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), min_docs=3, top=200)


@query("op13_line_dedup", r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
g AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(g.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE g.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN g USING (key) GROUP BY r""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.remove_lines(table(spark, sf_dir, "documents"), min_chars=1, min_docs=10)
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
