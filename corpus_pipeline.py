"""The corpus pipeline: language ID, exact dedup, near dedup, mixing, packing.

``STAGES`` lists (name, function); a function takes ``(spark, docs, sf_dir)``
and returns a DataFrame, which is written as Parquet and read again as the
next one's ``docs``.  All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import exact_dedup, langid, mixing, near_dedup, packing
from quayside.llm.chunks import SMALL
from quayside.llm.common import set_small_batches, staged, table
from quayside.llm.queries import quality_weights

def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: null, empty and letterless texts go.  If no
    document says its language, there is nothing to reject by, and all stay.
    From here on the session sends texts to Python in small batches: stages
    are returned before they run, so that no shorter time could be given."""
    set_small_batches(spark)
    if docs.filter("lang IS NOT NULL AND text IS NOT NULL").limit(1).count() == 0:
        return docs
    # carried under numbers, so that no column clashes with the operator's own
    names = [f"_{i}" for i in range(len(docs.columns))]
    at = {c.lower(): n for c, n in zip(docs.columns, names)}
    seen = langid.identify(docs.toDF(*names), carry=names, id_col=at["doc_id"], text_col=at["text"], lang_col=at["lang"])
    return seen.filter(F.col("lang_pred") != "und").select(*names).toDF(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.drop_near(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mixing.materialise(docs, mixing.mix(docs, quality=quality_weights(spark, sf_dir)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences.  The stages before
    have grown the executors' heaps, so the tokenizer's memos are small ones."""
    return packing.pack_documents(docs, sizes=SMALL)


STAGES = [("language_id", language_id), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix), ("packing", pack)]

#: Language models, MinHash components and packing have no SQL; tests/llm/test_pipeline.py compares with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
