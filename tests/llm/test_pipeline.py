"""The pipeline against plain Python: exact outcomes where a stage has one."""

from collections import Counter

import corpus_pipeline
from quayside.llm import queries
from tests.llm.cases import awkward, documents, empty, frame, normal, plain
from tests.llm.test_dedup import exact_by_hand, near_by_hand
from tests.llm.test_others import WORD, targets_by_hand
from tests.llm.test_tokens import check_packing
from tests.oracle import compare, duck_connect

SF = "/root/testdata/sf0.001"


def follow(spark, docs):
    """Each stage's result held against its own input."""
    columns = docs.columns
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        before = plain(docs)
        docs = stage(spark, docs, SF)
        after = plain(docs)
        if name != "packing":
            assert docs.columns == columns
        if name == "language_id":
            letters = Counter(r for r in before if any(c.isalpha() for c in r[1] or ""))
            assert not Counter(after) - letters and len(after) >= 0.95 * sum(letters.values())
        elif name == "exact_dedup":
            assert len(after) == exact_by_hand(before)[1] == len({normal(r[1]) for r in after})
        elif name == "near_dedup":
            kept = {r[0] for r in near_by_hand(before) if r[3] or r[0] is None}
            assert {r[0] for r in after} == kept
        elif name == "mixing":
            i = columns.index("source")
            sizes, taken = Counter(), Counter()
            for r in before:
                sizes[r[i]] += len(WORD.findall(r[1]))
            for r in after:
                taken[r[i]] += len(WORD.findall(r[1]))
            want = targets_by_hand(sizes)
            assert all(abs(taken[s] - want[s]) <= 0.5001 for s in sizes)
            texts = {r[0]: r[1] for r in before}
            assert all(texts[r[0]].startswith(r[1]) for r in after)
        else:
            check_packing(before, after)
        docs = spark.createDataFrame(after, docs.schema) if name != "packing" else docs
        out[name] = after
    return out


def test_stages(spark):
    follow(spark, documents(spark))


def test_stages_on_awkward_rows(spark):
    out = follow(spark, frame(spark, awkward()))
    assert len(out["exact_dedup"]) < len(out["language_id"])


def test_stages_on_an_empty_table(spark):
    docs = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert plain(docs) == []
        if docs.columns[0] == "doc_id" and "text" in docs.columns:
            docs = spark.createDataFrame([], docs.schema)


def test_run_is_the_chain_of_stages(spark):
    docs = documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    pieces = Counter(r[:5] for r in plain(docs))
    assert Counter(r[:5] for r in plain(corpus_pipeline.run(spark, SF))) == pieces


def test_queries_against_sql(spark):
    con = duck_connect("/root/testdata/sf0.001")
    for name, sql in queries.ORACLE.items():
        r = compare(queries.QUERIES[name](spark, SF), con, sql)
        assert r["ok"] and r["exact"] and not r["types"], (name, r)
