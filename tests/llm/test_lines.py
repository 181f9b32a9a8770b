import hashlib
import uuid
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quayside.llm import line_dedup
from quayside.llm.common import scratch_path
from tests.llm.cases import F, awkward, documents, empty, frame, plain


def by_hand(rows, min_chars=1, min_docs=10):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    held = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if len(k) >= min_chars)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= min_chars and held[key(x)] >= min_docs)]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def cases():
    rows = [(r[0], r[1]) for r in awkward()]
    rows += [(6000 + i, f"Shared LINE é\n  own {i}\t\n \nshared line é \x0b" + ("\n\n" if i % 2 else "")) for i in range(12)]
    rows += [(7000 + i, "shared line É\nÉ") for i in range(9)] + [(7100, "x\n" * 3000 + "y")] + [(8000, "copy of all\nof it")] * 30
    return rows


def table(spark, rows, parts=7):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)


@pytest.mark.parametrize("min_chars, min_docs, batches", [(1, 10, 6), (0, 10, 2), (12, 3, 4)])
def test_same_as_counting_all_lines(spark, min_chars, min_docs, batches):
    rows = cases()
    got = plain(line_dedup.remove_lines(table(spark, rows), min_chars=min_chars, min_docs=min_docs, batches=batches))
    assert sorted(got, key=str) == by_hand(rows, min_chars, min_docs)


def test_documents(spark):
    rows = plain(documents(spark).select("doc_id", "text"))
    assert sorted(plain(line_dedup.remove_lines(documents(spark), min_docs=3)), key=str) == by_hand(rows, min_docs=3)


def test_other_columns_and_empty_tables(spark):
    got = line_dedup.remove_lines(frame(spark, awkward()), carry=["doc_id", "lang", "kept", "size"])
    assert got.columns == ["doc_id", "lang", "kept", "size", "text", "n_lines", "n_dropped"] and got.count() == len(awkward())
    with pytest.raises(ValueError):
        line_dedup.remove_lines(frame(spark, awkward()), carry=["doc_id", "text"])
    assert plain(line_dedup.remove_lines(empty(spark))) == []
    assert [r[1:] for r in plain(line_dedup.remove_lines(table(spark, [(1, None), (2, "")])))] == [("", 1, 0)] * 2


def test_levels_merge_joins_and_reopening(spark):
    path = scratch_path(spark, "quayside", "runs_test", uuid.uuid4().hex)
    runs = line_dedup.LineRuns(spark, path, min_docs=3, fanout=2)

    def batch(*keys):
        return spark.createDataFrame([(k.encode(),) for k in keys], "key binary")

    def held(r):
        return [[sorted((bytes(k).decode(), n) for k, n in plain(r._table(x))) for x in level] for level in r.levels]

    runs.add(batch("a", "a", "a", "b"))
    assert held(runs) == [[[("a", 3), ("b", 1)]]]
    runs.add(batch("a", "b", "c"))                        # a is settled: not added again; then two runs become one
    assert held(runs) == [[], [[("a", 3), ("b", 2), ("c", 1)]]]
    again = line_dedup.LineRuns.open(spark, path)
    assert (again.levels, again.batches, again.min_docs, again.fanout) == (runs.levels, 2, 3, 2)
    again.add(batch("a", "b"))
    assert held(again) == [[[("b", 1)]], [[("a", 3), ("b", 2), ("c", 1)]]]
    assert sorted(bytes(r.key).decode() for r in again.settled().collect()) == ["a", "b"]


def test_runs_are_not_moved(spark):
    path = scratch_path(spark, "quayside", "runs_test", uuid.uuid4().hex)
    runs = line_dedup.LineRuns(spark, path, min_docs=2)
    keys = spark.range(2000).select((F.col("id") % 700).cast("string").cast("binary").alias("key"))
    runs.add(keys), runs.add(keys)
    merged = runs._merged([r for level in runs.levels for r in level])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in merged and "Exchange" not in merged


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=30))
def test_line_keys(line):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
    assert line_dedup.line_key(line.encode("utf-8", "surrogatepass")) == lowered.strip(" \t\n\x0b\x0c\r").encode("utf-8", "surrogatepass")


def test_query_digest(spark, tmp_path):
    from quayside.llm.queries import QUERIES
    rows = cases()
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    want = [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, t, n, k in by_hand(rows)]
    assert sorted(plain(QUERIES["op13_line_dedup"](spark, str(tmp_path))), key=str) == sorted(want, key=str)
