import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quayside.llm import divergence
from tests.llm.cases import awkward, documents, empty, frame, plain

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def by_hand(rows, min_docs=3, top=200):
    """(lang, source, part, item, value, rank) of (text, lang, source) rows in Python integers."""
    rows = [tuple(x or "" for x in r) for r in rows]
    counts, docs = {}, {}
    for text, lang, source in rows:
        found = ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text)]
        counts.setdefault((lang, source), Counter()).update(found)
        docs.setdefault(lang, Counter()).update(set(found))
    out = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        v = len(kept)
        whole = Counter()
        groups = {s: {t: c[t] for t in kept} for (x, s), c in counts.items() if x == lang}
        for c in groups.values():
            whole.update(c)

        def p(c):
            n = sum(c.get(t, 0) for t in kept)
            return {t: 1 + 10**9 * (c.get(t, 0) + 1) // (n + v) for t in kept}

        ps, q = {s: p(c) for s, c in groups.items()}, p(whole)
        for s in groups:
            found = {"pair": [(sum((ps[s][t] - ps[o][t])**2 // ps[o][t] for t in kept), o) for o in groups if o != s],
                     "term": [((ps[s][t] - q[t])**2 // q[t], t) for t in kept if groups[s][t] > 0 and ps[s][t] > q[t]]}
            for part, items in found.items():
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(items) if part == "pair" or i < top]
    return sorted(out)


def triples(df):
    return plain(df.select("text", "lang", "source"))


@pytest.mark.parametrize("min_docs, top", [(3, 200), (1, 5), (40, 200)])
def test_awkward_rows(spark, min_docs, top):
    df = frame(spark, awkward())
    assert sorted(plain(divergence.audit(df, min_docs, top))) == by_hand(triples(df), min_docs, top)


def test_documents(spark):
    assert sorted(plain(divergence.audit(documents(spark)))) == by_hand(triples(documents(spark)))


def test_many_blocks_and_parts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TASK_ENTRIES", 50)
    df = frame(spark, awkward())
    kept = divergence.Audit(df, 1).kept
    assert kept.count() > 30
    assert sorted(plain(divergence.audit(df, 1))) == by_hand(triples(df), 1)


def test_groups_without_terms(spark):
    rows = [("12 ..", "en", "a"), ("one two", "en", "b"), ("three", "en", None), (None, None, "a"), (None, None, None), ("x", "de", "only")]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    got = sorted(plain(divergence.audit(df)))
    assert got == by_hand(rows) and {r[4] for r in got} == {0} and len(got) == 8
    assert sorted(plain(divergence.audit(df, 1))) == by_hand(rows, 1)
    assert plain(divergence.audit(empty(spark))) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 300), unique=True), st.lists(st.integers(0, 300), unique=True), st.integers(1, 9))
def test_gallop_finds_first_places(a, b, stride):
    a, b = np.array(sorted(a), np.int64), np.array(sorted(b), np.int64)
    assert divergence.gallop(a, b, stride).tolist() == np.searchsorted(b, a).tolist()


@settings(max_examples=200, deadline=None)
@given(*[st.dictionaries(st.integers(0, 60), st.integers(1, 10**6), max_size=30)] * 2, st.integers(0, 50))
def test_merge_prices_both_ways(a, b, extra):
    v = len({*a, *b}) + extra
    wholes = [sum(x.values()) + v for x in (a, b)]
    if not v:
        return

    def p(c, whole):
        return 1 + 10**9 * (c + 1) // whole

    want = [0, 0]
    for t in {*a, *b}:
        x, y = p(a.get(t, 0), wholes[0]), p(b.get(t, 0), wholes[1])
        want = [want[0] + (x - y)**2 // y, want[1] + (y - x)**2 // x]
    sides = [(np.array(sorted(x), np.int64), np.array([x[k] for k in sorted(x)], np.int64)) for x in (a, b)]
    assert divergence.merge_prices(*sides, *wholes) == (len({*a, *b}), *want)


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 8 * 10**15), st.integers(1, 10**15))
def test_shares_beyond_the_range_of_a_product(count, more):
    assert divergence.shares(np.array([count], np.int64), count + more)[0] == 1 + 10**9 * (count + 1) // (count + more)


def test_share_of_columns(spark):
    from pyspark.sql import functions as F
    rows = [(0, 1), (5, 1000), (7 * 10**15, 8 * 10**15), (3, 7)]
    df = spark.createDataFrame(rows, "c long, w long")
    assert [r[0] for r in df.select(divergence.share(F.col("c"), F.col("w"))).collect()] == [1 + 10**9 * (c + 1) // w for c, w in rows]
