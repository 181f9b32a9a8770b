import hashlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from quayside.llm import common, exact_dedup, near_dedup, suffix_dedup
from quayside.llm.components import components
from tests.llm.cases import awkward, documents, empty, frame, normal, plain, words

NONE = 1 << 62


# ------------------------------------------------------------------ exact

def exact_by_hand(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[normal(r[1])].append(r)
    out = []
    for key, g in groups.items():
        best = min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        sha = hashlib.sha256(key.encode()).hexdigest()
        out += [(r[0], best[0], len(g), sha) for r in g]
    return sorted(out, key=str), len(groups)


@pytest.mark.parametrize("bits", [1 << 6, 1 << 26])
def test_exact_groups(spark, bits):
    rows = awkward()
    got = plain(exact_dedup.decide(frame(spark, rows), bits=bits))
    want, groups = exact_by_hand(rows)
    assert sorted(((r[0], r[1], r[2], r[4]) for r in got), key=str) == want
    kept = [r for r in got if r[3]]
    assert len(kept) == groups and all(r[0] == r[1] for r in kept)


@pytest.mark.parametrize("bits", [1 << 6, 1 << 26])
def test_exact_keeps_own_columns(spark, bits):
    rows = awkward()
    df = frame(spark, rows)
    got = exact_dedup.drop_copies(df, bits=bits)
    assert got.columns == df.columns
    left = plain(got)
    best = defaultdict(lambda: (1, True, NONE))
    for r in rows:
        best[normal(r[1])] = min(best[normal(r[1])], (-len(r[1] or ""), r[0] is None, r[0] or 0))
    assert {normal(r[1]): (-len(r[1] or ""), r[0] is None, r[0] or 0) for r in left} == dict(best)
    assert len(left) == len(best)


def test_exact_empty_and_native(spark):
    assert plain(exact_dedup.decide(empty(spark))) == [] and plain(exact_dedup.drop_copies(empty(spark))) == []
    plan = exact_dedup.decide(frame(spark, awkward()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ------------------------------------------------------------------- near

def shingle_set(text):
    w = bytes((text or "").encode()).lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def near_by_hand(rows):
    sets = [shingle_set(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = defaultdict(lambda: NONE)
    for i, r in enumerate(rows):
        least[find(i)] = min(least[find(i)], NONE if r[0] is None else r[0])
    out = []
    for i, r in enumerate(rows):
        c = least[find(i)]
        c = None if c == NONE else c
        out.append((r[0], len(sets[i]), c, r[0] == c))
    return sorted(out, key=str)


def near_copies(n=60):
    """One base with many one-word edits (linked through the base alone), a
    passage that many short texts share, and a chain of edits."""
    import random
    rng = random.Random(5)
    v = [f"w{i}" for i in range(4000)]
    base = [rng.choice(v) for _ in range(80)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            w[rng.randrange(len(w))] = rng.choice(v)
        rows.append((7 * i + 1, " ".join(w)))
    passage = [rng.choice(v) for _ in range(30)]
    for i in range(n):
        own = [rng.choice(v) for _ in range(rng.choice([0, 2, 4, 8, 30]))]
        rows.append((1000 + i, " ".join(passage + own)))
    chain = [rng.choice(v) for _ in range(60)]
    for i in range(20):
        chain = chain[2:] + [rng.choice(v), rng.choice(v)]
        rows.append((3000 - i, " ".join(chain)))
    return [(*r, "en", "a", 0, "", "", "", "") for r in rows]


def test_near_components(spark):
    for rows in (awkward(), near_copies()):
        assert sorted(plain(near_dedup.decide(frame(spark, rows))), key=str) == near_by_hand(rows)
    docs = documents(spark)
    assert sorted(plain(near_dedup.decide(docs)), key=str) == near_by_hand(plain(docs))
    assert plain(near_dedup.decide(empty(spark))) == []


def test_near_keeps_own_columns(spark):
    rows = awkward()
    df = frame(spark, rows)
    got = near_dedup.drop_near(df)
    assert got.columns == df.columns
    kept = {r[0] for r in near_by_hand(rows) if r[3]}
    assert {r[0] for r in plain(got)} - {None} == kept - {None}


def test_near_drops_rows_not_ids(spark):
    a, b, c = ([f"{x}{i}" for i in range(80)] for x in "abc")

    def edited(w):
        return " ".join([*w[:-1], "changed"])

    texts = [(1, " ".join(a)), (2, edited(a)), (2, " ".join(b)), (None, " ".join(c)), (None, edited(c)), (None, edited(a)),
             (3, " ".join(b)), (1, " ".join(a)), (None, ""), (None, None)]
    df = frame(spark, [(*r, "en", "a", n, "", "", "", "") for n, r in enumerate(texts)])
    got = sorted(((r[0], (r[1] or " ")[:1], r[4]) for r in plain(near_dedup.drop_near(df))), key=str)
    assert [g[:2] for g in got] == sorted([(1, "a"), (2, "b"), (None, "c"), (None, " "), (None, " ")], key=str)
    assert len({g[2] for g in got}) == 5


def test_texts_go_to_python_in_small_batches(spark, monkeypatch):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own, seen, write = spark.conf.get(name), {}, near_dedup.staged

    def spy(df, kind):
        seen[kind] = int(spark.conf.get(name))
        return write(df, kind)

    monkeypatch.setattr(near_dedup, "staged", spy)
    plain(near_dedup.drop_near(frame(spark, awkward())))
    assert seen["signed"] == seen["sets"] == common.TEXT_ROWS
    assert spark.conf.get(name) == own

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows]})

    with common.small_batches(spark, 100):
        got = [r["n"] for r in spark.range(0, 1000, 1, 1).mapInArrow(sizes, "n long").collect()]
        with common.small_batches(spark, 200):      # a smaller one stays
            assert spark.conf.get(name) == "100"
    assert sum(got) == 1000 and max(got) <= 100
    assert spark.conf.get(name) == own


def test_pipeline_sends_small_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own = spark.conf.get(name)
    try:
        corpus_pipeline.language_id(spark, empty(spark), "")
        assert int(spark.conf.get(name)) <= common.TEXT_ROWS
    finally:
        spark.conf.set(name, own)


def test_chance_to_miss_a_link():
    assert near_dedup.miss_chance() < 1e-6


def test_components(spark):
    import random
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000, i) for i in range(1001, 1300)]
    edges += [(2000 + i, 2001 + i) for i in range(40)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = dict(plain(components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {x: find(x) for x in root}
    assert plain(components(spark.createDataFrame([], "a long, b long"))) == []


# --------------------------------------------------------------- passages

def repeats_by_hand(rows, length=50):
    first = {}
    for r in rows:
        t, d = (r[1] or "").encode(), NONE if r[0] is None else r[0]
        for k in range(len(t) - length + 1):
            w = t[k:k + length]
            first[w] = min(first.get(w, NONE), d)
    out = []
    for r in rows:
        t, d = (r[1] or "").encode(), NONE if r[0] is None else r[0]
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - length + 1):
            if first[t[k:k + length]] < d:
                gone[k:k + length] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[False], gone]).astype(int)))
        out.append((r[0], len(t), edge[0::2].tolist(), edge[1::2].tolist(), bytes(b for b, g in zip(t, gone) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [2, suffix_dedup.HOT])
def test_repeated_passages(spark, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup.anchor_filter, "__defaults__", (hot,))
    monkeypatch.setattr(suffix_dedup.write_chunks, "__defaults__", (9000,))
    monkeypatch.setattr(suffix_dedup, "BUCKET_TEXT", 7000)
    rows = awkward()
    got = [(r[0], r[1], list(r[2]), list(r[3]), bytes(r[4])) for r in plain(suffix_dedup.remove_repeats(frame(spark, rows)))]
    assert sorted(got, key=str) == repeats_by_hand(rows)


@pytest.mark.parametrize("hot", [2, suffix_dedup.HOT])
def test_repeated_passages_in_parts(spark, hot, monkeypatch):
    # as above, with many parts to a bucket
    monkeypatch.setattr(suffix_dedup.anchor_filter, "__defaults__", (hot,))
    monkeypatch.setattr(suffix_dedup.write_chunks, "__defaults__", (9000,))
    monkeypatch.setattr(suffix_dedup, "PART_TEXT", 300)
    rows = awkward()
    got = [(r[0], r[1], list(r[2]), list(r[3]), bytes(r[4])) for r in plain(suffix_dedup.remove_repeats(frame(spark, rows)))]
    assert sorted(got, key=str) == repeats_by_hand(rows)


def test_a_bucket_is_sorted_in_parts(monkeypatch):
    """What is sorted at a time stays near ``PART_TEXT``, however much a bucket holds."""
    import random
    rng = random.Random(3)
    bases = [bytes(rng.randrange(97, 123) for _ in range(120)) for _ in range(200)]
    subs = sorted(rng.randrange(1 << 16) for _ in bases)
    chunks = []
    for chunk in range(3):
        held = [(sub, base[i:i + 60], rng.randrange(50)) for sub, base in zip(subs, bases)
                for i in rng.sample(range(60), 2) if rng.random() < 0.8]
        chunks.append((chunk, f"side-{chunk}", held))
    rows = pa.table({
        "chunk": [c for c, _, _ in chunks], "side": [s for _, s, _ in chunks],
        "at": [np.arange(len(h), dtype=np.int32).tobytes() for _, _, h in chunks],
        "subs": [np.array([x[0] for x in h], np.uint16).tobytes() for _, _, h in chunks],
        "pieces": [suffix_dedup._zip(b"".join(x[1] for x in h)) for _, _, h in chunks],
        "lens": [bytes(len(x[1]) for x in h) for _, _, h in chunks],
        "ids": [np.array([x[2] for x in h], np.int64).tobytes() for _, _, h in chunks]})
    first = {}
    for _, _, held in chunks:
        for _, p, i in held:
            for k in range(len(p) - 49):
                first[p[k:k + 50]] = min(first.get(p[k:k + 50], NONE), i)
    sizes, whole = [], suffix_dedup.smallest_ids
    monkeypatch.setattr(suffix_dedup, "smallest_ids", lambda pieces, ids: sizes.append(sum(map(len, pieces))) or whole(pieces, ids))
    monkeypatch.setattr(suffix_dedup, "PART_TEXT", 2000)
    out = suffix_dedup.resolve(rows)
    assert len(sizes) > 10 and max(sizes) < 3 * 2000
    for masks, (_, _, held) in zip(out["masks"].to_pylist(), chunks):
        assert np.frombuffer(masks, np.uint64).tolist() == [
            sum((first[p[k:k + 50]] < i) << k for k in range(len(p) - 49)) for _, p, i in held]


def test_repeated_passages_of_documents(spark):
    docs = documents(spark)
    got = [(r[0], r[1], list(r[2]), list(r[3]), bytes(r[4])) for r in plain(suffix_dedup.remove_repeats(docs))]
    assert sorted(got, key=str) == repeats_by_hand(plain(docs))
    assert plain(suffix_dedup.remove_repeats(empty(spark))) == []


def test_halves_of_equal_strings_are_of_one_context():
    import random
    rng = random.Random(2)
    base = [bytes(rng.choice(b"ab") for _ in range(90)) for _ in range(6)]
    texts = [b"".join(rng.sample(base, 3)) for _ in range(12)] + [b"a" * 120, b"short"]
    data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
    start, number, h, anchor = suffix_dedup.runs(data, ends)
    run, first, many, around = suffix_dedup.halves(data, start, number, anchor)
    back = suffix_dedup.joined(run, first, many)
    assert [x.tolist() for x in back] == [list(range(len(start))), start.tolist(), number.tolist()]
    of = {}
    for r, s, n, c in zip(run.tolist(), first.tolist(), many.tolist(), around.tolist()):
        for k in range(s, s + n):
            of.setdefault(data[k:k + 50].tobytes(), set()).add((int(h[r]), c))
    assert all(len(x) == 1 for x in of.values())
    held = {}
    for string, ((_, c),) in of.items():
        held.setdefault(c, []).append(string)
    # strings of one context have its 33 bytes in common
    assert all(any(all(x[i:i + 33] in y for y in strings) for i in range(18) for x in strings[:1]) for strings in held.values())


def test_what_repeats_by_chance_is_not_sent(spark, tmp_path):
    """Short phrases recur in many documents, one passage in two: only that is sent."""
    import random
    rng = random.Random(4)
    filler = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    passage = filler(70)
    rows = [(i, filler(60) + "a phrase that recurs" + filler(60) + (passage if i in (7, 30) else "")) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    folder = str(tmp_path)
    chunks = suffix_dedup.write_chunks(docs, folder, "doc_id", "text", 3000)
    bits = suffix_dedup.anchor_filter(chunks, 2, folder)
    contexts = suffix_dedup.context_filter(chunks, 2, folder, bits)
    sent = suffix_dedup.send_pieces(chunks, 2, folder, bits, contexts, 3).toPandas()
    texts = [suffix_dedup._unzip(x).decode() for x in sent["pieces"]]
    assert sent["chunk"].nunique() == 2 and not any("recurs" in t for t in texts)
    number = {}
    for first, raw, c in zip(sent["first"], sent["numbers"], sent["chunk"]):
        subs, lens, ids = suffix_dedup._numbers(raw, np.uint16, np.uint8, np.int64)
        assert (np.diff(subs.astype(int)) >= 0).all() and set(ids.tolist()) <= {7, 30}
        number.setdefault(c, []).extend(range(first, first + len(lens)))
    assert all(sorted(x) == list(range(len(x))) for x in number.values())
    got = [(r[0], r[1], list(r[2]), list(r[3]), bytes(r[4])) for r in plain(suffix_dedup.remove_repeats(docs))]
    assert sorted(got, key=str) == repeats_by_hand(rows)


def test_copies_leave_their_text_behind(spark):
    long, short = "all of this text is there three times, word by word, to the end" * 3, "short"
    rows = [(5, long), (3, long), (None, long), (8, short), (9, short), (10, "other"), (11, None), (12, None), (12, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    look, copies = suffix_dedup.split_copies(docs)
    assert sorted(plain(look), key=str) == sorted([(3, long), (8, short), (10, "other"), (11, None)], key=str)
    size = len(long.encode())
    assert sorted(((r[0], r[1], bytes(r[2])) for r in plain(copies)), key=str) == sorted(
        [(5, size, b""), (None, size, b""), (9, 5, b"short"), (12, 0, b""), (12, 0, b"")], key=str)
    assert copies.columns == ["doc_id", "n_bytes", "kept"]
    got = [(r[0], r[1], list(r[2]), list(r[3]), bytes(r[4])) for r in plain(suffix_dedup.remove_repeats(docs))]
    assert sorted(got, key=str) == repeats_by_hand(rows)


def test_numbers_are_sent_by_planes():
    a, b, c = np.arange(5, dtype=np.uint16) * 300, np.arange(5, dtype=np.uint8), np.array([-1, 0, 1 << 40, suffix_dedup.NO_ID, 7])
    got = suffix_dedup._numbers(suffix_dedup._planes(a, b, c), np.uint16, np.uint8, np.int64)
    assert [x.tolist() for x in got] == [a.tolist(), b.tolist(), c.tolist()]
    assert [len(x) for x in suffix_dedup._numbers(suffix_dedup._planes(a[:0], c[:0]), np.uint16, np.int64)] == [0, 0]


def test_expansion_groups_equal_strings():
    import random
    rng = random.Random(1)
    for _ in range(25):
        pieces = set()
        base = [bytes(rng.choice(b"abc") for _ in range(rng.choice([60, 200]))) for _ in range(4)] + [b"a" * 90]
        for _ in range(30):
            b = rng.choice(base)
            i = rng.randrange(0, len(b) - 50)
            p = bytearray(b[i:i + rng.randrange(50, 85)])
            if rng.random() < 0.5 and len(p) > 50:
                p[rng.randrange(len(p))] = rng.choice(b"abc\x00")
            if len(p) >= 50:
                pieces.add(bytes(p))
        pieces = list(pieces)
        ids = np.array([rng.randrange(100) for _ in pieces])
        first = {}
        for p, i in zip(pieces, ids):
            for k in range(len(p) - 49):
                first[p[k:k + 50]] = min(first.get(p[k:k + 50], NONE), i)
        _, least = suffix_dedup.smallest_ids(pieces, ids)
        assert least.tolist() == [first[p[k:k + 50]] for p in pieces for k in range(len(p) - 49)]


def test_words_helper_is_deterministic():
    import random
    assert words(random.Random(1), 3, ["a", "b"]) == words(random.Random(1), 3, ["a", "b"])
