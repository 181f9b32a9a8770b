import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest

from quayside.llm import langid, mixing, sharding, topk
from quayside.llm.html_extract import extract, main_text
from tests.llm.cases import F, awkward, documents, empty, frame, plain

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ----------------------------------------------------------------- mixing

def targets_by_hand(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Share by weight, stop at the cap, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    stopped, total = set(), sum(sizes.values()) * share
    while True:
        open_ = [s for s in order if s not in stopped]
        rest = total - sum(cap * sizes[s] for s in stopped)
        t = {s: cap * sizes[s] if s in stopped else rest * w[s] / sum(w[x] for x in open_) for s in order}
        over = {s for s in open_ if t[s] > cap * sizes[s]}
        if not over:
            return t
        stopped |= over


@pytest.mark.parametrize("range_rows", [7, mixing.RANGE_ROWS])
def test_mix_meets_its_targets(spark, monkeypatch, range_rows):
    monkeypatch.setattr(mixing, "RANGE_ROWS", range_rows)
    for df in (frame(spark, awkward()), documents(spark)):
        got = mixing.mix(df).collect()
        again = mixing.mix(df.repartition(3)).collect()
        assert sorted(map(str, got)) == sorted(map(str, again))
        sizes, taken, target = Counter(), Counter(), {}
        for r in got:
            sizes[r.source] += r.size
            taken[r.source] += r.taken
            target[r.source] = r.target
            assert 0 <= r.taken <= 2 * r.size and r.source_size >= r.size
        want = targets_by_hand(sizes)
        for s in sizes:
            assert target[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= 0.5001
        texts = Counter((r[0], len(WORD.findall(r[1] or ""))) for r in df.select("doc_id", "text").collect())
        assert texts == Counter((r.doc_id, r.size) for r in got)


def test_mix_prefers_heavy_documents(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text"), F.lit("a").alias("source"))
    good = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0).alias("weight"))
    got = mixing.mix(docs, share=0.2, quality=good).collect()
    picked = Counter(r.doc_id % 2 for r in got if r.taken)
    assert sum(picked.values()) == 800 and 0.70 < picked[0] / 800 < 0.85    # drawn at weights 4 and 1
    assert {r.epochs for r in got} == {0}


def test_materialised_mixture(spark):
    df = frame(spark, awkward())
    mixed = mixing.mix(df)
    rows = mixing.materialise(df, mixed)
    assert rows.columns == df.columns
    taken, words_ = Counter(), Counter()
    for r in mixed.collect():
        taken[r.source] += r.taken
    for r in rows.collect():
        words_[r.source] += len(WORD.findall(r.text or ""))
    assert +words_ == +taken
    assert plain(mixing.mix(empty(spark))) == [] and plain(mixing.materialise(empty(spark), mixing.mix(empty(spark)))) == []


# --------------------------------------------------------------- sharding

def test_null_ids_with_one_checksum_are_two_documents(spark):
    """Two texts of one CRC-32, both without an id."""
    texts = ["plumless and more", "buckeroo and more"]
    assert len({zlib.crc32(t.encode()) for t in ("plumless", "buckeroo")}) == 1
    texts = ["plumless", "buckeroo"]
    df = spark.createDataFrame([(None, t, "s") for t in texts], "doc_id long, text string, source string")
    got = Counter(r.text for r in mixing.materialise(df, mixing.mix(df, weights=(1,), share=2.0)).collect())
    assert got == {"plumless": 2, "buckeroo": 2}


def test_shards(spark):
    for df in (frame(spark, awkward()), documents(spark)):
        got = sharding.shard(df, 8).collect()
        texts = df.select("doc_id", "text").collect()
        assert Counter((r.doc_id, r.size) for r in got) == Counter((r.doc_id, len((r.text or "").encode()) + 1) for r in texts)
        by = defaultdict(list)
        for r in got:
            by[r.shard].append(r)
        assert all(sorted(r.slot for r in g) == list(range(len(g))) for g in by.values())
        load = [sum(r.size for r in by[s]) for s in range(8)]
        slots = Counter()
        for r in got:
            slots[r.vslot] += r.size
        assert max(load) - min(load) <= max(slots.values())
    assert plain(sharding.shard(empty(spark), 8)) == []


def test_map_versions(spark, tmp_path):
    sizes = [(v, 100 + v % 13, 1) for v in range(sharding.SLOTS)]
    first = sharding.assign(sizes, 8)
    sharding.store_map(spark, first, sizes, 0, str(tmp_path))
    grown = sharding.rebalance(first, sizes, 9)
    moved = {v for v in first if first[v] != grown[v]}
    assert moved and all(grown[v] == 8 for v in moved)          # one more shard takes slots only into itself
    load = Counter()
    for v, b, _ in sizes:
        load[grown[v]] += b
    assert max(load.values()) - min(load.values()) <= 112
    sharding.store_map(spark, grown, sizes, 1, str(tmp_path))
    assert {r.vslot: r.shard for r in sharding.load_map(spark, str(tmp_path), 0).collect()} == first
    assert {r.vslot: r.shard for r in sharding.load_map(spark, str(tmp_path), 1).collect()} == grown
    less = sharding.rebalance(grown, sizes, 8)
    assert set(less.values()) == set(range(8))
    heavy = [(0, 10_000, 5), *sizes[1:]]
    moved = sum(first[v] != s for v, s in sharding.rebalance(first, heavy, 8).items())
    assert 0 < moved < 200                                       # an edit, not a new deal


# ------------------------------------------------------------ language ID

@pytest.fixture(scope="module")
def vocabulary():
    return langid.Vocabulary(langid.tokenizer_path("piece_bpe_32k.model"))


@lru_cache
def all_pieces():
    """(piece -> id, bytes of each id)"""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=langid.tokenizer_path("piece_bpe_32k.model"))
    names = sp.id_to_piece(list(range(sp.get_piece_size())))
    byte = {i for i in range(3, 259) if sp.is_byte(i)}
    return ({n: i for i, n in enumerate(names) if i > 2 and i not in byte},
            np.array([0 if i < 3 else 1 if i in byte else len(n.encode()) for i, n in enumerate(names)]))


def segmentations(vocabulary, p, word):
    """The sum over all segmentations, one by one."""
    pieces, _ = all_pieces()
    text = langid.MARK + word
    logs = [np.zeros(p.shape[1])]                          # of the sum over the segmentations of the last characters
    for at in range(len(text) - 1, -1, -1):
        ways = [np.log(p[pieces[text[at:end]]]) + logs[len(text) - end] for end in range(at + 1, len(text) + 1) if text[at:end] in pieces]
        if text[at] not in pieces:
            ways.append(np.log(p[vocabulary.byte_ids(text[at])]).sum(axis=0) + logs[len(text) - at - 1])
        logs.append(np.logaddexp.reduce(ways))
    return logs[-1]


LONG = ["verylongwordwithoutanyspaceinit" * 2, "x" * 300, "ሰላምለዓለምሁሉይሁንእንዲህነውነገሩሁሉበሙሉ", "ab" + "ሰላም" * 30 + "the" * 20, "日本語テキスト" * 12, "a😀" * 40]


@pytest.mark.parametrize("skewed", [False, True])
def test_forward_sums_all_segmentations(vocabulary, skewed):
    p = np.random.default_rng(0).random((vocabulary.size, 3)) ** (12 if skewed else 1)
    p /= p.sum(axis=0)
    some = ["the", "erlich", "café", "日本", "x", "a😀b", "ñja.", "##", *LONG]
    got = langid.word_scores(vocabulary, p, some)
    assert np.allclose(got, [segmentations(vocabulary, p, w) for w in some], rtol=1e-9)


def test_words_of_any_length_and_script_teach(vocabulary):
    """The uses of all pieces account for every character, from the uniform start on."""
    p = np.full((vocabulary.size, 1), 1 / vocabulary.size)
    _, width = all_pieces()
    for words in ([w] for w in LONG):
        uses = langid.expected_counts(vocabulary, p, words, np.array([2.0]))
        assert (uses * width).sum() == pytest.approx(2 * sum(len((langid.MARK + w).encode()) for w in words), rel=1e-6)
    uses = langid.expected_counts(vocabulary, p, LONG, np.full(len(LONG), 2.0))
    assert (uses * width).sum() == pytest.approx(2 * sum(len((langid.MARK + w).encode()) for w in LONG), rel=1e-6)


def test_expected_counts_are_the_gradient(vocabulary):
    p = np.random.default_rng(1).random((vocabulary.size, 1))
    p /= p.sum()
    some, n = ["the", "lichkeit", "über"], np.array([3.0, 1.0, 2.0])
    uses = langid.expected_counts(vocabulary, p, some, n)
    for piece in np.flatnonzero(uses > 1e-3)[:12]:
        q = p.copy()
        q[piece] *= 1 + 1e-6
        slope = ((langid.word_scores(vocabulary, q, some) - langid.word_scores(vocabulary, p, some))[:, 0] * n).sum() / 1e-6
        assert slope == pytest.approx(uses[piece], rel=1e-3)


def test_words():
    assert [len(w) for w in langid.words_of("ab " + "x" * 70)] == [2, 70]
    assert langid.words_of("") == [] and not langid.has_letter("12 !") and langid.has_letter("é")


def test_held_out_accuracy_and_edge_cases(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    import zlib
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = langid.identify(docs.withColumn("held_out", langid.held_out(F.col("doc_id"))), carry=["doc_id", "held_out"]).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    test = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in test) >= 0.98 * len(test)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_of_awkward_rows(spark):
    df = frame(spark, awkward())
    got = langid.identify(df, carry=["doc_id", "text"]).collect()
    assert len(got) == len(awkward())
    for r in got:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and 0 <= r.score <= 1
    assert plain(langid.identify(empty(spark), carry=["doc_id"])) == []
    nothing = langid.identify(df.withColumn("lang", F.lit(None).cast("string")), carry=["doc_id"]).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}


def test_held_out_rows_teach_nothing(spark):
    df = frame(spark, awkward())
    other = df.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    a = langid.identify(df, carry=["doc_id"])
    b = langid.identify(other, carry=["doc_id"])
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


# ------------------------------------------------------------------- HTML

ARTICLE = "<h1>A headline</h1><p>First paragraph, with commas, and words.</p><p>Second &amp; last,\n of   it.</p>"
TEXT = "A headline\nFirst paragraph, with commas, and words.\nSecond & last, of it."


@pytest.mark.parametrize("page", [
    f"<html><body><nav><ul><li><a href=x>Home</a></ul></nav><article>{ARTICLE}</article><footer>&copy; 2020, all, rights</footer></body>",
    f"<div class='menu'><a>One</a> <a>Two</a></div><div id=content>{ARTICLE}</div><div class=sidebar><p>Links, more, links.</p></div>",
    f"<header><h1>The Site, of, commas</h1></header><main>{ARTICLE}<aside>Aside, text, here.</aside></main>",
    f"<body><div><div class=post>{ARTICLE}</div><div class='comments'><p>Nice, post, there, friend, I liked it.</p></div></div>",
    f"<article>{ARTICLE}<script>var a='<p>no, no</p>';</script><style>p{{}}</style><form><p>Your, mail</p><input></form></article>",
    f"<div class=cookie-notice><p>We, use, cookies, on, this, site.</p></div><article>{ARTICLE}</article>",
    f"<!-- <p>no</p> --><article>{ARTICLE.replace('</p>', '')}</article>",
    f"<article>{ARTICLE}<ul class=related><li><a href=1>Related one</a><li><a href=2>Related two</a><li><a href=3>Related three</a></ul></article>",
    f"<main><div>{ARTICLE}</div><ul><li><a href=1>Related one</a><li><a href=2>Related two</a><li><a href=3>Related three</a></ul></main>",
    f"<article>{ARTICLE}</article><div class='ad'>Buy, this, now, please, it, is, cheap.",
    f"<ARTICLE>{ARTICLE.replace('<p>', '<P CLASS=x>')}<a href='unclosed",
    f"<body><div role=dialog><p>Sign, up, now.</p></div><section><article>{ARTICLE}</article></section></body>",
])
def test_article_is_found(page):
    assert main_text(page) == TEXT


LONG = "".join(f"<p>Paragraph {i}, of the long part, has commas, and many words in it, as articles do.</p>" for i in range(40))
BODY = LONG.replace("<p>", "").replace("</p>", "\n")


@pytest.mark.parametrize("page, text", [
    (f"<body><article><h1>Title</h1><section>{LONG}</section><section><h2>Second</h2><p>Short.</p></section></article>",
     f"Title\n{BODY}Second\nShort."),
    (f"<main><article><header><h1>Title</h1><p>By A.</p></header><div class=entry-content>{LONG}</div><h2>Notes</h2>"
     "<blockquote>Said so.</blockquote><pre>x = 1</pre><ul><li>one</li></ul><table><tr><td>cell</table>"
     "<figure><figcaption>A figure</figcaption></figure></article></main>",
     f"Title\nBy A.\n{BODY}Notes\nSaid so.\nx = 1\none\ncell\nA figure"),
    (f"<body><div id=w><h1>Title</h1><div>{LONG}</div><h2>More</h2><div><p>Short.</p></div></div><div><a>Home</a> <a>About</a> <a>Us</a></div>",
     f"Title\n{BODY}More\nShort."),
    (f"<article><div>{LONG}</div><h2>References</h2><ol><li><a>Ref one</a></li><li><a>Ref two</a></li><li><a>Ref three</a></li></ol></article>",
     f"{BODY}References\nRef one\nRef two\nRef three"),
    (f"<article>{LONG}<table><tr><td><a>A</a><td><a>B</a><td><a>C</a></table></article>", f"{BODY}A\nB\nC"),
    (f"<article><div>{LONG}</div><div><a>Read on</a></div></article>", BODY.rstrip()),
])
def test_the_whole_article_is_kept(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("name", ["overflow-hidden", "content no-sidebar", "has-header", "elementor-widget", "post-with-comments",
                                  "form-page", "widget", "sidebar", "layout-menu modal"])
def test_a_wrapper_s_name_keeps_the_article(name):
    for inner in (f"<article>{ARTICLE}</article>", f"<main>{ARTICLE}</main>", f"<div>{ARTICLE}</div>"):
        for attribute in ("class", "id"):
            page = f"<body><nav>Home</nav><div {attribute}='{name}'>{inner}</div><div class=footer>All, rights.</div></body>"
            assert main_text(page) == TEXT


@pytest.mark.parametrize("name", ["overflow-hidden", "no-sidebar", "has-header", "elementor-widget", "post-with-comments",
                                  "entry-header", "article-header"])
def test_a_part_s_name_keeps_the_part(name):
    page = f"<article>{LONG}<div class='{name}'><p>A part, of the article.</p></div></article>"
    assert main_text(page) == f"{BODY}A part, of the article."


@pytest.mark.parametrize("name", ["sidebar", "site-footer", "main-nav", "nav-links", "cookie-notice", "comment-list", "post-comments",
                                  "commentsArea", "related-posts", "ad-slot", "text-ad", "search-form", "widget", "visually-hidden"])
def test_other_names_are_left_out(name):
    assert main_text(f"<article>{ARTICLE}<div class='{name}'><p>Some, other, text.</p></div></article>") == TEXT
    many = "<article><p>I, for one, liked it.</p></article>" * 9
    assert main_text(f"<div class=post>{ARTICLE}</div><div class=comments>{many}</div>") == TEXT


def test_a_form_around_the_page_and_a_second_look():
    assert main_text(f"<form id=aspnetForm><div class=menu><a>Home</a></div><div>{ARTICLE}</div></form>") == TEXT
    assert main_text("<div class=notice>Only this.</div>") == "Only this."
    assert main_text("<div class=comments><a>Only a link</a></div>") == "Only a link"


@pytest.mark.parametrize("part, text", [
    ('<p>See <a href="/blog/the-hidden-cost">the linked words</a>, they, say.</p>', "See the linked words, they, say."),
    ('<section aria-label="Hidden costs"><p>A section, kept.</p></section>', "A section, kept."),
    ('<p title="a hidden gem">A titled, paragraph.</p>', "A titled, paragraph."),
    ('<div data-hidden="false"><p>Some, data.</p></div>', "Some, data."),
    ('<div data-class="sidebar"><p>More, data.</p></div>', "More, data."),
    ("<p data-x='class=comment' title=\"id='nav'\">Quoted, values.</p>", "Quoted, values."),
    ('<ul><li><a href="/1">First cited work</a></li><li><a href="/2">Second one</a></li><li><a href="/3">Third one</a></li></ul>',
     "First cited work\nSecond one\nThird one"),
])
def test_a_value_is_not_an_attribute(part, text):
    assert main_text(f"<html><body><nav>Home</nav><article>{ARTICLE}{part}</article></body></html>") == f"{TEXT}\n{text}"


@pytest.mark.parametrize("attribute", ["hidden", 'HIDDEN=""', 'style="display:none"', "aria-hidden=true", 'class="x comments"', "id = 'sidebar'"])
def test_real_attributes_count(attribute):
    assert main_text(f"<article>{ARTICLE}<div title='y' {attribute}><p>Not, this.</p></div></article>") == TEXT


def test_inline_markup_stays_in_its_block():
    assert main_text("<article><p>One <b>bold</b>, <i>two</i><br>three &lt;4 &eacute;&#233;&#xe9; 5 < 6</p></article>") \
        == "One bold, two three <4 ééé 5 < 6"
    assert main_text("<article><p>un<b>bro</b>ken</p><ul><li>one</li><li>two</li></ul><table><tr><td>a<td>b</table></article>") \
        == "unbroken\none\ntwo\na\nb"


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<") .replace("<", "") == ""
    assert main_text("<html><body></body></html>") == "" and main_text("<script>x") == ""
    assert main_text("just text, no tags") == "just text, no tags"
    deep = "<div>" * 30_000 + "<p>deep, text</p>"
    assert main_text(deep) == "deep, text"
    long = "<article>" + "<p>word, word</p>" * 30_000
    assert main_text(long).count("\n") == 29_999
    assert main_text("<p " + "a=\"" * 20_000) == ""


def test_pages_table(spark):
    rows = [(1, "u", f"<article>{ARTICLE}</article>", "x"), (2, None, None, "y"), (None, "v", "", None), (1, "u", f"<article>{ARTICLE}</article>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(plain(extract(df)), key=str)
    assert got == sorted([(1, "u", TEXT, len(TEXT))] * 2 + [(2, None, "", 0), (None, "v", "", 0)], key=str)
    assert plain(extract(df.limit(0))) == []


# ------------------------------------------------------------------ top-k

def top_by_hand(rows, k, every):
    good = [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    good = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in good]
    out = []
    for a, (q, u) in enumerate(good):
        if q is None or q % every:
            continue
        scored = [(-sum(x * y for x, y in zip(u, v)), i is None, i or 0) for b, (i, v) in enumerate(good) if a != b]
        out += [(q, n + 1, None if z else i, -s) for n, (s, z, i) in enumerate(sorted(scored)[:k])]
    return Counter(out)


@pytest.mark.parametrize("block", [40, topk.BLOCK])
def test_top_k_is_exact(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "PAGE", 8)
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(6, 12))
    rows = [(i, (centre[i % 6] + 0.1 * rng.normal(size=12)).tolist()) for i in range(300)]
    rows += [(400 + i, rows[5][1]) for i in range(40)]                      # ties
    rows += [(20, rows[3][1]), (20, rows[3][1]), (None, rows[4][1]), (600, None), (620, [1.0, None]), (640, [float("nan")] * 12),
             (660, [float("inf")] * 12), (680, []), (700, [0.5] * 3), (720, [0.25] * 20), (740, [0.0] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x")).repartition(3)
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, 7, block=block)
    assert Counter(plain(got)) == top_by_hand(rows, 7, 20)


def test_top_k_of_few_or_huge_vectors(spark):
    rows = [(0, [1e30, 2.0]), (20, [-1e30, 1.0]), (3, [1e10, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [r[:3] for r in sorted(plain(topk.top_k(df, F.col("vec_id") % 20 == 0, 5)))]
    assert got == [(0, 1, 3), (0, 2, 20), (20, 1, 0), (20, 2, 3)]      # two scores below the range of a long are equal
    assert plain(topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0, 5)) == []
    assert plain(topk.top_k(df.filter("vec_id = 0"), F.col("vec_id") % 20 == 0, 5)) == []


def test_tree_leaves_out_most_of_a_clustered_set():
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(40, 16)) * 200
    points = np.floor(centre[rng.integers(0, 40, 6000)] + rng.normal(size=(6000, 16)) * 5)
    ids = np.arange(6000)
    tree = topk.Tree(topk.build(points, ids, ids, np.zeros(6000, np.int64)))
    for q in range(0, 6000, 500):
        got = sorted(((s, -v) for s, _, v, _ in tree.search(points[q], q, 20)), key=lambda x: (-x[0], x[1]))
        scores = points @ points[q]
        want = sorted(((scores[i], i) for i in range(6000) if i != q), key=lambda x: (-x[0], x[1]))[:20]
        assert got == want
    assert tree.computed < 0.5 * 12 * 6000
