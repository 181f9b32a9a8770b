import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from quayside.llm import token_align
from quayside.llm.chunks import tokenizer_path
from tests.llm.cases import F, awkward, documents, empty, frame, plain

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
PARTS = [" ", "  ", "\n", "\t", " \n", "a", "the", " the", "'s", "don't", ",", "é", "ß", "日本", "😀", "\x01", "é", "12", "\x00", "Σ", "İ", "́",
         "<|endoftext|>", "\x1c", "\x85", "ﬁ", "\r\n", "\xa0", "▁", "<s>", "</s>", "<unk>", "<0x41>", "Ġ", " ", "　", "thinking", "unbelievable"]


@pytest.fixture(scope="module")
def brute():
    """Groups and links of a text: every pair of tokens compared."""
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    chars = token_align.byte_level()

    def piece(i):
        s = b.id_to_piece(i)
        return bytes([int(s[3:5], 16)]) if b.is_byte(i) else s.replace("▁", " ").encode()

    def spans(tokens):
        out, at = [], 0
        for i, x in tokens:
            out.append((i, at, at + len(x)))
            at += len(x)
        return out

    def run(text):
        if not text:
            return None
        raw = (" " + text).encode()
        ta = [(i, bytes(chars[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        tb = [(i, piece(i)) for i in b.encode(text)]
        if b"".join(x for _, x in ta) != raw or b"".join(x for _, x in tb) != raw:
            return None
        sa, sb = spans(ta), spans(tb)
        groups, low = [], 0
        for end in sorted({e for _, _, e in sa} & {e for _, _, e in sb}):
            groups.append("|".join(",".join(str(i) for i, s, e in side if low <= s and e <= end) for side in (sa, sb)))
            low = end
        return len(sa), len(sb), groups, [(i, j) for i, s, e in sa for j, s2, e2 in sb if s < e2 and s2 < e]

    return run


def digest(rows, brute):
    found = [brute(t) for _, t in rows]
    docs = Counter(x for f in found if f for x in set(f[3]))
    most = {}
    for (a, _), n in docs.items():
        most[a] = max(n, most.get(a, 0))
    out = []
    for (d, _), f in zip(rows, found):
        if f is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = f
        out.append((d, n_a, n_b, len(groups), len(links), sum(docs[x] == most[x[0]] for x in links), sum(docs[x] for x in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out, key=str)


def short(rows):
    """The brute force compares every pair of tokens: very long texts only once."""
    return [(r[0], r[1] if r[1] is None or len(r[1]) < 2500 else r[1][:2500]) for r in rows]


def test_bytes_of_the_characters():
    m = token_align.byte_level()
    assert sorted(m.values()) == list(range(256)) and m["a"] == 97 and m["Ġ"] == 32 and m["Ċ"] == 10


def test_chunks_give_the_groups_of_the_whole_text(brute):
    rng = random.Random(3)
    texts = [None, ""] + ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 14))) for _ in range(1500)]
    aligner = token_align.Aligner(A, B, most=200)                  # trimmed again and again
    for at in range(0, len(texts), 37):
        part = texts[at:at + 37]
        numbers, groups, (ends, pairs, times) = aligner.align(part)
        links = [list(zip(p.tolist(), t.tolist())) for p, t in zip(np.split(pairs, ends), np.split(times, ends))]
        for text, n, g, found in zip(part, numbers.tolist(), groups, links):
            w = brute(text)
            if w is None:
                assert (n, g, found) == ([0] * 4, b"", [])
            else:
                assert n == [w[0], w[1], len(w[2]), len(w[3])] and g.decode() == ";".join(w[2])
                assert found == sorted(Counter(i * 32000 + j for i, j in w[3]).items())


def test_coalesce_by_hand():
    # A: ab|cde|f    B: abc|d|e|f
    a, b = np.array([2, 5, 6]), np.array([3, 4, 5, 6])
    ga, gb, la, lb = token_align.coalesce(np.array([0, 2, 5]), a, np.array([0, 3, 4, 5]), b)
    assert ga.tolist() == [0, 0, 1] and gb.tolist() == [0, 0, 0, 1]
    assert list(zip(la.tolist(), lb.tolist())) == [(0, 0), (1, 0), (1, 1), (1, 2), (2, 3)]


@pytest.mark.parametrize("hot", [token_align.HOT, 3, 0])
def test_counts_over_all_documents(spark, brute, hot):
    rows = short(awkward()) + [(9000, "a▁b"), (9001, "<|endoftext|> the <s>")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(plain(token_align.align_digest(df, hot=hot)), key=str) == digest(rows, brute)


def test_long_texts_and_real_documents(spark, brute):
    aligned = token_align.align(frame(spark, awkward()), carry=["doc_id", "kept", "size"], keep_groups=True)
    got = {r.doc_id: r for r in aligned.collect()}
    assert aligned.count() == len(awkward()) and got[5004].n_a >= 9000
    assert hashlib.sha256(got[5004].groups.encode()).hexdigest() == got[5004].groups_sha256
    assert (got[5000].groups_sha256, got[5000].groups, got[5000].n_links) == ("", "", 0)
    rows = [(r.doc_id, r.text) for r in documents(spark).where(F.length("text") < 1500).limit(60).collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(plain(token_align.align_digest(df)), key=str) == digest(rows, brute)


def test_empty_tables_and_clashes(spark):
    assert plain(token_align.align_digest(empty(spark))) == []
    assert [r[1:] for r in plain(token_align.align_digest(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")))] == [(0, 0, 0, 0, 0, 0, "")] * 2
    with pytest.raises(ValueError):
        token_align.align(empty(spark).withColumn("n_a", F.lit(1)), carry=["doc_id", "n_a"])
