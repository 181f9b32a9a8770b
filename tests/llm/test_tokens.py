import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quayside.llm import packing, token_binary
from quayside.llm.chunks import ChunkEncoder, tokenizer_path
from tests.llm.cases import awkward, documents, empty, frame, plain

PARTS = [" ", "  ", "\n", "\t", " \n", "a", "the", " the", "'s", "don't", ",", "é", "ß", "日本", "😀", "\x01", "é", "12",
         "\x00", "Σ", "ς", "İ", "́", "<|endoftext|>", "\x1c", "\x85", "ﬁ", "\r\n", "\xa0"]


def whole(name, end_id):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path(name))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [end_id]


@pytest.fixture(scope="module", params=[("byte_bpe_50k.json", 2), ("word_bpe_49k.json", 0)])
def both(request):
    name, end = request.param
    return ChunkEncoder(tokenizer_path(name), end), whole(name, end)


def test_chunks_give_what_the_whole_text_gives(both):
    encoder, expected = both

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.lists(st.sampled_from(PARTS), max_size=25).map("".join) | st.text(max_size=40) | st.none(), max_size=8))
    def check(texts):
        ids, ends = encoder.encode(texts)
        got = [x.tolist() for x in np.split(ids, ends)[:-1]]
        assert got == [expected(t) for t in texts]

    check()


@pytest.mark.parametrize("name, end, ids", [("byte_bpe_50k.json", 2, [64, 220, 50256, 275]), ("word_bpe_49k.json", 0, [320, 49407, 321])])
def test_added_tokens_as_in_a_plain_library_call(name, end, ids):
    from tokenizers import Tokenizer
    plain_call = Tokenizer.from_file(tokenizer_path(name))
    texts = ["a <|endoftext|> b", "the house", None, "<|startoftext|>the<|endoftext|>", "", "<|endoftext|>", "a <|ENDOFTEXT|> b", "the house"]
    got, ends = ChunkEncoder(tokenizer_path(name), end).encode(texts)
    got = [x.tolist() for x in np.split(got, ends)[:-1]]
    assert got == [plain_call.encode(t or "", add_special_tokens=False).ids + [end] for t in texts]
    assert got[0] == ids + [end]


def test_memos_that_are_full_change_nothing(monkeypatch):
    from quayside.llm import chunks
    monkeypatch.setattr(chunks, "BATCH_CHARS", 60)
    encoder = ChunkEncoder(tokenizer_path("byte_bpe_50k.json"), 2)
    encoder.first.most = encoder.rest.most = encoder.tokens.most = 5
    expected = whole("byte_bpe_50k.json", 2)
    texts = [r[1] for r in awkward()[:60]]
    ids, ends = encoder.encode(texts)
    assert [x.tolist() for x in np.split(ids, ends)[:-1]] == [expected(t) for t in texts]


def test_a_small_encoder_gives_the_same_ids_and_a_worker_keeps_one_state():
    from quayside.llm import chunks, common
    path = tokenizer_path("word_bpe_49k.json")
    assert all(small < usual for small, usual in zip(chunks.SMALL, (chunks.CHUNKS, chunks.TOKENS, chunks.BATCH_CHARS)))
    common.worker_state("other", 1, list)
    encoder = ChunkEncoder.shared(path, 0, (50, 50, 200))
    assert ChunkEncoder.shared(path, 0, (50, 50, 200)) is encoder and common.worker_state("other", 1, lambda: "made again") == "made again"
    texts = [f"{r[1] or ''} word{i} next{i}" for i, r in enumerate(awkward())]
    expected = whole("word_bpe_49k.json", 0)
    held = []
    for t in texts:
        ids, _ = encoder.encode([t])
        assert ids.tolist() == expected(t)
        held.append(max(len(encoder.first), len(encoder.rest), len(encoder.tokens)))
    assert max(held) <= 50 + max(len(t) for t in texts) < sum(map(len, texts))
    common.release_worker_state()


def test_the_pipeline_packs_with_small_memos(spark, monkeypatch):
    import corpus_pipeline
    from quayside.llm import chunks
    seen = []
    usual = packing.pieces
    monkeypatch.setattr(packing, "pieces", lambda *a: seen.append(a[-1]) or usual(*a))
    docs = frame(spark, awkward())
    small = plain(dict(corpus_pipeline.STAGES)["packing"](spark, docs, ""))
    assert seen == [chunks.SMALL]
    assert sorted(p[:5] for p in small if p[0] is not None) == sorted(
        p[:5] for p in plain(packing.pack_documents(docs)) if p[0] is not None)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([0, 1, 2, 3, 200, 50256, 2**29, 2**60 - 2, 2**60 - 1, 2**60, 2**64 - 1]) | st.integers(0, 2**64 - 1),
                max_size=400), st.integers(1, 50))
def test_codec_round_trip(values, block):
    v = np.array(values, np.uint64)
    words, offsets = token_binary.encode_words(v, block)
    assert len(offsets) == -(-len(v) // block)
    assert token_binary.decode_words(words, offsets, len(v), block).tolist() == values


def test_zeros_and_small_values_are_dense():
    words, _ = token_binary.encode_words(np.zeros(2400, np.uint64))
    assert len(words) == 10
    words, _ = token_binary.encode_words(np.full(4096 * 3, 30000, np.uint64))
    assert len(words) == 3 * 1024


def digest_by_hand(rows, name="byte_bpe_50k.json", end=2):
    expected, start, out = whole(name, end), 0, []
    for d, t in sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = expected(t)
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=str)


def test_files_hold_all_documents_in_order(spark, monkeypatch):
    rows = awkward()
    assert sorted(plain(token_binary.token_digest(frame(spark, rows))), key=str) == digest_by_hand(rows)
    docs = documents(spark)
    assert sorted(plain(token_binary.token_digest(docs)), key=str) == digest_by_hand(plain(docs))
    assert plain(token_binary.token_digest(empty(spark))) == []


def test_many_small_files(spark, tmp_path):
    rows = awkward()
    m = token_binary.write_ids(frame(spark, rows), str(tmp_path), tokenizer_path("byte_bpe_50k.json"), 2, file_ids=300)
    assert m.count() > 10
    got = token_binary.read_ids(m, str(tmp_path))
    expected = whole("byte_bpe_50k.json", 2)
    by_start = sorted(plain(got), key=lambda r: r[1])
    assert [r[3] for r in by_start] == [expected(t) for _, t in sorted(
        ((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))]


def check_packing(rows, packed, length=2048):
    expected = whole("word_bpe_49k.json", 0)
    want = []
    for r in rows:
        ids = expected(r[1])
        want += [(r[0], k, i, len(ids[i:i + length]), zlib.crc32(np.array(ids[i:i + length], "<u4").tobytes()))
                 for k, i in enumerate(range(0, len(ids), length))]
    assert sorted((p[:5] for p in packed), key=str) == sorted(want, key=str)
    bins = {}
    for p in packed:
        bins.setdefault(p[5], []).append((p[6], p[3]))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= length
    return len(bins), -(-sum(w[3] for w in want) // length)


def test_packing_keeps_every_piece(spark):
    rows = awkward()
    got = plain(packing.pack_documents(frame(spark, rows)))
    used, least = check_packing(rows, got)
    assert used <= least + 2
    docs = documents(spark)
    used, least = check_packing(plain(docs), plain(packing.pack_documents(docs)))
    assert used <= 1.03 * least + 1
    assert plain(packing.pack_documents(empty(spark))) == []


def test_open_bins_are_bounded_and_best_fit():
    bins = packing.OpenBins(10, 3)
    assert bins.put(6) == (0, 0) and bins.put(7) == (1, 0) and bins.put(8) == (2, 0)
    assert bins.put(3) == (1, 7)              # the fullest that fits
    assert bins.put(9) == (3, 0)              # three were open but one is full: room again
    assert bins.held == 3
    assert bins.put(10) == (4, 0)             # the fullest (free 1) closes
    assert bins.held == 2 and bins.put(1) == (2, 8)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=200), st.integers(1, 8))
def test_bins_never_overflow(sizes, most):
    bins, used = packing.OpenBins(32, most), {}
    for s in sizes:
        b, at = bins.put(s)
        assert used.get(b, 0) == at and at + s <= 32
        used[b] = at + s
        assert bins.held <= most
