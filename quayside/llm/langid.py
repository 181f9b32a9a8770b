"""Language ID with segmentation-marginalised unigrams.

The vocabulary is that of a public piece tokenizer and stays fixed.  Each
language has a probability for every piece, and a word's likelihood is the
sum over all its segmentations into pieces, found by a forward pass (the
pieces of a word start at its word mark; no piece crosses white space).  A
character without a piece of its own stands for its UTF-8 byte pieces.  A
text's likelihood is the product over its words; the prediction is the
language with the highest one (ties: the first by code point) and the score
its posterior under equal priors.

Learning is expectation-maximisation over the words of all training texts:
words are counted by language, and ``ROUNDS`` times every word spreads its
count over pieces by the posterior of its segmentations (forward-backward).
Counts grow with the corpus; the model itself has one number for each piece
and language, so it fits the driver and every task.

Words are the lower-cased runs without white space, whole however long they
are.  Forward and backward sums are scaled at every position where they get
small, so no likelihood leaves the range of a double, and the rarest word of
the longest script teaches and scores like any other.

Edge cases: a text that is null or has no letter is ``und`` with score 0, and
so is every text if nothing could be learned; a null id belongs to the
training side; rows without a text or language teach nothing; equal rows
count as often as they are there.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.chunks import tokenizer_path
from quayside.llm.common import staged, trim_worker, worker_state

ROUNDS = 2
MARK = "▁"
SMOOTH = 0.1
#: Sums below this are scaled up.  A character's pieces, or its bytes' together, are likelier than 1e-60.
SMALL = 1e-100
#: Code points of words that are looked at together.
BLOCK_POINTS = 140_000
#: Distinct words that a task holds at once.
HELD_WORDS = 200_000
#: Words whose scores a worker keeps.
MEMO_WORDS = 300_000
#: Words of a language that a learning task looks at together.
EM_WORDS = 50_000


def words_of(text: str) -> list[str]:
    return text.lower().split()


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


class Vocabulary:
    """The pieces, by length, as sorted hashes of their code points."""

    def __init__(self, model_file: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.size = sp.get_piece_size()
        self.bytes = np.full(256, -1, np.int64)
        by_len: dict[int, list[tuple[int, int]]] = {}
        for i in range(self.size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                *_, (_, h) = self._hashes(_points([piece]), len(piece))
                by_len.setdefault(len(piece), []).append((int(h[0, 0]), i))
        self.table = {}
        for n, rows in by_len.items():
            rows.sort()
            self.table[n] = (np.array([h for h, _ in rows], np.uint64), np.array([i for _, i in rows], np.int64))
        self.longest = max(self.table)

    @staticmethod
    def _hashes(points: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
        """(n, 64-bit hashes of all windows of n code points in each row), n ascending."""
        h = np.full(points.shape, 0x51ED270B, np.uint64)
        for n in range(1, min(longest, points.shape[1]) + 1):
            wide = points.shape[1] - n + 1
            h = (h[:, :wide] ^ points[:, n - 1:n - 1 + wide]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            yield n, h

    def lattice(self, points: np.ndarray) -> tuple[dict[int, np.ndarray], list[str]]:
        """For rows of equally many code points: by length, the id of the piece
        that starts at each place (``size`` and above: the characters that
        are returned, -1: none)."""
        found = {}
        for n, h in self._hashes(points, self.longest):
            if n in self.table:
                hashes, ids = self.table[n]
                at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                found[n] = np.where(hashes[at] == h, ids[at], -1)
        single = found.get(1)
        if single is None:
            single = np.full(points.shape, -1, np.int64)
        odd, back = np.unique(points[single < 0], return_inverse=True)
        single[single < 0] = self.size + back
        found[1] = single
        return found, [chr(c) for c in odd.tolist()]

    def byte_ids(self, char: str) -> np.ndarray:
        return self.bytes[list(char.encode("utf-8", "surrogatepass"))]


def _points(words: list[str]) -> np.ndarray:
    raw = "".join(words).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, "<u4").reshape(len(words), -1).astype(np.uint64)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places in ``words``, code points with the word mark, their numbers), by
    like length: rows of up to 40 code points have the same, longer ones are
    filled up by at most a quarter."""
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 1
    order = np.argsort(lens, kind="stable")
    step = np.where(lens > 40, np.ceil(np.log(np.maximum(lens, 1) / 40) / np.log(1.25)) + 40, lens)[order]
    edges = np.flatnonzero(np.diff(step)) + 1
    for run in np.split(order, edges) if len(order) else []:
        wide = int(lens[run].max())
        rows = max(1, BLOCK_POINTS // wide)
        for i in range(0, len(run), rows):
            at = run[i:i + rows]
            yield at, _points([(MARK + words[k]).ljust(wide) for k in at]), lens[at]


def _extended(vocabulary: Vocabulary, p: np.ndarray, odd: list[str]) -> np.ndarray:
    """Piece probabilities (pieces x languages) with rows for characters made of byte pieces, and a last row of zeros."""
    extra = [np.prod(p[vocabulary.byte_ids(c)], axis=0) for c in odd]
    return np.vstack([p, *extra, np.zeros((1, p.shape[1]))])


def _add(total: np.ndarray, q: np.ndarray, ids: np.ndarray, rest: np.ndarray) -> None:
    """``total += q[ids] * rest``, on the words that have a piece here if they are few."""
    own = np.flatnonzero(ids >= 0)
    if 2 * len(own) > len(ids):
        total += q[ids] * rest
    elif len(own):
        total[own] += q[ids[own]] * rest[own]


def _sums(steps: dict[int, np.ndarray], q: np.ndarray, lens: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """(sums, logs): the likelihood of the first j characters of each row is
    ``sums[j] * exp(logs[j])``, both (wide + 1, rows, languages).
    ``steps[k][:, j]``: the piece of k characters that ends behind character j."""
    n, g = len(lens), q.shape[1]
    sums, logs = np.zeros((wide + 1, n, g)), np.zeros((wide + 1, n, g))
    sums[0] = 1
    longest = max(steps)
    window = {0: sums[0]}                   # the last sums, on the scale of the newest
    for j in range(1, wide + 1):
        total = np.zeros((n, g))
        for k, ids in steps.items():
            if k <= j:
                _add(total, q, ids[:, j - 1], window[j - k])
        window.pop(j - longest, None)
        window[j] = total
        logs[j] = logs[j - 1]
        small = total < SMALL
        if small.any():
            # what would leave the range lies before characters without pieces, which no piece crosses: never used again
            factor = np.where(small, 1 / SMALL, 1.0)
            window = {i: np.minimum(w * factor, 1e300) for i, w in window.items()}
            logs[j] += np.where(small, np.log(SMALL), 0.0)
        sums[j] = window[j]
    return sums, logs


def _ending(found: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Pieces by the place where they end, from pieces by the place where they start."""
    out = {}
    for k, ids in found.items():
        out[k] = np.full((len(ids), ids.shape[1] + k - 1), -1, np.int64)
        out[k][:, k - 1:] = ids
    return out


def _log(sums: np.ndarray, logs: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(sums) + logs


def word_scores(vocabulary: Vocabulary, p: np.ndarray, words: list[str]) -> np.ndarray:
    """Log likelihoods, (words, languages)."""
    out = np.zeros((len(words), p.shape[1]))
    for at, points, lens in _by_length(words):
        found, odd = vocabulary.lattice(points)
        sums, logs = _sums(_ending(found), _extended(vocabulary, p, odd), lens, points.shape[1])
        rows = np.arange(len(at))
        out[at] = _log(sums[lens, rows], logs[lens, rows])
    return out


def expected_counts(vocabulary: Vocabulary, p: np.ndarray, words: list[str], counts: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in the words of one language; ``p``: (pieces, 1)."""
    out = np.zeros(vocabulary.size)
    for at, points, lens in _by_length(words):
        n, wide = points.shape
        found, odd = vocabulary.lattice(points)
        q = _extended(vocabulary, p, odd)
        steps = _ending(found)
        ahead = _log(*_sums(steps, q, lens, wide))[:, :, 0]
        # backward sums are forward sums of the rows read from their ends
        rows, back = np.arange(n)[:, None], lens[:, None] - 1 - np.arange(wide)
        turned = {}
        for k, ids in found.items():
            # a piece that starts at i ends, from behind, at character len - i
            start = back
            turned[k] = np.where((start >= 0) & (start < ids.shape[1]), ids[rows, np.clip(start, 0, ids.shape[1] - 1)], -1)
            turned[k][start + k > lens[:, None]] = -1
        behind = _log(*_sums(turned, q, lens, wide))[:, :, 0]
        whole = ahead[lens, np.arange(n)]
        more = np.zeros(vocabulary.size + len(odd) + 1)
        with np.errstate(divide="ignore"):
            log_q = np.log(q[:, 0])
        for k, ids in found.items():
            row, i = np.nonzero(ids >= 0)
            own = i + k <= lens[row]
            row, i = row[own], i[own]
            piece = ids[row, i]
            use = np.exp(ahead[i, row] + log_q[piece] + behind[lens[row] - i - k, row] - whole[row]) * counts[at[row]]
            more[:-1] += np.bincount(piece, use, minlength=len(more) - 1)
        out += more[:vocabulary.size]
        for c, n_uses in zip(odd, more[vocabulary.size:-1]):
            np.add.at(out, vocabulary.byte_ids(c), n_uses)
    return out


@dataclass
class Model:
    langs: list[str]
    p: np.ndarray            # (pieces, languages)
    model_file: str


def held_out(id_col: Column) -> Column:
    """CRC-32 of the id as text, mod 3, is 1; a null id is not held out."""
    return F.coalesce(F.crc32(F.encode(id_col.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def count_words(labelled: DataFrame) -> DataFrame:
    """(lang, word, n) over all texts of (lang, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def out():
            for lang, c in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())],
                    names=["lang", "word", "n"])
            counts.clear()

        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    counts.setdefault(lang, Counter()).update(words_of(text))
                if sum(map(len, counts.values())) > HELD_WORDS:
                    yield from out()
        yield from out()
        trim_worker()

    seen = labelled.mapInArrow(run, "lang string, word string, n long")
    return seen.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def learn(labelled: DataFrame, model_file: str, rounds: int = ROUNDS) -> Model:
    """The model of all rows of ``labelled`` (lang, text)."""
    counts = staged(count_words(labelled.filter("lang IS NOT NULL AND text IS NOT NULL")), "lang_words")
    langs = sorted(r.lang for r in counts.select("lang").distinct().collect())
    size = Vocabulary(model_file).size
    p = np.full((size, len(langs)), 1.0 / size)
    for _ in range(rounds if langs else 0):
        held = p

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocabulary = Vocabulary(model_file)
            got = np.zeros((len(langs), size))
            words: list[list[str]] = [[] for _ in langs]
            counts_: list[list[int]] = [[] for _ in langs]

            def spend(g: int) -> None:
                if words[g]:
                    got[g] += expected_counts(vocabulary, held[:, g:g + 1], words[g], np.array(counts_[g], float))
                    words[g], counts_[g] = [], []

            place = {k: g for g, k in enumerate(langs)}
            for b in batches:       # many words together, so that those of one length come in large groups
                for k, w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                    words[place[k]].append(w)
                    counts_[place[k]].append(n)
                for g in range(len(langs)):
                    if len(words[g]) >= EM_WORDS:
                        spend(g)
            for g in range(len(langs)):
                spend(g)
            for g, k in enumerate(langs):
                used = np.flatnonzero(got[g])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k] * len(used), pa.string()), pa.array(used.astype(np.int64)), pa.array(got[g][used])],
                    names=["lang", "piece", "uses"])
            trim_worker()

        # sums of at most pieces x languages rows, whatever the corpus
        uses = (counts.mapInArrow(run, "lang string, piece long, uses double")
                .groupBy("lang", "piece").agg(F.sum(F.round("uses", 6).cast("decimal(38,6)")).cast("double").alias("uses"))
                .toPandas())
        p = np.full((size, len(langs)), SMOOTH)
        at = uses["lang"].map({k: g for g, k in enumerate(langs)}).to_numpy()
        p[uses["piece"].to_numpy(), at] += uses["uses"].to_numpy()
        p /= p.sum(axis=0)
    return Model(langs, p, model_file)


def predict(docs: DataFrame, model: Model, carry: list[str], text_col: str = "text") -> DataFrame:
    """The carried columns with ``lang_pred`` and ``score``."""
    # a text that is carried is sent to the workers once
    wanted = docs.select(*[F.col(f"`{c}`") for c in carry], *([] if text_col in carry else [F.col(text_col).alias("_text")]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.schema.fields[:len(carry)])
    at = carry.index(text_col) if text_col in carry else len(carry)
    langs, p, file = model.langs, model.p, model.model_file

    model_id = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a worker keeps the words that it has scored under this model between its tasks
        kept = worker_state("words", model_id, lambda: {"vocabulary": Vocabulary(file), "memo": {}, "scores": np.zeros((0, len(langs)))})
        vocabulary, memo, scores = kept["vocabulary"], kept["memo"], kept["scores"]
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                texts = part.column(at).to_pylist()
                words, ends = [], []
                for t in texts:
                    if t and langs and has_letter(t):
                        words += words_of(t)
                    ends.append(len(words))
                new = [w for w in set(words) if w not in memo]
                if new and len(memo) + len(new) > MEMO_WORDS:
                    memo.clear()
                    scores = scores[:0]
                    new = list(set(words))
                if new:
                    memo.update(zip(new, range(len(scores), len(scores) + len(new))))
                    scores = kept["scores"] = np.concatenate([scores, word_scores(vocabulary, p, new)])
                index = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
                names, posts, begin = [], [], 0
                for end in ends:
                    if end == begin:
                        names.append("und")
                        posts.append(0.0)
                        continue
                    s = scores[index[begin:end]].sum(axis=0)
                    g = int(np.argmax(s))
                    names.append(langs[g])
                    posts.append(float(1 / np.exp(s - s[g]).sum()))
                    begin = end
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(carry)], pa.array(names, pa.string()), pa.array(posts, pa.float64())],
                    names=[*carry, "lang_pred", "score"])
        trim_worker()

    return wanted.mapInArrow(run, f"{schema}, lang_pred string, score double")


def identify(docs: DataFrame, vocabulary: str = "piece_bpe_32k.model", carry: list[str] | None = None,
             id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the rows with a language that aren't held out; predict all."""
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), held_out(F.col(id_col)).alias("out"))
    model = learn(rows.filter(~F.col("out")).select("lang", "text"), tokenizer_path(vocabulary))
    return predict(docs, model, carry or [id_col], text_col)
