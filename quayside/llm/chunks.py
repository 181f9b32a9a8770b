"""Token ids of whole texts, through the tokenizers library, with memos.

Both vocabularies used here start a new pre-token at every space that comes
before a character that isn't white space, so a text may be cut there and
the ids of its chunks joined: the result is what one call on the whole text
gives (``tests/llm/test_tokens.py`` compares them).  Most chunks have been met
before; their ids come from a memo.  A new chunk of plain Latin letters,
digits, signs and line breaks is cut further, into its pre-tokens, whose ids
come from a second memo; pre-tokens and chunks that no memo has go to the
library in batches.  (Outside that range a chunk goes to the library whole,
so that nothing depends on the Unicode version of a pattern.)  A text that
holds the string of an added token (``<|endoftext|>``), which gets that
token's id as in a plain library call, goes to the library whole.

A full memo (``CHUNKS``, ``TOKENS``, ``IDS``) keeps what it met most, so memory
doesn't follow the corpus.  ``ChunkEncoder.shared`` keeps the encoder of a
Python worker between its tasks, as the one state that the worker keeps.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np

from quayside.llm.common import worker_state

CHUNKS, TOKENS, IDS = 600_000, 1_100_000, 6_000_000
#: Characters of text handled at once.
BATCH_CHARS = 1_500_000
#: (CHUNKS, TOKENS, BATCH_CHARS) where memory is short: more of the text goes to the library.
SMALL = (150_000, 150_000, 400_000)

_ODD = re.compile(r" (?=\s|$)")
_CUT = re.compile(r"(?= \S)")
#: Letters here are their own normal form, and so are their lower-case letters.
_PLAIN = re.compile(r"[\t\n\r -~À-įı-ſ]*")
#: The pre-token patterns of the two vocabularies.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary file lies."""
    import public_tokenizers
    return public_tokenizers.path(name)


def _ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The places of runs that begin at ``starts``."""
    ends = np.cumsum(lens)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lens, lens)


class _Memo(dict):
    """String -> its place among the known ones, with the ids of each.

    When it is full, the strings met once since the last time are forgotten,
    and if that isn't half of them, those met least as well."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.new = most, []
        self.lens, self.starts, self.met = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.pool = np.zeros(0, np.uint32)

    def trim(self) -> None:
        keep = np.argsort(-self.met, kind="stable")[:self.most // 2]
        keep = np.sort(keep[self.met[keep] > 1])
        names, pool = list(self), self.gather(keep)
        self.clear()
        self.update(zip(map(names.__getitem__, keep.tolist()), range(len(keep))))
        if len(pool) > IDS // 2:                        # few strings of very many ids
            return self.empty()
        self.lens, self.met, self.pool = self.lens[keep], self.met[keep] // 2, pool
        self.starts = np.cumsum(self.lens) - self.lens

    def empty(self) -> None:
        self.clear()
        self.lens, self.starts, self.met = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.pool = np.zeros(0, np.uint32)

    def __missing__(self, key: str) -> int:
        at = self[key] = len(self)
        self.new.append(key)
        return at

    def index(self, keys: list[str], learn) -> np.ndarray:
        """The places of ``keys``; ``learn(new)`` gives the ids and lengths of unknown ones."""
        if len(self) > self.most or len(self.pool) > IDS:
            self.trim()
        out = np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))
        if self.new:
            new, self.new = self.new, []
            pool, lens = learn(new)
            self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(lens) - lens])
            self.lens = np.concatenate([self.lens, lens])
            self.pool = np.concatenate([self.pool, pool])
            self.met = np.concatenate([self.met, np.zeros(len(new), np.int32)])
        self.met += np.bincount(out, minlength=len(self.met)).astype(np.int32)
        return out

    def gather(self, index: np.ndarray) -> np.ndarray:
        return self.pool[_ragged(self.starts[index], self.lens[index])]


class ChunkEncoder:
    """``encode(texts)`` gives the ids of each text, with ``end_id`` behind it."""

    def __init__(self, path: str, end_id: int, sizes: tuple[int, int, int] | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.lower = self.tokenizer.normalizer is not None      # of a plain chunk it changes the case alone
        self.tokens_of = regex.compile(WORD_LEVEL if self.lower else BYTE_LEVEL).findall
        self.end_id = end_id
        most, most_tokens, self.batch_chars = sizes or (CHUNKS, TOKENS, BATCH_CHARS)
        self.first, self.rest, self.tokens = _Memo(most), _Memo(most), _Memo(most_tokens)

    @staticmethod
    def shared(path: str, end_id: int, sizes: tuple[int, int, int] | None = None) -> ChunkEncoder:
        """This worker's encoder, made at its first task; a worker keeps one."""
        return worker_state("encoder", (path, end_id, sizes), lambda: ChunkEncoder(path, end_id, sizes))

    @staticmethod
    def cut(text: str) -> list[str]:
        """The chunks of a text; the space before each but the first is left out."""
        if _ODD.search(text) is None:
            return text.split(" ")
        parts = _CUT.split(text)
        return parts[:1] + [p[1:] for p in parts[1:]]

    def _library(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]
        lens = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(lens.sum())), lens

    def _learn_rest(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``_learn`` of chunks whose first space was left out.  Laid end to end
        they have the same pre-tokens; those of the byte-level pattern leave no
        character out, so their lengths tell which chunk they are of."""
        chunks = [" " + c for c in chunks]
        text = "".join(chunks)
        if self.lower or _PLAIN.fullmatch(text) is None:
            return self._learn(chunks)
        tokens = self.tokens_of(text)
        at = self.tokens.index(tokens, self._library)
        behind = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)))
        ends = np.searchsorted(behind, np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)))) + 1
        spent = np.concatenate([[0], np.cumsum(self.tokens.lens[at])])[np.concatenate([[0], ends])]
        return self.tokens.gather(at), np.diff(spent)

    def _learn(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        plain = np.fromiter((_PLAIN.fullmatch(c) is not None for c in chunks), bool, len(chunks))
        tokens, counts, odd = [], [], []
        for c, p in zip(chunks, plain.tolist()):
            if p:
                found = self.tokens_of(c.lower() if self.lower else c)
                tokens += found
                counts.append(len(found))
            else:
                odd.append(c)
        at = self.tokens.index(tokens, self._library)
        ends = np.cumsum(counts, dtype=np.int64)
        spent = np.concatenate([[0], np.cumsum(self.tokens.lens[at])])
        lens = np.zeros(len(chunks), np.int64)
        lens[plain] = spent[ends] - spent[ends - counts] if len(counts) else 0
        odd_ids, odd_lens = self._library(odd) if odd else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        lens[~plain] = odd_lens
        out = np.zeros(int(lens.sum()), np.uint32)
        begin = np.cumsum(lens) - lens
        out[_ragged(begin[plain], lens[plain])] = self.tokens.gather(at)
        out[_ragged(begin[~plain], odd_lens)] = odd_ids
        return out, lens

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, ends of the texts in them)."""
        flat, ends, total, at = [], [], 0, 0
        while at < len(texts):
            chars, upto = 0, at
            while upto < len(texts) and (upto == at or chars < self.batch_chars):
                chars += len(texts[upto] or "")
                upto += 1
            ids, end = self._encode(texts[at:upto])
            flat.append(ids)
            ends.append(end + total)
            total += len(ids)
            at = upto
        if not flat:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return np.concatenate(flat), np.concatenate(ends)

    def _encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        firsts, rests, counts, whole = [], [], [], []
        for i, t in enumerate(texts):
            t = t or ""
            if any(a in t for a in self.added):
                whole.append(i)
                t = ""
            parts = self.cut(t)
            firsts.append(parts[0])
            rests += parts[1:]
            counts.append(len(parts) - 1)
        head = self.first.index(firsts, self._learn)
        tail = self.rest.index(rests, self._learn_rest)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        spent = np.concatenate([[0], np.cumsum(self.rest.lens[tail])])
        head_len, tail_len = self.first.lens[head], spent[bounds[1:]] - spent[bounds[:-1]]
        whole_ids, whole_lens = self._library([texts[i] for i in whole])
        size = head_len + tail_len + 1
        size[whole] += whole_lens
        ends = np.cumsum(size)
        out = np.full(int(ends[-1]), self.end_id, np.uint32)
        begin = ends - size
        out[_ragged(begin, head_len)] = self.first.gather(head)
        out[_ragged(begin + head_len, tail_len)] = self.rest.gather(tail)
        out[_ragged(begin[whole], whole_lens)] = whole_ids
        return out, ends
