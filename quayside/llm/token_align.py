"""Alignment of two tokenizers' tokens.

Tokenizer A is a byte-level BPE of the tokenizers library and reads a space
and the text; tokenizer B is a SentencePiece BPE, which puts that space before
the text itself.  Both give tokens that cut the same UTF-8 bytes.  A *group* is
a least run of tokens of both that begin and end at the same two bytes; a
*link* is a pair of an A and a B token whose bytes overlap.

Method: interval coalescing.  All A and B tokens are lexsorted by their start;
``maximum.accumulate`` of the ends gives how far the tokens so far reach; a
group breaks where a start reaches that; the overlaps are expanded within the
groups (``coalesce``).  Neither vocabulary has a token across a space that
stands between two characters that aren't white space, so texts are cut there;
the tokens of all chunks that a worker hasn't met before are laid end to end
and coalesced together, and their groups and links are kept in a memo of
bounded size (``MEMO``; the chunks met least go first).

``align`` gives each document's numbers and its links; ``link_counts`` counts,
for each (A id, B id) linked anywhere, the documents that hold it linked, and
marks the pairs with an A id's highest count; ``with_counts`` brings those
back to the documents.  The pairs that have at least a ``HOT``-th of all
(document, pair) rows are at most ``HOT``, whatever the corpus: every worker
reads them from a file.  The rows of all other pairs are joined by a shuffle.

Edge cases: a text that is null or empty, or whose tokens of A or of B don't
join to its space and text (B turns U+2581 into a space), has no tokens: its
numbers are 0 and ``groups_sha256`` is ''.  Strings of special tokens in a
text are plain text.  A document is a row: rows that repeat an id or a text
count one by one.  An empty table gives an empty result.  Carried columns may
not have a result column's name (an error); other columns aren't read.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.chunks import _ragged, tokenizer_path
from quayside.llm.common import scratch_path, staged, worker_state

MEMO = 300_000
#: The most pairs that a worker holds for looking counts up.
HOT = 1 << 21
#: Characters of text handled at once.
BATCH_CHARS = 1_000_000
RESULT = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

_ODD = re.compile(r" (?=\s|$)")
_CUT = re.compile(r"(?<=[^ ])(?= \S)")


def byte_level() -> dict[str, int]:
    """The characters that a byte-level vocabulary writes bytes as: printable
    Latin-1 bytes are themselves, the others follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Side:
    """One tokenizer: ids of many strings at once, and the bytes of an id."""

    def __init__(self, token_bytes: list[bytes], encode):
        self.token_bytes, self.encode = token_bytes, encode
        self.lens = np.fromiter(map(len, token_bytes), np.int64, len(token_bytes))
        self.names = list(map(str, range(len(token_bytes))))

    @staticmethod
    def bpe(path: str) -> Side:
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        chars = byte_level()
        vocab = t.get_vocab(with_added_tokens=True)
        entries = [b""] * (max(vocab.values()) + 1)
        for entry, i in vocab.items():
            entries[i] = bytes(map(chars.__getitem__, entry)) if all(c in chars for c in entry) else entry.encode()
        return Side(entries, lambda texts: [e.ids for e in t.encode_batch_fast([" " + x for x in texts], add_special_tokens=False)])

    @staticmethod
    def pieces(path: str) -> Side:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)

        def plain(i: int) -> bytes:
            if sp.is_byte(i):
                return bytes([int(sp.id_to_piece(i)[3:5], 16)])
            return sp.id_to_piece(i).replace("▁", " ").encode()

        return Side([plain(i) for i in range(sp.get_piece_size())], lambda texts: sp.encode(texts, num_threads=1))

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))


def coalesce(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray):
    """(group of each A token, group of each B token, links as places in A and
    in B) of two runs of tokens that each tile the same bytes."""
    n = len(start_a)
    start, end = np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b])
    order = np.lexsort((np.arange(len(start)) >= n, start))
    reach = np.maximum.accumulate(end[order])
    breaks = np.ones(len(start), bool)
    breaks[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(start), np.int64)
    group[order] = np.cumsum(breaks) - 1
    group_a, group_b = group[:n], group[n:]
    # within its group an A token meets the B tokens from the first that ends behind its start to the last that starts before its end
    first = np.searchsorted(end_b, start_a, "right")
    last = np.searchsorted(start_b, end_a, "left")
    return group_a, group_b, np.repeat(np.arange(n), last - first), _ragged(first, last - first)


class Aligner:
    """Groups and links of texts, with a memo of chunks."""

    def __init__(self, path_a: str, path_b: str, most: int = MEMO):
        self.a, self.b, self.most = Side.bpe(path_a), Side.pieces(path_b), most
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.rendered: list[bytes] = []                      # a chunk's groups as text
        self.table = np.zeros((0, 6), np.int64)              # ok, n_a, n_b, n_groups, place and number of its links
        self.links = np.zeros(0, np.int32)                   # a * len(b) + b
        self.met = np.zeros(0, np.int64)

    @staticmethod
    def shared(path_a: str, path_b: str) -> Aligner:
        """This worker's aligner, made at its first task."""
        return worker_state("aligner", (path_a, path_b), lambda: Aligner(path_a, path_b))

    @staticmethod
    def cut(text: str) -> list[str]:
        """The chunks of a space and the text, each without its first space."""
        text = " " + text
        if _ODD.search(text) is None:
            return text[1:].split(" ")
        return [p[1:] for p in _CUT.split(text)]

    def _trim(self) -> None:
        """Forget the chunks that were met least, half of what may be kept at least."""
        keep = np.argsort(-self.met, kind="stable")[:self.most // 2]
        keep = np.sort(keep[self.met[keep] > 1])
        names = list(self.known)
        table = self.table[keep]
        self.links = self.links[_ragged(table[:, 4], table[:, 5])]
        table[:, 4] = np.cumsum(table[:, 5]) - table[:, 5]
        self.known = {names[i]: j for j, i in enumerate(keep.tolist())}
        self.rendered = [self.rendered[i] for i in keep.tolist()]
        self.table, self.met = table, self.met[keep] // 2

    def _learn(self, new: list[str]) -> None:
        ids = [s.encode(new) for s in (self.a, self.b)]
        raw = [b" " + x.encode("utf-8", "surrogatepass") for x in new]
        ok = np.fromiter((self.a.joined(x) == r and self.b.joined(y) == r for x, y, r in zip(*ids, raw)), bool, len(new))
        # of a chunk that isn't well nothing is kept but that
        count = [np.fromiter(map(len, i), np.int64, len(new)) * ok for i in ids]
        flat = [np.fromiter(chain.from_iterable(x for x, k in zip(i, ok.tolist()) if k), np.int64, int(c.sum())) for i, c in zip(ids, count)]
        ends = [np.cumsum(s.lens[f]) for s, f in zip((self.a, self.b), flat)]
        starts = [e - s.lens[f] for e, s, f in zip(ends, (self.a, self.b), flat)]
        group_a, group_b, at_a, at_b = coalesce(starts[0], ends[0], starts[1], ends[1])
        links = (flat[0][at_a] * len(self.b.names) + flat[1][at_b]).astype(np.int32)

        upto = [np.concatenate([[0], np.cumsum(c)]) for c in count]
        per_a = np.concatenate([[0], np.cumsum(np.bincount(at_a, minlength=len(flat[0])))])
        n_links = per_a[upto[0][1:]] - per_a[upto[0][:-1]]
        # tokens of a chunk are neighbours, so its groups are those from its first token's to its last one's
        last = np.maximum(upto[0][1:] - 1, 0)
        n_groups = np.where(ok, group_a[last] - group_a[np.minimum(upto[0][:-1], last)] + 1, 0) if len(group_a) else np.zeros(len(new), np.int64)
        rows = np.stack([ok.astype(np.int64), *count, n_groups, len(self.links) + np.cumsum(n_links) - n_links, n_links], axis=1)
        self.rendered += self._render(*flat, group_a, group_b, *upto)
        self.table = np.concatenate([self.table, rows])
        self.links = np.concatenate([self.links, links])
        self.met = np.concatenate([self.met, np.zeros(len(new), np.int64)])

    def _render(self, ids_a, ids_b, group_a, group_b, upto_a, upto_b) -> list[bytes]:
        def texts(ids, groups, names):
            """The ids of each group, joined by commas."""
            cuts = np.flatnonzero(np.diff(groups)) + 1
            words = [names[i] for i in ids.tolist()]
            bounds = [0, *cuts.tolist(), len(words)] if len(words) else [0]
            return [words[i] if j == i + 1 else ",".join(words[i:j]) for i, j in zip(bounds[:-1], bounds[1:])]
        both = [f"{x}|{y}" for x, y in zip(texts(ids_a, group_a, self.a.names), texts(ids_b, group_b, self.b.names))]
        first = np.append(group_a, len(both))[np.minimum(upto_a, len(group_a))].tolist()
        return [both[i].encode() if j == i + 1 else ";".join(both[i:j]).encode() for i, j in zip(first[:-1], first[1:])]

    def places(self, chunks: list[str]) -> np.ndarray:
        """The chunks' rows in the table; unknown ones are learned together."""
        new: list[str] = []
        known = self.known

        def place(c: str) -> int:
            at = known.get(c)
            if at is None:
                at = known[c] = len(known)
                new.append(c)
            return at

        out = np.fromiter(map(place, chunks), np.int64, len(chunks))
        if new:
            self._learn(new)
        self.met += np.bincount(out, minlength=len(self.met))
        return out

    def align(self, texts: list[str | None]):
        """For each text [n_a, n_b, n_groups, n_links], its groups as bytes, and
        (ends, pairs, times): the distinct links of each text."""
        if len(self.known) > self.most:
            self._trim()
        chunks, counts = [], []
        for t in texts:
            own = self.cut(t) if t else []
            chunks += own
            counts.append(len(own))
        at = self.places(chunks)
        counts = np.array(counts, np.int64)
        doc = np.repeat(np.arange(len(texts)), counts)
        bad = np.bincount(doc[self.table[at, 0] == 0], minlength=len(texts)) > 0
        fine = ~bad[doc]
        doc, at, upto = doc[fine], at[fine], np.concatenate([[0], np.cumsum(counts)])
        numbers = np.zeros((len(texts), 4), np.int64)
        for k, column in enumerate((1, 2, 3, 5)):
            numbers[:, k] = np.bincount(doc, self.table[at, column], len(texts)).astype(np.int64)
        pairs = self.links[_ragged(self.table[at, 4], self.table[at, 5])]
        key = np.sort(np.repeat(doc, self.table[at, 5]) << 32 | pairs)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        times = np.diff(np.append(first, len(key)))
        key = key[first]
        ends = np.searchsorted(key, np.arange(1, len(texts) + 1) << 32)
        by_doc = np.concatenate([[0], np.cumsum(np.where(bad, 0, counts))])
        rendered = [self.rendered[i] for i in at.tolist()]
        groups = [b";".join(rendered[i:j]) for i, j in zip(by_doc[:-1].tolist(), by_doc[1:].tolist())]
        return numbers, groups, (ends, (key & 0xFFFFFFFF).astype(np.int32), times.astype(np.int32))


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, carry: Sequence[str] = ("doc_id",),
          text_col: str = "text", keep_groups: bool = False) -> DataFrame:
    """A row per row of ``docs``: the carried columns, ``n_a``, ``n_b``,
    ``n_groups``, ``n_links``, ``groups_sha256``, the distinct links ``pairs``
    (A id times B's vocabulary size plus B id) with their ``times``, a row
    number, and ``groups`` as text if ``keep_groups``.  Written once."""
    path_a, path_b = path_a or tokenizer_path("byte_bpe_50k.json"), path_b or tokenizer_path("piece_bpe_32k.model")
    clash = {c.lower() for c in carry} & {*RESULT, "pairs", "times", "groups", "_row", "n_best", "count_sum"}
    if clash:
        raise ValueError(f"carried columns are named like result columns: {sorted(clash)}")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.shared(path_a, path_b)
        for b in rows:
            texts, at, n = b.column(b.num_columns - 1), 0, b.num_columns - 1
            sizes = np.asarray(pc.fill_null(pc.utf8_length(texts), 0)).cumsum()
            while at < b.num_rows:
                upto = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BATCH_CHARS)))
                numbers, groups, (ends, pairs, times) = aligner.align(texts.slice(at, upto - at).to_pylist())
                sha = [hashlib.sha256(g).hexdigest() if k else "" for g, k in zip(groups, numbers[:, 0].tolist())]
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                out = [c.slice(at, upto - at) for c in b.columns[:n]] + [pa.array(numbers[:, k]) for k in range(4)] + [pa.array(sha)]
                out += [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x)) for x in (pairs, times)]
                out += [pa.array(groups, pa.binary()).cast(pa.string())] if keep_groups else []
                yield pa.RecordBatch.from_arrays(out, names=names)
                at = upto

    names = [*carry, *RESULT, "pairs", "times", *(["groups"] if keep_groups else [])]
    own = docs.select(*[F.col(f"`{c}`") for c in carry], F.col(text_col).cast("string").alias("_text"))
    long, ints = F.lit(0).cast("long"), F.array(F.lit(0))
    schema = own.drop("_text").select("*", *[long.alias(c) for c in RESULT[:4]], F.lit("").alias("groups_sha256"), ints.alias("pairs"),
                                      ints.alias("times"), *([F.lit("").alias("groups")] if keep_groups else [])).schema
    return staged(own.mapInArrow(run, schema).withColumn("_row", F.monotonically_increasing_id()), "aligned")


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(at, np.concatenate(counts), len(key)).astype(np.int64)


def link_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): the documents that hold a pair linked, and whether no
    other pair of its A id has more.  Summed in each task first."""
    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(keys[0]), pa.array(counts[0])], names=["pair", "n"])

        for b in rows:
            flat = np.asarray(b.column(0).flatten())
            keys.append(flat), counts.append(np.ones(len(flat), np.int64))
            held += len(flat)
            if held > 3_000_000:
                merged = _summed(keys, counts)
                keys, counts = [merged[0]], [merged[1]]
                held = len(keys[0])
                if held > 2_000_000:
                    yield out()
                    keys, counts, held = [], [], 0
        if keys:
            merged = _summed(keys, counts)
            keys, counts = [merged[0]], [merged[1]]
            yield out()

    n = staged(aligned.select("pairs").mapInArrow(count, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")), "link_counts")
    id_a = F.call_function("div", F.col("pair"), F.lit(size_b))
    most = n.groupBy(id_a.alias("_a")).agg(F.max("n").alias("_most"))          # at most a row for each entry of A
    return staged(n.withColumn("_a", id_a).join(most, "_a").select("pair", "n", (F.col("n") == F.col("_most")).alias("best")), "links")


class Lookup:
    """Counts of the hot pairs, read from their file once per worker."""

    def __init__(self, folder: str):
        import pyarrow.parquet as pq
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        t = pq.read_table(root, filesystem=store, schema=pa.schema([("pair", pa.int32()), ("n", pa.int64()), ("best", pa.bool_())]))
        order = np.argsort(pair := t.column("pair").to_numpy())
        self.pair, self.n, self.best = pair[order], t.column("n").to_numpy()[order], t.column("best").to_numpy()[order]

    @staticmethod
    def shared(folder: str) -> Lookup:
        return worker_state("lookup", folder, lambda: Lookup(folder))


def with_counts(aligned: DataFrame, links: DataFrame, hot: int = HOT) -> DataFrame:
    """``aligned`` with ``n_best`` and ``count_sum``; without its links."""
    total = links.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * F.lit(hot) >= F.lit(total)                            # so many can't be more than ``hot``
    folder = scratch_path(aligned.sparkSession, "quayside", "hot_links", uuid.uuid4().hex)
    links.where(is_hot).write.parquet(folder)

    def look(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Lookup.shared(folder)
        for b in rows:
            lists, times = b.column(1), np.asarray(b.column(2).flatten())
            pairs = np.asarray(lists.flatten())
            doc = np.repeat(np.arange(b.num_rows), np.asarray(pc.list_value_length(lists)))
            at = np.minimum(np.searchsorted(table.pair, pairs), max(len(table.pair) - 1, 0))
            found = table.pair[at] == pairs if len(table.pair) else np.zeros(len(pairs), bool)
            sums = []
            for value in (table.best, table.n):
                part = np.zeros(len(pairs), np.int64)
                part[found] = value[at[found]] * times[found].astype(np.int64)
                upto = np.concatenate([[0], np.cumsum(part)])
                ends = np.searchsorted(doc, np.arange(b.num_rows + 1))
                sums.append(upto[ends[1:]] - upto[ends[:-1]])
            rare = ~found
            offsets = pa.array(np.searchsorted(doc[rare], np.arange(b.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, sums), pa.ListArray.from_arrays(offsets, pa.array(pairs[rare])),
                                              pa.ListArray.from_arrays(offsets, pa.array(times[rare]))], names=["_row", "_best", "_sum", "_pairs", "_times"])

    looked = staged(aligned.select("_row", "pairs", "times").mapInArrow(
        look, "_row long, _best long, _sum long, _pairs array<int>, _times array<int>"), "links_looked_up")
    rare = (looked.select("_row", F.explode(F.arrays_zip("_pairs", "_times")).alias("x"))
            .select("_row", F.col("x._pairs").alias("pair"), F.col("x._times").cast("long").alias("_t")))
    rare = (rare.join(links.where(~is_hot), "pair")
            .select("_row", (F.col("_t") * F.col("best").cast("long")).alias("_best"), (F.col("_t") * F.col("n")).alias("_sum")))
    sums = (looked.select("_row", "_best", "_sum").unionByName(rare).groupBy("_row")
            .agg(F.sum("_best").alias("n_best"), F.sum("_sum").alias("count_sum")))
    return aligned.drop("pairs", "times").join(sums, "_row").drop("_row")


def align_digest(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, hot: int = HOT) -> DataFrame:
    """Each document's numbers of tokens, groups and links, with the links' counts over all documents."""
    import sentencepiece
    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b or tokenizer_path("piece_bpe_32k.model")).get_piece_size()
    aligned = align(docs, path_a, path_b)
    out = with_counts(aligned, link_counts(aligned, size_b), hot)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
