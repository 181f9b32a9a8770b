"""Bounded-space online best-fit packing of token sequences.

Documents are tokenised with an end id; a document longer than the sequence
length is cut into full-length pieces and a rest, others stay whole.  Pieces
then go, one at a time, into the open sequence that they fit best.  At most
``OPEN`` sequences are open; they hang in a bitset keyed by their free space,
so the best fit is the lowest set bit at or above the piece's length, and when
a new sequence must be opened beyond the bound the fullest one closes.

Packing sees narrow rows (a piece's document, number and length), dealt by
hash over as many tasks as the total length needs (``TASK_TOKENS`` each), and
in each task in the order of that hash.  Every task ends with its own open
sequences, a share of ``OPEN * length / TASK_TOKENS`` at the very most.

Edge cases: a null text is an empty one, which still has its end id; equal
rows are packed one by one; null ids are packed like others (a piece is told
apart by id, number and the row it came from); an empty table packs to nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.chunks import ChunkEncoder, tokenizer_path
from quayside.llm.common import staged, trim_worker

LENGTH = 2048
OPEN = 1024
TASK_TOKENS = 500_000_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH, id_col: str = "doc_id",
           text_col: str = "text", sizes: tuple[int, int, int] | None = None) -> DataFrame:
    """One row per piece of each document.  ``sizes``: the encoder's, if not its own."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder.shared(tokenizer, end_id, sizes)
        for b in batches:
            names, texts = b.column(0).to_pylist(), b.column(1)
            for i in range(0, len(names), 512):
                ids, ends = encoder.encode(texts.slice(i, 512).to_pylist())
                data = memoryview(ids.astype("<u4").tobytes())
                rows, begin = [], 0
                for name, end in zip(names[i:i + 512], ends.tolist()):
                    for k, at in enumerate(range(begin, end, length)):
                        upto = min(end, at + length)
                        rows.append((name, k, at - begin, upto - at, zlib.crc32(data[4 * at:4 * upto])))
                    begin = end
                cols = list(zip(*rows))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 names=["doc_id", "piece", "start", "length", "ids_crc32"])
        trim_worker()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, PIECES)


class OpenBins:
    """The open sequences, in a bitset keyed by free space."""

    def __init__(self, length: int = LENGTH, most: int = OPEN):
        self.length, self.most = length, most
        self.mask, self.held = 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(length + 1)]
        self.next = 0

    def _pop(self, free: int) -> int:
        bins = self.by_free[free]
        b = bins.pop()
        if not bins:
            self.mask &= ~(1 << free)
        self.held -= 1
        return b

    def put(self, size: int) -> tuple[int, int]:
        """(sequence, offset in it) of a piece of ``size`` tokens."""
        above = self.mask >> size
        if above:
            free = size + (above & -above).bit_length() - 1
            b = self._pop(free)
        else:
            if self.held >= self.most:   # the fullest closes
                self._pop((self.mask & -self.mask).bit_length() - 1)
            b, free = self.next, self.length
            self.next += 1
        left = free - size
        if left:
            self.by_free[left].append(b)
            self.mask |= 1 << left
            self.held += 1
        return b, self.length - free


def pack(rows: DataFrame, length: int = LENGTH, most_open: int = OPEN, task_tokens: int = TASK_TOKENS) -> DataFrame:
    """``rows`` (with ``doc_id, piece, length``) and ``sequence_id, offset``."""
    total = rows.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // task_tokens))
    deal = F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(7))
    dealt = (rows.withColumn("_deal", deal).repartition(int(tasks), "_deal")
             .sortWithinPartitions("_deal", "doc_id", "piece", "start", "length", "ids_crc32").drop("_deal"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    at = rows.columns.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        bins = OpenBins(length, most_open)
        for b in batches:
            got = [bins.put(n) for n in b.column(at).to_pylist()]
            seq = np.fromiter((s for s, _ in got), np.int64, len(got)) + (part << 40)
            off = np.fromiter((o for _, o in got), np.int64, len(got))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(seq), pa.array(off)],
                                             names=[*b.schema.names, "sequence_id", "offset"])

    return dealt.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", end_id: int = 0, length: int = LENGTH,
                   id_col: str = "doc_id", text_col: str = "text", sizes: tuple[int, int, int] | None = None) -> DataFrame:
    """Tokenise, cut and pack all documents: one row per piece."""
    rows = staged(pieces(docs, tokenizer_path(vocabulary), end_id, length, id_col, text_col, sizes), "pieces")
    return pack(rows, length)
