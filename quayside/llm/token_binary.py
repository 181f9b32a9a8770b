"""Token ids in Simple-8b files.

A 64-bit word holds a selector in its top four bits and a number of equally
wide values in the 60 bits below, the first value lowest.  Selectors 0 and 1
stand for 240 and 120 zeros.  The widest packing has one value of 60 bits;
its all-ones value is the escape, and the next word then is the value itself,
unpacked.  Ids are coded in blocks of ``BLOCK`` values, each starting at a
word of its own, and the file stores the word offset of each block, so any
block decodes alone and all its words at once.

File (little-endian): the magic ``QS8B0001``; uint64 counts of documents, ids,
blocks and words; then, as arrays, the documents' ids (int64), null flags
(uint8, padded to 8 bytes), ends in ids (uint64), the word offset of every
block (uint64), the words (uint64).

``write_ids`` sorts documents by id through a range exchange and writes the
files of each partition with ``FILE_IDS`` ids or a little more (never cutting
a document).  A file's name holds the partition, its number there and the
task attempt; the manifest (a table written by Spark) names the files of the
attempts that counted, so a lost executor leaves at most files that nothing
refers to.  Documents keep their order over partitions, numbers and files.

Edge cases: null text is an empty one (only the end id); null ids come first;
equal ids are ordered by text; an empty table gives an empty manifest.
Files are opened through ``pyarrow.fs``, so the folder may be in any store
that it knows (local paths, HDFS, S3, GCS).
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quayside.llm.chunks import ChunkEncoder, tokenizer_path
from quayside.llm.common import partition_offsets, scratch_path, staged

MAGIC = b"QS8B0001"
BLOCK = 4096
FILE_IDS = 4_000_000
#: Blocks handled at once.
STEP = 512
#: Selector -> (values in a word, bits of each).
SELECTORS = [(240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10),
             (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
ESCAPE = (1 << 60) - 1
WIDTHS = sorted({bits for _, bits in SELECTORS})


def encode_words(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(words, word offset of each block) of unsigned 64-bit values, ``STEP`` blocks at a time."""
    words, offsets, at = [], [], 0
    for i in range(0, len(values), STEP * block):
        w, o = _encode_blocks(values[i:i + STEP * block], block)
        words.append(w)
        offsets.append(o + np.uint64(at))
        at += len(w)
    none = np.zeros(0, np.uint64)
    return np.concatenate(words or [none]), np.concatenate(offsets or [none])


def _encode_blocks(values: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """``encode_words`` of a few blocks.

    The densest selector that fits is found for all positions at once, by
    sliding maxima; then the blocks' chains of words are followed
    together, one step of all blocks at a time.
    """
    v = np.ascontiguousarray(values, np.uint64)
    n = len(v)
    starts = np.arange(0, n, block)
    # class of a value: how many of the widths are too narrow for it; the last block is filled with the widest
    need = np.full(len(starts) * block, len(WIDTHS), np.uint8)
    need[:n] = 0
    for bits in WIDTHS[:-1]:
        need[:n] += v >= np.uint64(1 << bits)
    most = {1: need.reshape(len(starts), block)}      # window length -> the widest class in each window of a block
    best = np.full((len(starts), block), 15, np.uint8)
    fits = {}
    for count, bits in reversed(SELECTORS[:-1]):
        if count > block:
            break
        half = max(c for c in most if 2 * c >= count or c == max(most))
        while 2 * half < count:
            most[2 * half] = np.maximum(most[half][:, :-half], most[half][:, half:])
            half *= 2
        step = count - half
        most[count] = np.maximum(most[half][:, :most[half].shape[1] - step], most[half][:, step:])
        fits[count] = most[count] <= WIDTHS.index(bits)
    for s in range(14, -1, -1):
        count = SELECTORS[s][0]
        if count in fits:
            best[:, :block - count + 1][fits[count]] = s
    best = best.ravel()
    step = np.array([c for c, _ in SELECTORS])[best]
    at, live, taken = starts.copy(), np.arange(len(starts)), []
    last = np.minimum(starts + block, n)
    while len(live):
        taken.append((live, at[live]))
        at[live] += step[at[live]]
        live = live[at[live] < last[live]]
    blocks = np.concatenate([b for b, _ in taken])
    pos = np.concatenate([p for _, p in taken])
    order = np.argsort(pos, kind="stable")
    pos, blocks = pos[order], blocks[order]
    sel = best[pos]
    escaped = (sel == 15) & (v[pos] >= np.uint64(ESCAPE))
    width = 1 + escaped
    place = np.cumsum(width) - width
    words = np.zeros(int(width.sum()), np.uint64)
    for s, (count, bits) in enumerate(SELECTORS):
        m = np.flatnonzero(sel == s)
        if not len(m):
            continue
        word = np.full(len(m), s << 60, np.uint64)
        if s == 15:
            word |= np.where(escaped[m], np.uint64(ESCAPE), v[pos[m]])
        elif bits:
            for k in range(count):
                word |= v[pos[m] + k] << np.uint64(k * bits)
        words[place[m]] = word
    words[place[escaped] + 1] = v[pos[escaped]]
    first = np.searchsorted(blocks, np.arange(len(starts)))
    return words, place[first].astype(np.uint64)


def decode_words(words: np.ndarray, offsets: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ``n`` values of ``encode_words``, ``STEP`` blocks at a time."""
    bound = np.append(offsets, np.uint64(len(words))).astype(np.int64)
    out = np.zeros(n, np.uint64)
    for b in range(0, len(offsets), STEP):
        upto = min(b + STEP, len(offsets))
        part = slice(b * block, min(upto * block, n))
        out[part] = _decode_blocks(words[bound[b]:bound[upto]], bound[b:upto] - bound[b], part.stop - part.start, block)
    return out


def _decode_blocks(words: np.ndarray, offsets: np.ndarray, n: int, block: int) -> np.ndarray:
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    sel = (words >> np.uint64(60)).astype(np.int64)
    coded = np.ones(len(words), bool)
    marks = np.flatnonzero(words == np.uint64(15 << 60 | ESCAPE))
    # a word behind an escape is raw; a raw word may look like an escape itself
    prev = -2
    for m in marks.tolist():
        if m == prev + 1 and not coded[m]:
            continue
        coded[m + 1] = False
        prev = m
    counts = np.where(coded, np.array([c for c, _ in SELECTORS])[sel], 0)
    bound = np.append(offsets.astype(np.int64), len(words))
    ends = np.cumsum(counts)
    start = ends - counts
    assert np.array_equal(start[bound[:-1]], np.arange(0, n, block)), "block offsets don't fit the words"
    for s, (count, bits) in enumerate(SELECTORS):
        m = np.flatnonzero(coded & (sel == s))
        if not len(m) or not bits:
            continue
        payload = words[m] & np.uint64(ESCAPE)
        if s == 15:
            raw = payload == np.uint64(ESCAPE)
            payload[raw] = words[m[raw] + 1]
            out[start[m]] = payload
        else:
            mask = np.uint64((1 << bits) - 1)
            for k in range(count):
                out[start[m] + k] = (payload >> np.uint64(k * bits)) & mask
    return out


def pack_file(doc_ids: list[int | None], ends: np.ndarray, ids: np.ndarray) -> bytes:
    words, offsets = encode_words(ids)
    n = len(doc_ids)
    null = np.zeros(-(-n // 8) * 8, np.uint8)
    null[:n] = [d is None for d in doc_ids]
    head = np.array([n, len(ids), len(offsets), len(words)], "<u8")
    parts = [head, np.array([d or 0 for d in doc_ids], "<i8"), null, ends.astype("<u8"), offsets.astype("<u8"), words.astype("<u8")]
    return MAGIC + b"".join(p.tobytes() for p in parts)


def unpack_file(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document ids, ends, ids) of one file."""
    if data[:8] != MAGIC:
        raise ValueError("not a token file")
    n, n_ids, n_blocks, n_words = np.frombuffer(data, "<u8", 4, 8).tolist()
    at = 40
    docs = np.frombuffer(data, "<i8", n, at)
    at += 8 * n
    null = np.frombuffer(data, np.uint8, n, at)
    at += -(-n // 8) * 8
    ends = np.frombuffer(data, "<u8", n, at).astype(np.int64)
    at += 8 * n
    offsets = np.frombuffer(data, "<u8", n_blocks, at)
    at += 8 * n_blocks
    words = np.frombuffer(data, "<u8", n_words, at)
    ids = decode_words(words, offsets, n_ids)
    return [None if z else d for d, z in zip(docs.tolist(), null.tolist())], ends, ids


def _store(folder: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


MANIFEST = "part int, seq int, file string, n_docs long, n_ids long, n_bytes long"


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
              text_col: str = "text", file_ids: int = FILE_IDS) -> DataFrame:
    """Write the token files of ``docs`` to ``folder``; the manifest."""
    ordered = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        encoder = ChunkEncoder.shared(tokenizer, end_id)
        seq, docs_, ends_, ids_, held = 0, [], [], [], 0

        def flush():
            nonlocal seq, held
            data = pack_file(docs_, np.concatenate(ends_), np.concatenate(ids_))
            name = f"{part:08d}-{seq:08d}-{attempt}.s8b"
            with store.open_output_stream(f"{root}/{name}") as out:
                out.write(data)
            row = pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "file": [name],
                 "n_docs": [len(docs_)], "n_ids": [held], "n_bytes": [len(data)]})
            seq, held = seq + 1, 0
            docs_.clear(), ends_.clear(), ids_.clear()
            return row

        for b in batches:
            names, texts = b.column(0).to_pylist(), b.column(1)
            for i in range(0, len(names), 512):
                ids, ends = encoder.encode(texts.slice(i, 512).to_pylist())
                docs, at = names[i:i + 512], 0
                while at < len(docs):                   # up to the document that fills the file
                    begin = int(ends[at - 1]) if at else 0
                    upto = min(int(np.searchsorted(ends, begin + file_ids - held)) + 1, len(docs))
                    docs_ += docs[at:upto]
                    ends_.append(ends[at:upto] - begin + held)
                    ids_.append(ids[begin:ends[upto - 1]])
                    held += int(ends[upto - 1]) - begin
                    at = upto
                    if held >= file_ids:
                        yield flush()
        if docs_:
            yield flush()

    return staged(ordered.mapInArrow(write, MANIFEST), "token_manifest")


def read_ids(manifest: DataFrame, folder: str, digest=None, schema: str = "ids array<long>") -> DataFrame:
    """(doc_id, start, n_tokens, ...) of each document in the files of
    ``manifest``.  ``digest(ids)`` makes the further columns of ``schema``
    from an array of ids; without it they are the ids."""
    per_part = manifest.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    files = (manifest.withColumn("_in", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
             .join(partition_offsets(per_part, "part", "n", "_before"), "part")
             .select("file", (F.col("_before") + F.col("_in")).alias("start")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        for b in batches:
            for name, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with store.open_input_stream(f"{root}/{name}") as f:
                    docs, ends, ids = unpack_file(f.read())
                begins = np.concatenate([[0], ends[:-1]])
                for i in range(0, len(docs), 2000):
                    pairs = list(zip(begins[i:i + 2000].tolist(), ends[i:i + 2000].tolist()))
                    more = [digest(ids[x:y]) if digest else ids[x:y].astype(np.int64) for x, y in pairs]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs[i:i + 2000], pa.int64()), pa.array([start + x for x, _ in pairs], pa.int64()),
                         pa.array([y - x for x, y in pairs], pa.int64()), pa.array(more)],
                        names=["doc_id", "start", "n_tokens", "more"])

    # one task per file or so: files are of even size, and their number is that of the data
    n = max(1, manifest.count())
    return files.repartition(n, "file").mapInArrow(read, f"doc_id long, start long, n_tokens long, {schema}")


def ids_crc32(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def token_digest(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", end_id: int = 2) -> DataFrame:
    """Write the token files of all documents, read them back, and give each
    document's start, length and checksum."""
    folder = scratch_path(docs.sparkSession, "quayside", "tokens", uuid.uuid4().hex)
    manifest = write_ids(docs, folder, tokenizer_path(vocabulary), end_id)
    return read_ids(manifest, folder, ids_crc32, "ids_crc32 long")
