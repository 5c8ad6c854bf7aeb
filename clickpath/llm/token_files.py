"""Token-id files of patched frame-of-reference blocks.

Documents are written in ascending doc_id order as *frames*. A frame is a
self-contained byte string: its documents' ids and lengths, an index of block
starts, and blocks of ``BLOCK`` token ids. A block stores its minimum, a bit
width chosen at a percentile of the differences to it, the low bits of every
difference at that width, and a list of exceptions for the differences that
need more bits.

    frame   magic 4s, block size u32, ids u64, ids before it in its part u64,
            documents u32, blocks u32
            doc_id i64 and token count u32 of each document, null flag u8 of each
            block start u64 of each block, and the end
    block   minimum u32, width u8, exceptions u16, packed low bits (width x BLOCK / 8),
            position u16 of each exception, full difference u32 of each exception

All numbers are little-endian; packed bits run from the highest bit down. The
last block is filled up with its minimum. Frames are committed by Spark's own
Parquet writer (one row a frame: part, seq, n_ids, frame), so any store that
Spark writes will do and a lost executor leaves no half-written file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickpath.llm import common
from clickpath.llm.tokens import default_tokenizer, encoder

END_ID = 2
BLOCK = 1024

# Share of a block's differences that the packed width has to hold.
PERCENTILE = 0.9

# A frame ends with the document that takes it over so many ids.
FRAME_IDS = 1 << 17

MAGIC = b"PFR1"
HEADER = struct.Struct("<4sIQQII")
BLOCK_HEADER = struct.Struct("<IBH")

FRAME_SCHEMA = "part int, seq int, n_ids long, frame binary"
DOC_SCHEMA = "part int, doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK values as rows of big-endian words, ``width`` bits of each value, highest bit first.

    64 values fill ``width`` words; the n-th of every 64 is shifted to its place in all rows at once.
    """
    n = values.shape[0]
    of = np.ascontiguousarray(values.astype(np.uint64).reshape(n * BLOCK // 64, 64).T) & np.uint64((1 << width) - 1)
    words = np.zeros((width, n * BLOCK // 64), np.uint64)
    for k in range(64 if width else 0):
        word, bit = divmod(k * width, 64)
        spare = 64 - bit - width
        if spare >= 0:
            words[word] |= of[k] << np.uint64(spare)
        else:  # the low bits go to the next word
            words[word] |= of[k] >> np.uint64(-spare)
            words[word + 1] |= of[k] << np.uint64(64 + spare)
    return words.T.reshape(n, -1).astype(">u8")


def _unpacked(words: np.ndarray, width: int) -> np.ndarray:
    """The values of ``_packed``; ``words`` has a row for each block."""
    n, mask = words.shape[0], np.uint64((1 << width) - 1)
    of = np.ascontiguousarray(words.astype(np.uint64).reshape(n * BLOCK // 64, width).T)
    out = np.zeros((64, n * BLOCK // 64), np.uint64)
    for k in range(64 if width else 0):
        word, bit = divmod(k * width, 64)
        spare = 64 - bit - width
        out[k] = of[word] >> np.uint64(spare) if spare >= 0 else of[word] << np.uint64(-spare) | of[word + 1] >> np.uint64(64 + spare)
    return (out & mask).T.reshape(n, BLOCK).astype(np.uint32)


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """Blocks of a u32 array, all of ``BLOCK`` values."""
    if not len(ids):
        return []
    n = -(-len(ids) // BLOCK)
    full = np.empty(n * BLOCK, np.uint32)
    full[:len(ids)] = ids
    tail = (n - 1) * BLOCK
    full[len(ids):] = ids[tail:].min()
    full = full.reshape(n, BLOCK)
    low = full.min(axis=1)
    diff = full - low[:, None]
    at = int(PERCENTILE * (BLOCK - 1))
    chosen = np.partition(diff, at, axis=1)[:, at]
    width = np.ceil(np.log2(chosen.astype(np.float64) + 1)).astype(np.int64)
    over = diff.astype(np.uint64) >> width[:, None].astype(np.uint64) != 0
    rows, places = np.nonzero(over)
    cuts, places, rest = np.searchsorted(rows, np.arange(n + 1)), places.astype("<u2"), diff[over].astype("<u4")
    blocks: list[bytes] = [b""] * n
    for w in np.unique(width):
        of = np.flatnonzero(width == w)
        for row, words in zip(of.tolist(), _packed(diff[of], int(w))):
            a, b = cuts[row], cuts[row + 1]
            blocks[row] = b"".join((BLOCK_HEADER.pack(int(low[row]), int(w), int(b - a)), words.tobytes(), places[a:b].tobytes(), rest[a:b].tobytes()))
    return blocks


def decode_blocks(payload: bytes, starts: np.ndarray, n_ids: int) -> np.ndarray:
    """The u32 ids of the blocks that begin at ``starts`` (whose last entry is the end)."""
    n = len(starts) - 1
    out = np.empty((n, BLOCK), np.uint32)
    heads = [BLOCK_HEADER.unpack_from(payload, int(s)) for s in starts[:-1]]
    by_width: dict[int, list[int]] = {}
    for k, (_, w, _) in enumerate(heads):
        by_width.setdefault(w, []).append(k)
    for w, rows in by_width.items():
        size = w * BLOCK // 8
        packed = b"".join(payload[(a := int(starts[k]) + BLOCK_HEADER.size):a + size] for k in rows)
        out[rows] = _unpacked(np.frombuffer(packed, ">u8").reshape(len(rows), -1), w)
    for k, (low, w, n_over) in enumerate(heads):
        if n_over:
            at = int(starts[k]) + BLOCK_HEADER.size + w * BLOCK // 8
            where = np.frombuffer(payload, "<u2", n_over, at)
            out[k, where] = np.frombuffer(payload, "<u4", n_over, at + 2 * n_over)
        out[k] += np.uint32(low)
    return out.reshape(-1)[:n_ids]


def encode_frame(docs: list[tuple[int | None, bytes]], before: int) -> bytes:
    """A frame of (doc_id, ids) pairs; ``before`` counts the ids in front of it in its part."""
    ids = np.frombuffer(b"".join(x for _, x in docs), "<u4")
    blocks = encode_blocks(ids)
    starts = np.cumsum([0, *map(len, blocks)]).astype("<u8")
    return b"".join((
        HEADER.pack(MAGIC, BLOCK, len(ids), before, len(docs), len(blocks)),
        np.array([d or 0 for d, _ in docs], "<i8").tobytes(), np.array([len(x) // 4 for _, x in docs], "<u4").tobytes(),
        np.array([d is None for d, _ in docs], np.uint8).tobytes(), starts.tobytes(), *blocks))


def decode_frame(frame: bytes) -> tuple[int, list[tuple[int | None, np.ndarray]]]:
    """The count of ids in front of the frame, and its (doc_id, ids) pairs."""
    magic, block, n_ids, before, n_docs, n_blocks = HEADER.unpack_from(frame)
    if magic != MAGIC or block != BLOCK:
        raise ValueError("not a token-id frame of this version")
    at = HEADER.size
    doc_ids = np.frombuffer(frame, "<i8", n_docs, at).tolist()
    counts = np.frombuffer(frame, "<u4", n_docs, at := at + 8 * n_docs)
    nulls = np.frombuffer(frame, np.uint8, n_docs, at := at + 4 * n_docs).tolist()
    starts = np.frombuffer(frame, "<u8", n_blocks + 1, at := at + n_docs)
    ids = decode_blocks(frame[at + 8 * (n_blocks + 1):], starts, n_ids)
    ends = np.cumsum(counts)
    return before, [(None if z else d, ids[b - c:b]) for d, z, b, c in zip(doc_ids, nulls, ends.tolist(), counts.tolist())]


def _frames(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end, part = encoder(path), end_id.to_bytes(4, "little"), TaskContext.get().partitionId()
        docs: list[tuple[int | None, bytes]] = []
        size = before = seq = 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([size], pa.int64()),
                                               pa.array([encode_frame(docs, before)], pa.binary())], names=["part", "seq", "n_ids", "frame"])
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), enc.encode_all(texts)):
                docs.append((doc_id, ids + end))
                size += len(docs[-1][1]) // 4
                if size >= FRAME_IDS:
                    yield flush()
                    before, seq, size = before + size, seq + 1, 0
                    docs.clear()
        if docs:
            yield flush()
    return run


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Write all documents' ids, each followed by ``end_id``, to ``path`` in ascending doc_id order.

    ``docs`` needs doc_id and text. A null or empty text is the end id alone. A
    null doc_id comes first; rows that share a doc_id follow each other by a hash
    of their text, and rows that repeat are written as often as they occur. The
    range partitioning also splits by that hash, so one repeated id can't fill
    a partition unless its texts are equal. An empty table writes no frames.
    """
    n = common.shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("h"))
    ordered = rows.repartitionByRange(n, "doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    ordered.mapInArrow(_frames(tokenizer or default_tokenizer(), end_id), FRAME_SCHEMA).write.parquet(path)


def _documents(with_ids: bool):
    names = [x.split()[0] for x in DOC_SCHEMA.split(", ")]
    kinds = [pa.int32()] + [pa.int64()] * 4 + [pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, frame in zip(batch.column("part").to_pylist(), batch.column("frame")):
                at, docs = decode_frame(frame.as_py())
                rows = []
                for doc_id, ids in docs:
                    raw = ids.astype("<u4").tobytes()
                    rows.append((part, doc_id, at, len(ids), zlib.crc32(raw), raw if with_ids else None))
                    at += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)
    return run


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """The documents of a token-id table: doc_id, start, n_tokens, ids_crc32, ids.

    ``start`` counts the ids of all documents in front: each frame knows the ids
    before it in its part, and the parts' totals (one row for each partition of
    the writing job) are summed up here.
    """
    frames = spark.read.schema(FRAME_SCHEMA).parquet(path)
    totals = frames.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    docs = frames.select("part", "frame").mapInArrow(_documents(with_ids), DOC_SCHEMA)
    return docs.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32", "ids")
