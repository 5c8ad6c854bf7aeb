"""Packing by power-of-two decomposition.

A document's token ids, with an end id, are cut into pieces whose lengths are
powers of two: as many pieces of the full sequence length as fit, then one piece
for each binary digit of the rest, longest first. Each piece is a sequence of its
own, so no sequence crosses documents and none needs padding; sequences of equal
length are numbered side by side, so that a batch is drawn from one bucket.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpath.llm import common
from clickpath.llm.tokens import default_tokenizer, encoder

SEQUENCE_TOKENS = 2048
END_ID = 1

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


def piece_lengths(n: int, longest: int) -> list[int]:
    """``n`` as full pieces of ``longest`` (a power of two) and the binary digits of the rest."""
    rest = n % longest
    digits = [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]
    return [longest] * (n // longest) + digits


def _pieces(path: str, end_id: int, longest: int, with_ids: bool):
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(path), end_id.to_bytes(4, "little")
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            texts = [x or "" for x in batch.column("text").to_pylist()]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), enc.encode_all(texts)):
                ids += end
                start = 0
                for length in piece_lengths(len(ids) // 4, longest):
                    piece = ids[4 * start:4 * (start + length)]
                    for out, value in zip(rows, (doc_id, start, length, zlib.crc32(piece), len(ids) // 4,
                                                 piece if with_ids else None)):
                        out.append(value)
                    start += length
            kinds = [pa.int64()] * 5 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, kinds)], names=names)
    return run


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID,
         longest: int = SEQUENCE_TOKENS, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, ids, sequence_id, offset.

    ``docs`` needs doc_id and text; other columns are ignored. A null or empty
    text is the end id alone, and rows that repeat (or share a doc_id) are packed
    each on its own. An empty table gives no rows. ``ids`` holds little-endian
    unsigned 32-bit ids (null without ``with_ids``). ``sequence_id`` is gapless
    over all sequences, one length bucket after the other, longest first; ``offset``
    is 0, as a piece fills its sequence.

    The pieces are stored once and numbered through bucket counts, so nothing
    grows in one task but a single document.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the sequence length must be a power of two")
    made = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _pieces(tokenizer or default_tokenizer(), end_id, longest, with_ids), SCHEMA)
    pieces = common.materialise(made, "pack")
    # at most log2(longest) + 1 lengths
    sizes = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = common.gapless(pieces, ["length"], ["doc_id", "start", "ids_crc32"], "number")
    return numbered.join(F.broadcast(bases), "length").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids",
        (F.col("base") + F.col("number")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
