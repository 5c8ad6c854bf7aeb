"""Membership sketch: a Bloom filter of bounded size, kept as plain rows.

A sketch has rows (word, bits): 64 bits for each word number that has one set. Sketches of the
same size merge by ``bit_or``, so one can be kept with a growing list and updated from
what is new. For a probe the words become one array of at most ``MAX_WORDS`` longs, which
reaches the tasks as a scalar subquery. A key of the list is never missed; a
key that isn't on it passes with the filter's error rate, so positives are verified exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of a sketch for each key, bits set for one, and bounds on its words of 64 bits (8 MiB at most).
BITS_PER_KEY = 12
HASHES = 4
MIN_WORDS = 1 << 8
MAX_WORDS = 1 << 20


def words_for(keys: int) -> int:
    """The words of a sketch for so many keys, a power of two within the bounds."""
    wanted = max(1, keys * BITS_PER_KEY // 64)
    return min(MAX_WORDS, max(MIN_WORDS, 1 << (wanted - 1).bit_length()))


def _places(key: Column, words: int) -> list[Column]:
    """The bits that stand for a key."""
    return [F.pmod(F.xxhash64(F.lit(i), key), F.lit(64 * words)) for i in range(HASHES)]


def build(keys: DataFrame, col: str, words: int) -> DataFrame:
    """The sketch (word, bits) of a column; null keys are left out. Combined per task before the shuffle."""
    at = keys.where(F.col(col).isNotNull()).select(F.explode(F.array(*_places(F.col(col), words))).alias("at"))
    bit = F.expr("shiftleft(1L, CAST(at & 63 AS INT))")
    return at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))


def merge(a: DataFrame, b: DataFrame) -> DataFrame:
    """The sketch of the keys of both; they must have the same number of words."""
    return a.unionByName(b).groupBy("word").agg(F.bit_or("bits").alias("bits"))


def packed(sketch: DataFrame, words: int) -> DataFrame:
    """One row with the array ``bits`` of all words of a sketch."""
    every = sketch.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    pairs = merge(sketch, every).agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("w"))   # ``words`` of them
    return pairs.select(F.col("w")["bits"].alias("bits"))


def might_hold(key: Column, bits: DataFrame, words: int) -> Column:
    """False only if a key isn't in the sketch whose ``packed`` row is ``bits``; false for null."""
    array, found = bits.scalar(), key.isNotNull()
    for at in _places(key, words):
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int"))
        found = found & (F.get(array, F.shiftright(at, 6).cast("int")).bitwiseAND(bit) != 0)
    return found
