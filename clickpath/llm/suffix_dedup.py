"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts somewhere
else in the corpus. Equal strings become neighbours when suffixes are sorted to
that depth, and the sort is done one bucket at a time:

1.  The bucket of a string of LENGTH bytes (a *window*) is the lowest hash of GRAM
    bytes in it, its *anchor*, so equal windows have equal buckets. Windows in a row
    of one bucket are a *run*, however often the anchor recurs in them; a run alone
    in its bucket cannot repeat unless its anchor recurs.
2.  Runs with equal text repeat as a whole; one of them stands for all in its bucket.
3.  What is left of a bucket is sorted in one task: suffixes by their first COVER
    bytes, longer ties by ranks of the suffixes at a difference cover modulo COVER,
    which are sorted beforehand to a depth of LENGTH - COVER bytes. Any two
    suffixes meet the cover at one common distance below COVER, so a tie takes one
    look at two ranks. Only the suffixes that share a leading byte are held as keys
    at a time.
4.  A bucket of more runs than ``BUCKET_RUNS``, or more bytes than ``BUCKET_BYTES``, is
    not given to one task: its windows are counted by their hash over the cluster, each
    once for a run it repeats in.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpath.llm import common
from clickpath.sources.tables import broadcast_if_small

LENGTH = 400

# For passages given in words: a window of PASSAGE_LENGTH bytes fits into PASSAGE_WORDS
# words of three bytes on average and the blanks between them.
PASSAGE_WORDS = 51
PASSAGE_LENGTH = 200

GRAM = 32
COVER = 64

# Bytes of a text whose anchors are found at once.
SPAN = 1 << 20

# Bytes of small buckets that are sorted together, and runs and their bytes that one task takes of one bucket.
SORT_BYTES = 1 << 20
BUCKET_RUNS = 20_000
BUCKET_BYTES = 16 << 20

# Rows of window hashes in one Arrow batch, and the largest table of hot buckets that is broadcast.
WINDOW_ROWS = 1 << 15
BROADCAST_BYTES = 16 << 20

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def _gram_hashes(b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each position."""
    g, width = b.astype(np.uint64) + np.uint64(1), 1
    for m in _MIX:  # doubles the width: 2, 4, 8, 16, 32
        g = g[:-width] * m + g[width:]
        width *= 2
    g ^= g >> np.uint64(29)
    g *= _MIX[0]
    return g ^ g >> np.uint64(32)


def runs(text: bytes, length: int = LENGTH) -> Iterator[tuple[int, int, int, bool]]:
    """(anchor hash, first window, number of windows, whether the anchor recurs) of each run, in order."""
    for at in range(0, len(text) - length + 1, SPAN):
        part = np.frombuffer(text, np.uint8, min(len(text), at + SPAN + length - 1) - at, at)
        low = grams = _gram_hashes(part)
        inside, width = length - GRAM + 1, 1
        while 2 * width <= inside:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < inside:
            low = np.minimum(low[:width - inside], low[inside - width:])
        starts = np.concatenate([[0], np.flatnonzero(low[1:] != low[:-1]) + 1])
        sizes = np.diff(np.append(starts, len(low)))
        ends = starts + sizes + inside - 1
        recurs = [np.count_nonzero(grams[a:b] == v) > 1 for a, b, v in zip(starts.tolist(), ends.tolist(), low[starts])]
        yield from zip(low[starts].view(np.int64).tolist(), (starts + at).tolist(), sizes.tolist(), recurs)


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


RUN_SCHEMA = "key long, same long, doc_id long, h long, start int, n int, recurs boolean"


def _runs(length: int):
    kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.bool_()]
    names = [x.split()[0] for x in RUN_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in common.text_batches(batches):
            rows = [(key, _signed(xxhash.xxh3_64_intdigest(text[start:start + n - 1 + length])), doc_id, h, start, n, recurs)
                    for doc_id, h, text in zip(batch.column("doc_id").to_pylist(), batch.column("h").to_pylist(), texts)
                    for key, start, n, recurs in runs(text, length)]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows) if rows else [[]] * 7, kinds)], names=names)
    return run


def _cover() -> np.ndarray:
    """A difference cover modulo COVER = s * s: 0 ... s - 1 and the multiples of s."""
    s = int(COVER ** 0.5)
    inside = np.zeros(COVER, bool)
    inside[:s] = inside[::s] = True
    return inside


_IN_COVER = _cover()
# _DISTANCE[a, b]: the least d with a + d and b + d in the cover.
_DISTANCE = np.array([[next(d for d in range(COVER) if _IN_COVER[(a + d) % COVER] and _IN_COVER[(b + d) % COVER])
                       for b in range(COVER)] for a in range(COVER)])


def _dense(keys: list[np.ndarray]) -> np.ndarray:
    """Ranks of rows by several keys, the first being the most significant; equal rows share a rank."""
    order = np.lexsort(keys[::-1])
    changed = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        changed[1:] |= s[1:] != s[:-1]
    ranks = np.empty(len(order), np.int32)
    ranks[order] = np.cumsum(changed, dtype=np.int32)
    return ranks


class _Text:
    """Concatenated bytes with 8-byte big-endian words at any position."""

    def __init__(self, data: bytes) -> None:
        padded = data + bytes(LENGTH + COVER + 8)
        self._words = np.ndarray((len(padded) - 7,), ">u8", padded, 0, (1,))

    def word(self, at: np.ndarray, k: int) -> np.ndarray:
        """The k-th word behind each position."""
        return self._words[at + 8 * k].astype(np.uint64)

    def ranks(self, at: np.ndarray) -> np.ndarray:
        """Ranks of positions by their COVER bytes, one word in memory at a time, the last first."""
        order = np.arange(len(at), dtype=np.int32)
        for k in reversed(range(COVER // 8)):
            order = order[np.argsort(self.word(at[order], k), kind="stable")]
        changed = np.zeros(len(at), bool)
        for k in range(COVER // 8):
            w = self.word(at[order], k)
            changed[1:] |= w[1:] != w[:-1]
        out = np.empty(len(at), np.int32)
        out[order] = np.cumsum(changed, dtype=np.int32)
        return out


def _cover_ranks(text: _Text, n: int, depth: int) -> np.ndarray:
    """At each cover position below ``n`` the rank of its ``depth`` bytes, by doubling from COVER bytes."""
    at = np.flatnonzero(np.resize(_IN_COVER, n)).astype(np.int32)
    place = np.full(n + depth + COVER, len(at), np.int32)  # len(at): past the end
    place[at] = np.arange(len(at), dtype=np.int32)

    def beyond(ranks: np.ndarray, by: int) -> np.ndarray:
        return np.append(ranks, np.int32(-1))[place[at + by]]

    ranks = {COVER: text.ranks(at)}
    width = COVER
    while 2 * width <= depth:
        ranks[2 * width] = _dense([ranks[width], beyond(ranks[width], width)])
        width *= 2
    keys, done = [ranks[width]], width
    while depth - done >= COVER:
        step = max(w for w in ranks if w <= depth - done)
        keys.append(beyond(ranks[step], done))
        done += step
    if done < depth:  # what a whole COVER does not reach: the last COVER bytes, overlapping
        keys.append(text.ranks(at + (depth - COVER)))
    out = np.full(n, -1, np.int32)
    out[at] = _dense(keys)
    return out


def repeated_windows(snippets: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each snippet, which of its windows of ``length`` bytes occur more than once among all snippets."""
    if length < 2 * COVER:
        raise ValueError(f"the length must be at least {2 * COVER}")
    begins = np.cumsum([0, *map(len, snippets)])
    data = b"".join(snippets)
    n, text, first_byte = len(data), _Text(data), np.frombuffer(data, np.uint8)
    ranks = _cover_ranks(text, n, length - COVER)
    starts = np.concatenate([np.arange(b, b + max(0, len(s) - length + 1), dtype=np.int32) for b, s in zip(begins, snippets)])
    twice = np.zeros(n, bool)
    by_byte = starts[np.argsort(first_byte[starts], kind="stable")]
    edges = np.flatnonzero(np.diff(first_byte[by_byte].astype(int))) + 1
    for bucket in np.split(by_byte, edges):  # one suffix bucket at a time
        _sort_bucket(text, ranks, bucket, length, twice)
    return [twice[b:b + max(0, len(s) - length + 1)] for b, s in zip(begins, snippets)]


def _sort_bucket(text: _Text, ranks: np.ndarray, at: np.ndarray, length: int, twice: np.ndarray) -> None:
    """Sort the suffixes at ``at`` to ``length`` bytes and mark those equal to another.

    Suffixes that tie on COVER bytes are partitioned again and again around a
    pivot of their group, all groups at once, by their cover ranks and, if these
    tie, by their last COVER bytes.
    """
    group = text.ranks(at)
    while len(at):
        order = np.argsort(group, kind="stable")
        at, group = at[order], group[order]
        new = np.concatenate([[True], group[1:] != group[:-1]])
        label = np.cumsum(new) - 1
        size = np.bincount(label)
        ties = size[label] > 1
        if not ties.any():
            return
        heads = np.flatnonzero(new)
        middle = (heads + size // 2)[label]  # the pivot of each group
        at, pivot, label = at[ties], at[middle][ties], label[ties]
        d = _DISTANCE[at % COVER, pivot % COVER]
        side = np.sign(ranks[at + d] - ranks[pivot + d])
        level = np.flatnonzero(side == 0)
        for k in range(COVER // 8):
            a, b = text.word(at[level] + (length - COVER), k), text.word(pivot[level] + (length - COVER), k)
            s = side[level]
            side[level] = np.where(s == 0, (a > b).astype(np.int64) - (a < b), s)
        same = side == 0
        alike = np.bincount(label[same], minlength=label.max() + 1)
        twice[at[same & (alike[label] > 1)]] = True
        at, group = at[~same], (3 * label + side)[~same]


def _ranges(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each stretch of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], marked, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2] - 1


RANGE_SCHEMA = "doc_id long, h long, start int, stop int"
SNIPPET_SCHEMA = "key long, many boolean, hot boolean, doc_id long, h long, start int, snippet binary"


def _snippets(length: int):
    kinds = [pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    names = [x.split()[0] for x in SNIPPET_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in common.text_batches(batches):
            rows = [(r["key"], r["many"], r["hot"], doc_id, h, r["start"], text[r["start"]:r["start"] + r["n"] - 1 + length])
                    for doc_id, h, wanted, text in zip(batch.column("doc_id").to_pylist(), batch.column("h").to_pylist(), batch.column("wanted").to_pylist(), texts)
                    for r in wanted]
            for k in range(0, len(rows), 4 * common.BATCH_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[k:k + 4 * common.BATCH_ROWS]), kinds)], names=names)
    return run


def _sorted_buckets(length: int):
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    names = [x.split()[0] for x in RANGE_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ready(rows: list[tuple]) -> pa.RecordBatch:
            found = []
            for (_, many, doc_id, h, start, _), marked in zip(rows, repeated_windows([r[-1] for r in rows], length)):
                if not many:  # a run that repeats as a whole is known already
                    found += [(doc_id, h, start + a, start + b + length) for a, b in zip(*(x.tolist() for x in _ranges(marked)))]
            pa.default_memory_pool().release_unused()
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*found) if found else [[]] * 4, kinds)], names=names)

        rows, size = [], 0
        for batch in batches:  # sorted by key
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "many", "doc_id", "h", "start", "snippet"))):
                if size > SORT_BYTES and row[0] != rows[-1][0]:
                    yield ready(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[-1])
        if rows:
            yield ready(rows)
    return run


WINDOW_SCHEMA = "w binary, n int, doc_id long, h long, start int, stop int"


def _window_hashes(length: int):
    """Each distinct window of a run with its hash, its count in the run and its first place.

    Stretches of windows that the run itself holds more than once have rows without a hash.
    """
    kinds = [pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    names = [x.split()[0] for x in WINDOW_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, h, start, snippet in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "h", "start", "snippet"))):
                found = [xxhash.xxh3_128_digest(snippet[k:k + length]) for k in range(len(snippet) - length + 1)]
                count, first = Counter(found), {}
                for k, w in enumerate(found):
                    first.setdefault(w, k)
                rows = [(w, n, doc_id, h, start + first[w], start + first[w] + length) for w, n in count.items()]
                if len(count) < len(found):
                    twice = np.fromiter((count[w] > 1 for w in found), bool, len(found))
                    rows += [(None, None, doc_id, h, start + a, start + b + length) for a, b in zip(*(x.tolist() for x in _ranges(twice)))]
                for at in range(0, len(rows), WINDOW_ROWS):
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows[at:at + WINDOW_ROWS]), kinds)], names=names)
    return run


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))


def _same_document(left: str, right: str) -> Column:
    return (F.col(f"{left}.h") == F.col(f"{right}.h")) & F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id"))


def repeated_ranges(docs: DataFrame, length: int = LENGTH, bucket_runs: int = BUCKET_RUNS) -> DataFrame:
    """(doc_id, h, start, stop): byte ranges that repeated windows cover; they may overlap. h is xxhash64 of the text."""
    spark = docs.sparkSession
    keyed = _keyed(docs)
    long_enough = keyed.filter(F.octet_length("text") >= length)
    everything = common.materialise(long_enough.mapInArrow(_runs(length), RUN_SCHEMA), "runs")
    # Buckets that may hold a window twice: those of more than one run, or of a run in which the
    # anchor recurs. "mixed" ones need a look at the text: their runs differ, or repeat inside.
    buckets = everything.groupBy("key").agg(
        F.count(F.lit(1)).alias("total"), ((F.min("same") != F.max("same")) | F.max("recurs")).alias("mixed"))
    # Stored, so that the join reads plain shuffles on both sides and a hot bucket's runs can be split.
    buckets = common.materialise(buckets.filter("total > 1 OR mixed").select("key", "mixed"), "shared-buckets")
    shared = common.materialise(everything.join(buckets, "key"), "shared-runs")
    common.discard(everything)
    # Runs of one text repeat as a whole; only mixed buckets need a look at the texts.
    stop = (F.col("start") + F.col("n") - 1 + length).alias("stop")
    alike, mixed_runs = shared.filter("NOT mixed"), shared.filter("mixed")
    texts = mixed_runs.groupBy("key", "same").agg(
        (F.count(F.lit(1)) > 1).alias("many"), F.min(F.struct("doc_id", "h", "start", "n")).alias("one"))
    mixed = common.materialise(texts, "run-texts")
    again = mixed_runs.join(mixed.filter("many").select("key", "same"), ["key", "same"], "left_semi")
    whole = alike.select("doc_id", "h", "start", stop).union(again.select("doc_id", "h", "start", stop))
    # One run of each text in a mixed bucket, with its bytes.
    n_bytes = F.sum((F.col("one.n") - 1 + length).cast("long"))
    hot = mixed.groupBy("key").agg(F.count(F.lit(1)).alias("n_runs"), n_bytes.alias("n_bytes")).filter(
        (F.col("n_runs") > bucket_runs) | (F.col("n_bytes") > BUCKET_BYTES))
    hot = common.materialise(hot.select("key", F.lit(True).alias("hot")), "hot-buckets")
    marked = mixed.join(broadcast_if_small(hot, BROADCAST_BYTES), "key", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    wanted = marked.groupBy(F.col("one.doc_id").alias("doc_id"), F.col("one.h").alias("h")).agg(
        F.collect_list(F.struct("key", "many", "hot", F.col("one.start").alias("start"), F.col("one.n").alias("n"))).alias("wanted"))
    # Rows that repeat are fetched each, which changes nothing: all their runs are known to repeat.
    fetched = long_enough.alias("d").join(wanted.alias("w"), _same_document("d", "w")).select("d.doc_id", "d.h", "d.text", "w.wanted")
    snippets = common.materialise(fetched.mapInArrow(_snippets(length), SNIPPET_SCHEMA), "snippets")
    dealt = snippets.filter("NOT hot").repartition(common.shuffle_partitions(spark), "key").sortWithinPartitions("key")
    sorted_ = dealt.mapInArrow(_sorted_buckets(length), RANGE_SCHEMA)
    windows = snippets.filter("hot").mapInArrow(_window_hashes(length), WINDOW_SCHEMA)
    hashed = windows.filter("w IS NOT NULL")
    common_windows = hashed.groupBy("w").agg(F.sum("n").alias("n")).filter("n > 1").select("w")
    counted = hashed.join(common_windows, "w", "left_semi").union(windows.filter("w IS NULL")).select("doc_id", "h", "start", "stop")
    return whole.union(sorted_).union(counted)


def _collected(ranges: DataFrame) -> DataFrame:
    """(doc_id, h, ranges): a document's ranges in order, each as start * 2^32 + stop."""
    packed = F.shiftleft(F.col("start").cast("long"), 32).bitwiseOR(F.col("stop").cast("long"))
    return ranges.groupBy("doc_id", "h").agg(F.array_sort(F.collect_set(packed)).alias("ranges"))


def _merged(ranges: list[int] | None) -> list[tuple[int, int]]:
    """Ordered ranges as maximal runs; ranges that touch are one run."""
    out: list[tuple[int, int]] = []
    for r in ranges if ranges is not None else ():
        start, stop = int(r) >> 32, int(r) & 0xFFFFFFFF
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


OUT_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _cut(with_kept: bool):
    kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
    names = [x.split()[0] for x in OUT_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in common.text_batches(batches):
            rows = []
            for doc_id, ranges, text in zip(batch.column("doc_id").to_pylist(), batch.column("ranges").to_pylist(), texts):
                spans, at, parts = _merged(ranges), 0, []
                for start, stop in spans:
                    parts.append(text[at:start])
                    at = stop
                kept = b"".join([*parts, text[at:]])
                rows.append((doc_id, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept if with_kept else None))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows) if rows else [[]] * 6, kinds)], names=names)
    return run


def dedup(docs: DataFrame, length: int = LENGTH, with_kept: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept.

    ``docs`` needs doc_id and text; other columns are ignored. Each byte goes that
    is covered by a string of ``length`` bytes which also starts anywhere else in
    the corpus, the same document included; strings are judged on the input, so
    all occurrences go. Matches never cross documents. n_spans counts maximal
    removed runs, kept holds the remaining bytes (they need not be valid UTF-8).
    A null text is empty; rows that repeat are occurrences of each other; rows
    that share an id are told apart by their text. An empty table gives no rows.
    """
    found = _collected(repeated_ranges(docs, length))
    marked = _keyed(docs).alias("d").join(found.alias("r"), _same_document("d", "r"), "left")
    return marked.select("d.doc_id", "d.text", "r.ranges").mapInArrow(_cut(with_kept), OUT_SCHEMA)


def _whole_words(raw: bytes, start: int, stop: int) -> int:
    """How many words (runs of bytes other than white space) lie in raw[start:stop] from end to end."""
    n = len(raw[start:stop].split())
    cut_first = start > 0 and not raw[start - 1:start].isspace() and not raw[start:start + 1].isspace()
    cut_last = stop < len(raw) and not raw[stop - 1:stop].isspace() and not raw[stop:stop + 1].isspace()
    return max(0, n - cut_first - cut_last)


def cleaned(docs: DataFrame, length: int = LENGTH, min_words: int = 0) -> DataFrame:
    """``docs`` with the repeated bytes cut out of text; all columns are kept.

    Only maximal repeated stretches that hold ``min_words`` whole words are cut. Where a cut
    splits a character, its remaining bytes are dropped too, so the text stays valid. A row
    whose text is all repeated stays with an empty text; a null text stays null.
    """
    owner, h, ranges = (common.fresh(docs, n) for n in ("range_owner", "range_h", "ranges"))
    found = _collected(repeated_ranges(docs, length)).toDF(owner, h, ranges)

    @F.pandas_udf("string")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, lists in batches:
            out = []
            for text, spans in zip(texts, lists):
                if text is not None and spans is not None:
                    raw, at, parts = text.encode(), 0, []
                    for start, stop in _merged(spans):
                        if min_words and _whole_words(raw, start, stop) < min_words:
                            continue
                        parts.append(raw[at:start].decode("utf-8", "ignore"))
                        at = stop
                    text = "".join(parts) + raw[at:].decode("utf-8", "ignore")
                out.append(text)
            yield pd.Series(out, dtype=object)

    same = F.col("doc_id").cast("long").eqNullSafe(F.col(owner)) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(h))
    marked = docs.join(found, same, "left")
    return marked.withColumn("text", cut(F.col("text"), F.col(ranges))).select(*docs.columns)
