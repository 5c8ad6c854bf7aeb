"""The prefix trie of conversations, from member intervals over sorted LCPs.

Conversations are sequences of turns (role, text), each turn an MD5. Sorted sequences
that share a prefix stand side by side, and the length of the common prefix (LCP) of
each with the one before tells how much they share. The members of a prefix of length d are
the interval around any of them in which all LCPs are d or more; its two ends are
found by binary search over a sparse table of range minima, for each candidate prefix on its
own. The smallest member is a range minimum over the identifiers, from a table of the same kind.

Nothing needs all sequences in one place. Sequences are cut into *segments* of SEGMENT turns, each
with the key of the prefix before it as its *context*; segments sorted by context and turns are
worked on in blocks, and a block gives each prefix's members in it. Members of prefixes that several
blocks share are added up by the prefix's key. Sums over subtrees are taken
by doubling: after k rounds a node has the sums of its descendants less than 2^k levels below.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpath.llm import common
from clickpath.sources.tables import broadcast_if_small

# Turns of a segment, and of the segments that are sorted together.
SEGMENT = 256
BLOCK_TURNS = 1 << 17

HASH = 16
ROOT = hashlib.md5(b"").digest()

# Of every FAMILY identifiers the first lends its opening turns to the others, fewer than OPENINGS.
FAMILY, OPENINGS = 20, 4

# Identifiers that are joined to one text at a time.
IDS_AT_ONCE = 1 << 14

BROADCAST_BYTES = 16 << 20


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, h, words) of each turn: the MD5 of role and text, null ones as empty, and the text's words."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("h"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))


def ranked(turns: DataFrame) -> DataFrame:
    """``turns`` with the place ``k`` of each in its conversation, by turn (null first), then by h.

    Rows are range-partitioned by their order, so a conversation of most rows is spread over
    partitions; places are counted within a partition, and those before it are added.
    """
    n = common.shuffle_partitions(turns.sparkSession)
    ordered = turns.repartitionByRange(n, "conv_id", "turn", "h").sortWithinPartitions("conv_id", "turn", "h")
    stored = common.materialise(ordered.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "turns")
    sizes = stored.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Only conversations that go on in another partition: a few for each partition.
    later = sizes.withColumn("skipped", F.sum("n").over(before)).filter("skipped > 0").select("conv_id", "part", "skipped")
    later = common.materialise(later, "later-turns")
    within = Window.partitionBy("conv_id", "part").orderBy("at")
    placed = stored.withColumn("k", F.row_number().over(within) - 1).join(broadcast_if_small(later, BROADCAST_BYTES), ["conv_id", "part"], "left")
    return placed.select("conv_id", (F.col("k") + F.coalesce("skipped", F.lit(0))).cast("long").alias("k"), "h", "words")


def openings(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string")) % OPENINGS


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, h, words) of the turns of rebuilt conversations, and the conv_ids of all.

    Conversation c begins with the first h turns of conversation c - c % FAMILY (all if
    it has fewer, none if it doesn't exist) and goes on with its own after its first h.
    """
    turns = common.materialise(ranked(turns_of(conversations)), "ranked-turns")
    ids = common.materialise(turns.select("conv_id").distinct(), "conversation-ids")
    heads = common.materialise(turns.filter((F.col("k") < OPENINGS) & (F.col("conv_id") % FAMILY == 0)).withColumnRenamed("conv_id", "base"), "opening-turns")
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    lent = ids.withColumn("base", first).join(heads, "base").filter(F.col("k") < openings(F.col("conv_id")))
    lengths = common.materialise(heads.groupBy("base").agg(F.count(F.lit(1)).alias("held")), "opening-lengths")
    own = turns.filter(F.col("k") >= openings(F.col("conv_id"))).withColumn("base", first)
    own = own.join(broadcast_if_small(lengths, BROADCAST_BYTES), "base", "left")
    h = openings(F.col("conv_id"))
    own = own.withColumn("pos", F.col("k") - h + F.least(h, F.coalesce("held", F.lit(0))))
    both = lent.select("conv_id", F.col("k").alias("pos"), "h", "words").union(own.select("conv_id", "pos", "h", "words"))
    return both, ids


SEGMENT_SCHEMA = "conv_id long, seg long, context binary, hashes binary, words array<long>, last boolean"


def _batch(rows: list[tuple], schema: str, kinds: list[pa.DataType]) -> pa.RecordBatch:
    names = [x.split()[0] for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)], names=names)


_SEGMENT_KINDS = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.bool_()]


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The contexts of segments that come sorted by conv_id and seg; one segment is held back to see if it is the last."""
    held, context = None, ROOT
    for batch in batches:
        rows = []
        for conv_id, seg, hashes, words in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "seg", "hashes", "words"))):
            if held is not None:
                rows.append((*held, held[0] != conv_id))
            context = ROOT if seg == 0 else hashlib.md5(held[2] + held[3]).digest()
            held = (conv_id, seg, context, hashes, words)
        if rows:
            yield _batch(rows, SEGMENT_SCHEMA, _SEGMENT_KINDS)
    if held is not None:
        yield _batch([(*held, True)], SEGMENT_SCHEMA, _SEGMENT_KINDS)


def segments(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Rows of SEGMENT_SCHEMA: up to ``segment`` turns of a conversation, and the key of what comes before them.

    Only conversations of several segments go through a task by themselves, one segment
    held at a time.
    """
    grouped = turns.groupBy("conv_id", F.floor(F.col("pos") / segment).alias("seg")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "h", "words"))).alias("turns"))  # at most ``segment`` of them
    made = grouped.select("conv_id", "seg", F.unhex(F.array_join(F.col("turns")["h"], "")).alias("hashes"), F.col("turns")["words"].alias("words"))
    made = common.materialise(made, "segments")
    long = common.materialise(made.filter("seg > 0").select("conv_id").distinct(), "long-conversations")
    short = made.join(broadcast_if_small(long, BROADCAST_BYTES), "conv_id", "left_anti").select(
        "conv_id", "seg", F.lit(ROOT).alias("context"), "hashes", "words", F.lit(True).alias("last"))
    n = common.shuffle_partitions(turns.sparkSession)
    chained = made.join(broadcast_if_small(long, BROADCAST_BYTES), "conv_id", "left_semi").repartition(n, "conv_id").sortWithinPartitions("conv_id", "seg")
    return short.union(chained.mapInArrow(_chained, SEGMENT_SCHEMA))


def sparse_minima(values: np.ndarray) -> list[np.ndarray]:
    """Table k has at each place the least of the 2^k values from there."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        w = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-w], table[-1][w:]))
    return table


def extents(lcp: np.ndarray, row: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row that share the prefix of ``depth`` of each ``row``.

    ``lcp`` has the common prefix of each row with the one before. Both ends move by
    falling powers of two as long as the range minimum allows.
    """
    table = sparse_minima(lcp)
    left, right = row.copy(), row.copy()
    for k in reversed(range(len(table))):
        w, low = 1 << k, table[k]
        at = right + 1
        right += w * ((at + w <= len(lcp)) & (low[np.minimum(at, len(low) - 1)] >= depth))
        at = left - w + 1
        left -= w * ((left >= w) & (low[np.maximum(at, 0)] >= depth))
    return left, right


def range_minima(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    table = sparse_minima(values)
    k = np.log2(right - left + 1).astype(np.int64)
    out = np.empty(len(left), values.dtype)
    for j in np.unique(k):
        of = k == j
        out[of] = np.minimum(table[j][left[of]], table[j][right[of] - (1 << j) + 1])
    return out


def common_prefixes(contexts: list[bytes], turns: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """LCP of each sequence with the one before, 0 for the first and where contexts differ; ``turns`` holds all their hashes."""
    out = np.zeros(len(sizes), np.int64)
    same = np.array([False] + [a == b for a, b in zip(contexts, contexts[1:])])
    n = np.where(same, np.minimum(sizes, np.concatenate([[0], sizes[:-1]])), 0)
    begins = np.cumsum(sizes) - sizes
    at = np.flatnonzero(n)
    if not len(at):
        return out
    m = n[at]
    first = np.cumsum(m) - m
    place = np.arange(m.sum()) - np.repeat(first, m)
    apart = turns[np.repeat(begins[at], m) + place] != turns[np.repeat(begins[at - 1], m) + place]
    out[at] = np.minimum.reduceat(np.where(apart, place, np.iinfo(np.int64).max), first)
    out[at] = np.minimum(out[at], m)
    return out


NODE_SCHEMA = "key binary, parent binary, depth long, words long, n_convs long, conv_id long"
_NODE_KINDS = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]


def block_nodes(rows: list[tuple], segment: int) -> list[tuple]:
    """Rows of NODE_SCHEMA: the prefixes in sorted segments (conv_id, seg, context, hashes, words) and their members among these.

    Rows without a parent say which prefix a conversation ends with: (key, null, depth, 0, 1, conv_id).
    """
    sizes = np.array([len(r[3]) // HASH for r in rows])
    _, turns = np.unique(np.frombuffer(b"".join(r[3] for r in rows), f"V{HASH}"), return_inverse=True)
    lcp = common_prefixes([r[2] for r in rows], turns, sizes)
    row = np.repeat(np.arange(len(rows)), sizes)
    depth = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
    left, right = extents(lcp, row, depth)
    least = range_minima(np.array([r[0] for r in rows]), left, right)
    new = left == row  # each prefix once, at its first row
    members, least = (right - left + 1)[new].tolist(), least[new].tolist()
    made, k = [], 0
    for i, (conv_id, seg, context, hashes, words, last) in enumerate(rows):
        shared = int(lcp[i])
        chain = hashlib.md5(context + hashes[:shared * HASH])
        parent = chain.digest() if shared else context
        for d in range(shared, int(sizes[i])):
            chain.update(hashes[d * HASH:(d + 1) * HASH])
            key = chain.digest()
            made.append((key, parent, seg * segment + d + 1, words[d], members[k], least[k]))
            parent, k = key, k + 1
        if last:
            made.append((parent, None, seg * segment + int(sizes[i]), 0, 1, conv_id))
    return made


def _blocks(segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "seg", "context", "hashes", "words", "last"))):
                rows.append(r)
                size += len(r[3]) // HASH
                if size >= BLOCK_TURNS:
                    yield _batch(block_nodes(rows, segment), NODE_SCHEMA, _NODE_KINDS)
                    rows, size = [], 0
        if rows:
            yield _batch(block_nodes(rows, segment), NODE_SCHEMA, _NODE_KINDS)
    return run


def subtree_sums(nodes: DataFrame, names: list[str]) -> DataFrame:
    """``nodes`` (key, parent, and the numbers ``names``) of a tree with the root ROOT as (key, names): each
    summed over the node's subtree.

    As many rounds as the logarithm of the depth, each stored. Sums are combined before they
    are shuffled, so a node of very many children is no hot group.
    """
    acc = common.materialise(nodes.select("key", F.col("parent").alias("up"), *names), "subtrees")
    while not acc.filter(F.col("up").isNotNull()).isEmpty():
        below = acc.filter(F.col("up").isNotNull()).groupBy(F.col("up").alias("key")).agg(*(F.sum(n).alias(n + "_below") for n in names))
        beyond = acc.select(F.col("key").alias("up"), F.col("up").alias("beyond"))
        # Nodes that stand below the root, or have nothing left to jump to, are very many and need no join.
        far = F.col("up").isNotNull() & (F.col("up") != F.lit(ROOT))
        jumped = acc.filter(far).join(beyond, "up").select("key", F.col("beyond").alias("up"), *names).union(
            acc.filter(~far).select("key", F.lit(None).cast("binary").alias("up"), *names))
        acc = common.materialise(jumped.join(below, "key", "left").select(
            "key", "up", *((F.col(n) + F.coalesce(n + "_below", F.lit(0))).alias(n) for n in names)), "subtrees")
    return acc.select("key", *names)


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted identifiers of a key as comma-joined texts of up to IDS_AT_ONCE."""
    key, ids = None, []
    for batch in batches:
        rows = []
        for k, conv_id in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (k != key or len(ids) >= IDS_AT_ONCE):
                rows.append((key, ids[0], ",".join(map(str, ids))))
                ids = []
            key = k
            ids.append(conv_id)
        if rows:
            yield _batch(rows, "key binary, first long, ids string", [pa.binary(), pa.int64(), pa.string()])
    if ids:
        yield _batch([(key, ids[0], ",".join(map(str, ids)))], "key binary, first long, ids string", [pa.binary(), pa.int64(), pa.string()])


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each key's texts, which come sorted; only the hash's state is held."""
    key, state = None, None
    for batch in batches:
        rows = []
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if k != key:
                if state is not None:
                    rows.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if rows:
            yield _batch(rows, "key binary, ends_sha256 string", [pa.binary(), pa.string()])
    if state is not None:
        yield _batch([(key, state.hexdigest())], "key binary, ends_sha256 string", [pa.binary(), pa.string()])


def ends(ended: DataFrame) -> DataFrame:
    """(key, ends_sha256) of (key, conv_id) rows: the SHA-256 of the conv_ids in order.

    Identifiers are joined to long texts where they lie in order, whatever key has most
    of them; only these texts go to one place for each key, where they are hashed as they pass.
    """
    n = common.shuffle_partitions(ended.sparkSession)
    texts = ended.repartitionByRange(n, "key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(
        _joined_ids, "key binary, first long, ids string")
    return texts.repartition(n, "key").sortWithinPartitions("key", "first").mapInArrow(_hashed_ids, "key binary, ends_sha256 string")


def trie(turns: DataFrame, ids: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per distinct prefix of the sequences: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns``: conv_id, pos (gapless from 0), h (MD5 in hexadecimal digits), words; ``ids``: all
    conv_ids, each once, those without turns too. The root is the prefix without turns. saved_tokens
    adds up (n_convs - 1) * words of the last turn over the subtree. Without conversations there are no rows.
    """
    spark = turns.sparkSession
    n = common.shuffle_partitions(spark)
    cut = segments(turns, segment)
    placed = cut.repartitionByRange(n, "context", "hashes", "conv_id").sortWithinPartitions("context", "hashes", "conv_id")
    found = common.materialise(placed.mapInArrow(_blocks(segment), NODE_SCHEMA), "trie-parts")
    root = ids.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0").select(
        F.lit(ROOT).alias("key"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("words"), "n_convs", "conv_id")
    inner = found.filter(F.col("parent").isNotNull()).groupBy("key").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("words").alias("words"),
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    nodes = common.materialise(inner.union(root), "trie-nodes")
    children = nodes.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    nodes = common.materialise(nodes, "trie-nodes")
    sums = subtree_sums(nodes.select("key", "parent", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
                                     ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")), ["n_leaves", "saved_tokens"])
    ended = found.filter(F.col("parent").isNull()).select("key", "conv_id")
    turnless = ids.join(ended.select("conv_id"), "conv_id", "left_anti").select(F.lit(ROOT).alias("key"), "conv_id")
    hashed = ends(common.materialise(ended.union(turnless), "trie-ends"))
    # The root is the parent of very many nodes, so it meets them as a single broadcast row.
    above = nodes.filter(F.col("key") != F.lit(ROOT)).select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    first = F.col("parent") == F.lit(ROOT)
    deeper = nodes.filter(F.col("parent").isNotNull() & ~first).join(above, "parent").select(*nodes.columns, "parent_conv_id")
    top = nodes.filter(first).join(F.broadcast(root.select(F.lit(ROOT).alias("parent"), F.col("conv_id").alias("parent_conv_id"))), "parent")
    placed = deeper.union(top.select(*nodes.columns, "parent_conv_id")).union(
        nodes.filter(F.col("parent").isNull()).withColumn("parent_conv_id", F.lit(None).cast("long")))
    return placed.join(sums, "key").join(hashed, "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def shared_prefixes(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt ``conversations`` (conv_id, turn, role, text).

    Turns are in order of turn, null first, then of the MD5 of role and text; a null role or text is
    empty. Rows without a conv_id belong to no conversation and are left out. Rows that repeat are
    turns like any others. Other columns are ignored; an empty table gives no rows.
    """
    turns, ids = rebuilt(conversations)
    return trie(turns, ids)


def oracle_sql() -> str:
    """DuckDB SQL of the query: prefixes as concatenated MD5s, subtrees by comparing their beginnings."""
    crc = ("xor(4294967295::UBIGINT, list_reduce(list_concat([4294967295::UBIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''), "
           "lambda c: [ascii(c)::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT]))), "
           "lambda s, x: xor(xor(s, x) >> 1, (xor(s, x) & 1::UBIGINT) * 3988292384::UBIGINT)))")
    return f"""
WITH t AS (SELECT conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS h,
                  len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words
           FROM conversations WHERE conv_id IS NOT NULL),
     o AS (SELECT conv_id, h, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, h) - 1 AS k FROM t),
     c AS (SELECT conv_id, conv_id - conv_id % {FAMILY} AS base, ({crc} % {OPENINGS})::BIGINT AS take FROM (SELECT DISTINCT conv_id FROM t)),
     held AS (SELECT c.conv_id, c.take, count(o.k) AS n FROM c LEFT JOIN o ON o.conv_id = c.base AND o.k < c.take GROUP BY ALL),
     r AS (SELECT c.conv_id, o.k AS pos, o.h, o.words FROM c JOIN o ON o.conv_id = c.base AND o.k < c.take
           UNION ALL SELECT o.conv_id, o.k - held.take + held.n, o.h, o.words FROM o JOIN held USING (conv_id) WHERE o.k >= held.take),
     p AS (SELECT conv_id, pos + 1 AS depth, words, string_agg(h, '') OVER w AS prefix FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
           UNION ALL SELECT conv_id, 0, 0, '' FROM c),
     n AS (SELECT prefix, depth, any_value(words) AS words, min(conv_id) AS conv_id, count(*) AS n_convs FROM p GROUP BY prefix, depth),
     k AS (SELECT substr(prefix, 1, len(prefix) - 32) AS prefix, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
     m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (prefix)),
     e AS (SELECT prefix, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM p JOIN (SELECT conv_id, max(depth) AS depth FROM p GROUP BY 1) USING (conv_id, depth) GROUP BY 1),
     s AS (SELECT a.prefix, sum((b.n_children = 0)::BIGINT) AS n_leaves, sum((b.n_convs - 1) * b.words) AS saved_tokens
           FROM m a JOIN m b ON starts_with(b.prefix, a.prefix) GROUP BY 1)
SELECT m.conv_id, m.depth, up.conv_id AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM m JOIN s USING (prefix) LEFT JOIN e USING (prefix) LEFT JOIN m up ON m.depth > 0 AND up.prefix = substr(m.prefix, 1, len(m.prefix) - 32)"""
