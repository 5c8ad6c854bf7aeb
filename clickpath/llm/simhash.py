"""SimHash near-duplicates by tiled exact comparison.

Texts become 64-bit fingerprints: a bit is 1 if it is set in over half of the
hashes of a text's word shingles, repeats included. All distinct fingerprints
are then compared exactly, tile against tile, with exclusive-or and bit counts.

Two fingerprints within the radius differ, in the population counts of their four
16-bit parts, by no more than the radius altogether. So tiles are cut by ranges of these
four counts (a k-d tree over the cells of equal counts), and what can be told from the
counts is never compared: pairs of groups of tiles before anything is dealt out, then pairs of
tiles, then pairs of blocks in them. A tile travels as one row of bytes, once to each pair of
groups that its group takes part in.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpath.llm import common
from clickpath.llm.components import connected_components
from clickpath.sources.tables import broadcast_if_small

SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42

# Fingerprints in one tile, at most about so many, and tiles whose fingerprints a task holds at most.
TILE = 1 << 13
GROUP_TILES = 64

# Largest table of kept rows that is broadcast, in bytes of its stored files.
BROADCAST_BYTES = 16 << 20

# Fingerprints of a block inside a tile, and shingles whose bits are counted at once.
BLOCK = 512
COUNTED = 1 << 15


def fingerprint(text: bytes, words_in: int = SHINGLE_WORDS, seed: int = HASH_SEED) -> int:
    """The 64-bit SimHash of a UTF-8 text as an unsigned integer; 0 without words.

    A-Z are lower-cased; words are runs of bytes other than space and \\t to \\r.
    """
    words = text.lower().split()  # of bytes: exactly these letters and this white space
    if not words:
        return 0
    if len(words) <= words_in:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    line, digest = b" ".join(words), xxhash.xxh64_digest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(words) - words_in + 1].tolist()
    ends = ends[words_in - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for k in range(0, len(starts), COUNTED):
        hashes = b"".join([digest(line[a:b], seed) for a, b in zip(starts[k:k + COUNTED], ends[k:k + COUNTED])])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big")


def _fingerprints(words_in: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in common.text_batches(batches):
            prints = np.array([fingerprint(x, words_in) for x in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("h"), pa.array(prints)], names=["doc_id", "h", "fp"])
    return run


def fingerprints(docs: DataFrame, words_in: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, h, fp): each row's xxhash64 and fingerprint, as signed longs."""
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text")
    return rows.mapInArrow(_fingerprints(words_in), "doc_id long, h long, fp long")


class _Forest:
    """Union-find over numpy arrays; the root of a tree is its smallest index."""

    def __init__(self) -> None:
        self.parent = np.zeros(0, np.int64)

    def grow(self, n: int) -> int:
        """Take in ``n`` more members and return the first one's index."""
        first = len(self.parent)
        self.parent = np.concatenate([self.parent, np.arange(first, first + n)])
        return first

    def roots(self, i: np.ndarray) -> np.ndarray:
        r = self.parent[i]
        while True:
            up = self.parent[r]
            if (up == r).all():
                self.parent[i] = r
                return r
            r = up

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.roots(i), self.roots(j)
            apart = a != b
            i, j = i[apart], j[apart]
            low, high = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
            np.minimum.at(self.parent, high, low)


def _parts(fps: np.ndarray) -> np.ndarray:
    """Population counts of the four 16-bit parts."""
    return np.bitwise_count(np.ascontiguousarray(fps).view(np.uint16).reshape(-1, 4)).astype(np.int16)


def _gap(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """The least difference in part counts between a box and each of many."""
    return np.maximum(np.maximum(low - highs, lows - high), 0).sum(axis=1)


class Tile:
    """Fingerprints in blocks of near part counts, with the boxes that hold each block's counts and all."""

    def __init__(self, fps: np.ndarray) -> None:
        parts = _parts(fps)
        order = np.lexsort(parts.T[::-1])
        cells, first, counts = np.unique(parts[order], axis=0, return_index=True, return_counts=True)
        blocks = []
        for of in tile_cells(cells.astype(np.int64), counts, BLOCK):
            members = np.concatenate([order[first[c]:first[c] + counts[c]] for c in of])
            blocks += [members[k:k + BLOCK] for k in range(0, len(members), BLOCK)]
        self.fps = fps[np.concatenate(blocks)]
        self.ends = np.cumsum([0, *map(len, blocks)])
        self.low, self.high = np.stack([parts[x].min(axis=0) for x in blocks]), np.stack([parts[x].max(axis=0) for x in blocks])
        self.least, self.most = self.low.min(axis=0), self.high.max(axis=0)
        self.first = 0  # its first member in a forest

    def link(self, other: Tile, radius: int, forest: _Forest) -> int:
        """Link all fingerprints of both (or of one tile with itself) within the radius; how many pairs were compared."""
        if _gap(self.least, self.most, other.least[None], other.most[None])[0] > radius:
            return 0
        compared = 0
        for m in range(len(self.low)):
            for n in np.flatnonzero(_gap(self.low[m], self.high[m], other.low, other.high) <= radius):
                if other is self and n < m:
                    continue
                a, b = self.fps[self.ends[m]:self.ends[m + 1]], other.fps[other.ends[n]:other.ends[n + 1]]
                i, j = np.nonzero(np.bitwise_count(a[:, None] ^ b[None]) <= radius)
                compared += len(a) * len(b)
                if other is self and n == m:
                    i, j = i[i < j], j[i < j]
                forest.link(i + self.ends[m] + self.first, j + other.ends[n] + other.first)
        return compared


def tile_cells(cells: np.ndarray, counts: np.ndarray, tile: int) -> list[np.ndarray]:
    """The cells (rows of four part counts) of each leaf of a k-d tree, side by side in the order of the tree.

    A leaf holds at most ``tile`` fingerprints or one cell. Cuts are at the median of the widest part.
    """
    out, rest = [], [np.arange(len(cells))]
    while rest:
        of = rest.pop()
        if len(of) <= 1 or counts[of].sum() <= tile:
            out.append(of)
            continue
        part = np.ptp(cells[of], axis=0).argmax()
        values = cells[of, part]
        weight = np.bincount(values, counts[of])
        upto = np.cumsum(weight)
        cut = min(int(np.searchsorted(upto, upto[-1] / 2)), values.max() - 1)
        cut = max(cut, values.min())
        rest += [of[values > cut], of[values <= cut]]
    return [x for x in out if len(x)]


TILE_SCHEMA = "tile long, fps binary"


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fingerprints of each tile, which come sorted by tile, as one row."""
    def row(key: int, fps: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([np.concatenate(fps).tobytes()], pa.binary())], names=["tile", "fps"])

    open_key, fps = None, []
    for batch in batches:
        keys, fp = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("tile", "fp"))
        cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        for s, e in zip(cuts, cuts[1:]):
            if s == e:
                continue
            if open_key is not None and keys[s] != open_key:
                yield row(open_key, fps)
                fps = []
            open_key = int(keys[s])
            fps.append(fp[s:e].copy())
    if open_key is not None:
        yield row(open_key, fps)


def compared_groups(rows: Iterator[tuple[int, int, np.ndarray]], radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(a, b, pairs compared) for each pair of groups, whose rows (pair, side, fingerprints) follow each other.

    The tiles of side 0 come first and are held; those of side 1 meet them one at a time. A pair
    without side 1 is a group with itself. Of all links only a spanning forest is given.
    """
    def ended(forest: _Forest, members: list[np.ndarray], compared: int) -> tuple[np.ndarray, np.ndarray, int]:
        everything = np.concatenate(members)
        root = forest.roots(np.arange(len(everything)))
        tied = np.flatnonzero(root != np.arange(len(everything)))
        return everything[tied], everything[root[tied]], compared

    pair, forest, held, members, compared = None, _Forest(), [], [], 0
    for key, side, fps in rows:
        if pair is not None and key != pair:
            yield ended(forest, members, compared)
            forest, held, members, compared = _Forest(), [], [], 0
        pair, tile = key, Tile(fps)
        tile.first = forest.grow(len(fps))
        members.append(tile.fps)
        if side != RIGHT:
            held.append(tile)
        if side != LEFT:
            compared += sum(x.link(tile, radius, forest) for x in held)
    if pair is not None:
        yield ended(forest, members, compared)


# How a tile takes part in a pair of groups: as one of the first, one of the second, or within one group.
LEFT, RIGHT, WITHIN = 0, 1, 2


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, int, np.ndarray]]:
            for batch in batches:
                for key, side, fps in zip(batch.column("pair").to_pylist(), batch.column("side").to_pylist(), batch.column("fps")):
                    yield key, side, np.frombuffer(fps.as_py(), np.uint64)
        for a, b, compared in compared_groups(rows(), radius):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(np.zeros(len(a), np.int64))], names=["a", "b", "compared"])
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([None], pa.int64()), pa.array([compared], pa.int64())], names=["a", "b", "compared"])
    return run


def part_count(k: int) -> Column:
    return F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF))).cast("long")


def comparisons(distinct: DataFrame, radius: int = MAX_BITS, tile: int = TILE, group_tiles: int = GROUP_TILES) -> tuple[DataFrame, dict[str, int]]:
    """(a, b, compared) rows: links between distinct fingerprints (column fp), at least a spanning forest of
    each component, and the counts of pairs that were compared; and how many tiles, groups and dealt tiles there are.

    A cell is four part counts, so at most 17^4 rows of cell counts come to the driver, where they are
    cut to tiles of about ``tile`` fingerprints; a cell with more is dealt to several tiles by hash.
    """
    spark = distinct.sparkSession
    rows = distinct.select("fp", sum((part_count(k) * 17 ** k for k in range(1, 4)), part_count(0)).alias("cell"))
    found = sorted((r["cell"], r["count"]) for r in rows.groupBy("cell").count().collect())
    codes, counts = np.array([c for c, _ in found], np.int64), np.array([n for _, n in found], np.int64)
    cells = np.stack([codes // 17 ** k % 17 for k in range(4)], axis=1) if found else np.zeros((0, 4), np.int64)
    first, boxes, places = 0, [], []
    for of in tile_cells(cells, counts, tile):
        n = max(1, -(-int(counts[of].sum()) // tile)) if len(of) == 1 else 1
        places += [(int(codes[c]), first, n) for c in of]
        boxes += [(cells[of].min(axis=0), cells[of].max(axis=0))] * n
        first += n
    parts = common.shuffle_partitions(spark)
    # Smaller groups where there are few tiles, so that their pairs keep all tasks busy.
    group_tiles = max(1, min(group_tiles, -(-len(boxes) // (2 * math.isqrt(parts) + 1))))
    starts = range(0, len(boxes), group_tiles)
    low = np.array([np.min([x for x, _ in boxes[k:k + group_tiles]], axis=0) for k in starts]).reshape(-1, 4)
    high = np.array([np.max([x for _, x in boxes[k:k + group_tiles]], axis=0) for k in starts]).reshape(-1, 4)
    meets = []
    for g in range(len(low)):
        for h in (np.flatnonzero(_gap(low[g], high[g], low[g:], high[g:]) <= radius) + g).tolist():
            pair = g * len(low) + h
            meets += [(g, pair, WITHIN)] if g == h else [(g, pair, LEFT), (h, pair, RIGHT)]
    place = spark.createDataFrame(places, "cell long, first long, n long")  # a row for each cell
    tiled = rows.join(F.broadcast(place), "cell").select("fp", (F.col("first") + F.pmod(F.xxhash64("fp"), F.col("n"))).alias("tile"))
    tiles = common.materialise(tiled.repartition(parts, "tile").sortWithinPartitions("tile").mapInArrow(_tiles, TILE_SCHEMA), "simhash-tiles")
    plan = spark.createDataFrame(meets, "group long, pair long, side int")
    dealt = tiles.withColumn("group", F.floor(F.col("tile") / group_tiles)).join(broadcast_if_small(plan, BROADCAST_BYTES), "group").select("pair", "side", "tile", "fps")
    spread = dealt.repartition(parts, "pair").sortWithinPartitions("pair", "side", "tile").select("pair", "side", "fps")
    out = spread.mapInArrow(_compare(radius), "a long, b long, compared long")
    sizes = np.bincount(np.arange(len(boxes)) // group_tiles, minlength=len(low)) if boxes else np.zeros(0, int)
    return out, {"tiles": len(boxes), "groups": len(low), "dealt": int(sum(sizes[g] for g, _, _ in meets))}


def links(distinct: DataFrame, radius: int = MAX_BITS, tile: int = TILE, group_tiles: int = GROUP_TILES) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp), at least a spanning forest of each component."""
    found, _ = comparisons(distinct, radius, tile, group_tiles)
    return found.filter(F.col("a").isNotNull()).select("a", "b").distinct()


def components(docs: DataFrame, words_in: int = SHINGLE_WORDS, radius: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """(doc_id, h, fp, root, component_id) of each row; root is one fingerprint of the component."""
    prints = common.materialise(fingerprints(docs, words_in), "simhash")
    distinct = common.materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-simhash")
    roots = connected_components(links(distinct.select("fp"), radius, tile))
    members = roots.join(distinct.withColumnRenamed("fp", "node"), "node")
    lowest = members.groupBy("root").agg(F.min("least").alias("component_id"))
    tied = members.join(lowest, "root").select(F.col("node").alias("fp"), "root", "component_id")
    ids = distinct.join(tied, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"))
    # Stored, so that a fingerprint of very many rows meets a plain shuffle that can be split.
    ids = common.materialise(ids, "simhash-ids")
    return prints.join(broadcast_if_small(ids, BROADCAST_BYTES), "fp").select("doc_id", "h", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, words_in: int = SHINGLE_WORDS, radius: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    ``docs`` needs doc_id and text; other columns are ignored. Texts link at
    ``radius`` or fewer differing bits, and component_id is the smallest doc_id
    reachable over links. A null or empty text, or one of white space alone, has
    fingerprint zero and links like any other; rows that repeat or share a
    fingerprint fall in one component. A null doc_id counts for links but is never
    a component's id unless the component has no other (then it is null). An empty
    table gives no rows.
    """
    return components(docs, words_in, radius, tile).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, words_in: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id (a null id
    only if there is no other), then of the smallest text hash. Of rows that repeat both
    id and text any one stays; all columns are kept.
    """
    found = common.materialise(components(docs, words_in, radius), "components")
    best = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")).alias("best"))
    owner, h = common.fresh(docs, "best_id"), common.fresh(docs, "best_h")
    best = common.materialise(best.select(F.col("best.doc_id").alias(owner), F.col("best.h").alias(h)), "representatives")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(owner)) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(h))
    kept = docs.join(broadcast_if_small(best, BROADCAST_BYTES), same, "left_semi")
    if found.groupBy("doc_id", "h").count().filter("count > 1").isEmpty():
        return kept
    return kept.dropDuplicates(["doc_id", "text"])
