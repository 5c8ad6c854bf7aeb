"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item is found in a document if at least ``threshold`` of the item's word
shingles occur in it, however long the document is. Items are partitioned by
their number of shingles; an item's sketch is its lowest-hashing shingles, as
many as its partition needs for a document that contains enough of the item to
contain one of the sketch for certain. Documents are probed against the sketches
with all their shingles, and every pair found is verified by exact containment
on the shingles themselves. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpath.llm import common
from clickpath.sources.tables import broadcast_if_small

SHINGLE_WORDS = 5
THRESHOLD = 0.8

# Largest sketch or candidate table that is broadcast, in bytes of its stored files.
BROADCAST_BYTES = 16 << 20


def words(text: Column) -> Column:
    """Maximal runs of letters and digits, lower-cased; none for a null text."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingles(ws: Column, length: Column) -> Column:
    """The distinct shingles of ``length`` words as strings; empty if there are fewer words."""
    starts = F.sequence(F.lit(1), F.size(ws) - length + 1)
    joined = F.transform(starts, lambda i: F.array_join(F.slice(ws, i, length), " "))
    return F.when(F.size(ws) >= length, F.array_distinct(joined)).otherwise(F.array().cast("array<string>"))


def word_hashes(ws: Column) -> Column:
    return F.transform(ws, lambda w: F.xxhash64(w))


def _item_hashes(items: DataFrame) -> DataFrame:
    """(key, length, n, h): the hashed shingles of each item, hashed as ``_document_hashes`` does."""
    hs = F.col("hashes")
    parts = [F.when(F.col("length") > k, F.element_at(hs, F.col("at") + k)) for k in range(SHINGLE_WORDS)]
    at = items.withColumn("hashes", word_hashes(F.col("ws"))).select(
        "key", "length", "n", "hashes", F.explode(F.sequence(F.lit(1), F.size("ws") - F.col("length") + 1)).alias("at"))
    return at.select("key", "length", "n", F.xxhash64("length", *parts).alias("h")).distinct()


def _document_hashes(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, h): the hashes of all shingles of ``length`` words of all documents."""
    hashed = docs.select("doc_id", word_hashes(words(F.col("text"))).alias("hashes")).filter(F.size("hashes") >= length)
    n = F.size("hashes") - length + 1
    zipped = F.arrays_zip(*(F.slice("hashes", k + 1, n).alias(f"w{k}") for k in range(length)))
    names = [f"w{k}" for k in range(length)]
    rows = hashed.select("doc_id", F.inline(zipped).alias(*names))
    nulls = [F.lit(None).cast("long")] * (SHINGLE_WORDS - length)
    return rows.select("doc_id", F.xxhash64(F.lit(length), *(F.col(c) for c in names), *nulls).alias("h"))


def _sketches(items: DataFrame, threshold: float) -> DataFrame:
    """(h, key, length): each item's sketch.

    A partition holds the items with 2^p to 2^(p+1) - 1 shingles. An item of n
    shingles is contained if m = ceil(threshold n) of them occur, so any
    n - m + 1 of its shingles hold one that occurs; the sketch size is that of
    the partition's largest item, which is no smaller for any other.
    """
    largest = F.pow(F.lit(2.0), F.length(F.bin("n"))) - 1
    size = largest - F.ceil(largest * threshold - 1e-9) + 1
    lowest = Window.partitionBy("key").orderBy("h")  # the shingles of one item
    return _item_hashes(items).withColumn("rank", F.row_number().over(lowest)).filter(F.col("rank") <= size).select("h", "key", "length")


def find(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, containment): every document that holds an item, one row per pair.

    ``docs`` needs doc_id and text, ``items`` item_id and text; other columns are
    ignored. Shingles are five words; an item of fewer words is one shingle of
    them all. Null and empty texts, and items without a word, are never found.
    Rows that repeat give one pair; if an id stands for several texts the pair has
    the highest containment. Rows with a null doc_id are searched and reported
    under the null id. Either table may be empty.
    """
    docs = docs.select("doc_id", "text")
    ws = items.select("item_id", words(F.col("text")).alias("ws")).filter(F.size("ws") > 0).distinct()
    sets = ws.withColumn("length", F.least(F.size("ws"), F.lit(SHINGLE_WORDS)))
    sets = sets.withColumn("shingles", shingles(F.col("ws"), F.col("length")))
    sets = common.materialise(sets.select(
        F.xxhash64("item_id", "ws").alias("key"), "item_id", "ws", "length", "shingles", F.size("shingles").alias("n")), "items")
    sketches = common.materialise(_sketches(sets, threshold), "sketches")
    lengths = sorted(r["length"] for r in sets.select("length").distinct().collect())  # of 1 to SHINGLE_WORDS
    pairs = None
    for length in lengths:
        probe = broadcast_if_small(sketches.filter(F.col("length") == length).select("h", "key"), BROADCAST_BYTES)
        hits = _document_hashes(docs, length).join(probe, "h").select("doc_id", "key", F.lit(length).alias("length"))
        pairs = hits if pairs is None else pairs.union(hits)
    if pairs is None:
        return docs.select("doc_id").join(items.select("item_id"), F.lit(False)).withColumn("containment", F.lit(0.0)).limit(0)
    pairs = common.materialise(pairs.distinct(), "candidates")
    # Exact verification of the candidates. A document's candidates are at most its shingles.
    wanted = pairs.groupBy("doc_id", "length").agg(F.collect_set("key").alias("keys"))
    wanted = common.materialise(wanted.withColumnRenamed("doc_id", "wanted_id"), "wanted")
    texts = docs.join(broadcast_if_small(wanted, BROADCAST_BYTES), F.col("doc_id").eqNullSafe(F.col("wanted_id")))
    # The words are a column of their own: written inside the shingle function they would be split anew for each shingle.
    exact = texts.select("doc_id", "keys", "length", words(F.col("text")).alias("ws"))
    exact = exact.select("doc_id", "keys", shingles(F.col("ws"), F.col("length")).alias("have"))
    exact = exact.select("doc_id", "have", F.explode("keys").alias("key"))
    exact = exact.join(broadcast_if_small(sets.select("key", "item_id", "shingles", "n"), BROADCAST_BYTES), "key")
    share = F.size(F.array_intersect("shingles", "have")) / F.col("n")
    return exact.select("doc_id", "item_id", share.alias("containment")).filter(
        F.col("containment") >= threshold).groupBy("doc_id", "item_id").agg(F.max("containment").alias("containment"))


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that hold a test item; all columns are kept."""
    found = common.materialise(find(docs, items, threshold).select("doc_id").distinct(), "contaminated")
    found = found.withColumnRenamed("doc_id", fresh_id := common.fresh(docs, "contaminated_id"))
    return docs.join(broadcast_if_small(found, BROADCAST_BYTES), F.col("doc_id").eqNullSafe(F.col(fresh_id)), "left_anti")


def oracle_sql(threshold: float = THRESHOLD) -> str:
    """The same pairs in DuckDB SQL, from all shingles of all documents."""
    return rf"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS ws FROM documents),
iw AS (SELECT DISTINCT item_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS ws FROM benchmark),
il AS (SELECT item_id, ws, least(len(ws), {SHINGLE_WORDS}) AS l FROM iw WHERE len(ws) > 0),
ish AS (SELECT DISTINCT item_id, ws, l, unnest(list_transform(range(1, len(ws) - l + 2), lambda i: array_to_string(ws[i:i + l - 1], ' '))) AS s FROM il),
n AS (SELECT item_id, ws, l, count(*) AS n FROM ish GROUP BY ALL),
dsh AS (SELECT doc_id, ws, l, unnest(list_transform(range(1, len(ws) - l + 2), lambda i: array_to_string(ws[i:i + l - 1], ' '))) AS s
  FROM dw, (SELECT DISTINCT l FROM il) WHERE len(ws) >= l),
hits AS (SELECT dsh.doc_id, dsh.ws AS dws, ish.item_id, ish.ws, ish.l, count(DISTINCT s) AS m FROM dsh JOIN ish USING (l, s) GROUP BY ALL)
SELECT doc_id, item_id, max(m / n) AS containment
FROM hits JOIN n USING (item_id, ws, l) WHERE m / n >= {threshold} GROUP BY doc_id, item_id"""
