"""How filters act on each other, in every order, from one incremental pass over the documents.

Five filters judge each document; which of them it fails is its *mask*. All that any order of the
filters keeps, removes or removes twice follows from counts of masks, so only those are
kept: one counter for each part, mask and label.

Four filters look at a text alone. The fifth fails a document whose text also belongs to a smaller
doc_id, so its answer for one document may change when another arrives. Files are processed as
available-now micro-batches; a keyed state remembers each text's smallest doc_id and
the counters it went to. When a smaller one arrives, the earlier one is taken back from its counter and
counted again with the fifth filter failed. The stream writes these differences, and the counters
are their sums, the same for any order of files.
"""

from __future__ import annotations

import itertools
import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from clickpath.llm import common
from clickpath.session import new_work_dir
from clickpath.sources.tables import broadcast_if_small

FILTERS = "ABCDE"
A, B, C, D, E = (1 << k for k in range(5))
GOOD, TOXIC = 32, 64
FLAGS = 128

LEAST_WORDS = 200
SPECIAL = b"#$%&*|"

# Micro-batches over the files there are, texts that share a key of the state, and counters a task holds before it passes them on.
MICRO_BATCHES = 4
TEXTS_PER_KEY = 64
HELD = 1 << 16

BROADCAST_BYTES = 16 << 20

_NOT_CAPITAL = bytes(b for b in range(256) if not 65 <= b <= 90)
_NOT_SPECIAL = bytes(b for b in range(256) if b not in SPECIAL)
_CONTINUED = bytes(range(0x80, 0xC0))  # the bytes of a character but its first


def own_mask(text: bytes) -> int:
    """The filters that a text fails by itself: A to D."""
    words = text.split()  # of bytes: exactly blank and \\t to \\r
    points = len(text.translate(None, _CONTINUED))
    return (A * (len(words) < LEAST_WORDS) | B * (100 * len(set(words)) < 50 * len(words))
            | C * (100 * len(text.translate(None, _NOT_CAPITAL)) > 2 * points) | D * bool(text.translate(None, _NOT_SPECIAL)))


FACT_SCHEMA = "doc_id long, part string, key binary, flags int"


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in common.text_batches(batches):
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), batch.column("part"), pa.array([xxhash.xxh3_128_digest(t) for t in texts], pa.binary()),
            pa.array([own_mask(t) for t in texts], pa.int32())], names=["doc_id", "part", "key", "flags"])


PARTIAL_SCHEMA = "bucket long, key binary, part string, flags int, n long, least long, at_least long, without_id long"


def _combined(buckets: int):
    """Rows of a task with equal text, part and flags as one: how many, the smallest doc_id and how many have it or none."""
    kinds = [pa.int64(), pa.binary(), pa.string(), pa.int32()] + [pa.int64()] * 4
    names = [x.split()[0] for x in PARTIAL_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            rows = [(int.from_bytes(k[0][:7], "big") % buckets, *k, *v) for k, v in held.items()]
            held.clear()
            for at in range(0, len(rows), common.BATCH_ROWS * 8):
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[at:at + common.BATCH_ROWS * 8]), kinds)], names=names)

        for batch in batches:
            for doc_id, part, key, flags in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "part", "key", "flags"))):
                got = held.setdefault((key, part, flags), [0, None, 0, 0])
                got[0] += 1
                if doc_id is None:
                    got[3] += 1
                elif got[1] is None or doc_id < got[1]:
                    got[1], got[2] = doc_id, 1
                elif doc_id == got[1]:
                    got[2] += 1
            if len(held) > HELD:
                yield from flushed()
        yield from flushed()
    return run


DELTA_SCHEMA = "part string, flags int, n long"


def changes(held: dict, rows: Iterator[tuple]) -> Counter:
    """Take rows (key, part, flags, n, least, at_least, without_id) into ``held`` and return how the counters change.

    ``held`` maps a text's key to its smallest doc_id and the counters of the documents that have it.
    """
    out: Counter = Counter()
    for key, part, flags, n, least, at_least, without_id in rows:
        out[part, flags] += without_id  # without an id nothing is smaller
        with_id = n - without_id
        if not with_id:
            continue
        before, owners = held.get(key, (None, {}))
        if before is None or least < before:
            for (p, f), m in owners.items():  # retracted: they fail the fifth filter now
                out[p, f] -= m
                out[p, f | E] += m
            held[key] = (least, {(part, flags): at_least})
        elif least == before:
            owners[part, flags] = owners.get((part, flags), 0) + at_least
        else:
            at_least = 0
        out[part, flags] += at_least
        out[part, flags | E] += with_id - at_least
    return out


def _retracting(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    held = pickle.loads(state.get[0]) if state.exists else {}
    out: Counter = Counter()
    for rows in frames:
        least = (None if pd.isna(x) else int(x) for x in rows["least"])
        out.update(changes(held, zip(map(bytes, rows["key"]), rows["part"], rows["flags"].tolist(), rows["n"].tolist(), least,
                                     rows["at_least"].tolist(), rows["without_id"].tolist())))
    state.update((pickle.dumps(held, protocol=5),))
    found = [(p, f, n) for (p, f), n in out.items() if n]
    yield pd.DataFrame(found, columns=["part", "flags", "n"])


def label_flags(labels: DataFrame) -> DataFrame:
    """(doc_id, label) with one row for each labelled document that is good or toxic by any of its rows."""
    flags = F.max(F.when(F.col("quality") == 1, GOOD).otherwise(0)) + F.max(F.when(F.col("toxic") == 1, TOXIC).otherwise(0))
    return labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(flags.alias("label")).filter("label > 0")


def _streamable(spark: SparkSession, path: str) -> str:
    """``path`` as a file stream takes it: a folder, or a pattern that only this one file matches."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    is_file = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isFile()
    return f"{path[:-1]}[{path[-1]}]" if is_file else path


def follow(spark: SparkSession, path: str, labels: DataFrame, work: str, buckets: int, files_per_batch: int) -> None:
    """Bring the differences in ``work`` up to date with all files of documents at ``path``.

    Called again with the same ``work`` and ``buckets``, it takes in only files that are new.
    """
    schema = spark.read.parquet(path).schema
    docs = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(_streamable(spark, path))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_facts, FACT_SCHEMA)
    known = common.materialise(label_flags(labels), "audit-labels")
    rows = rows.join(broadcast_if_small(known, BROADCAST_BYTES), "doc_id", "left")
    rows = rows.withColumn("flags", F.col("flags").bitwiseOR(F.coalesce("label", F.lit(0))))
    partial = rows.select("doc_id", "part", "key", "flags").mapInArrow(_combined(buckets), PARTIAL_SCHEMA)
    deltas = partial.groupBy("bucket").applyInPandasWithState(_retracting, DELTA_SCHEMA, "held binary", "append", GroupStateTimeout.NoTimeout)
    query = deltas.writeStream.format("parquet").option("path", f"{work}/differences").option(
        "checkpointLocation", f"{work}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()


def counters(spark: SparkSession, work: str) -> DataFrame:
    """(part, flags, n): the documents of each part with those filters failed and those labels."""
    found = spark.read.schema(DELTA_SCHEMA).parquet(f"{work}/differences")
    return found.groupBy("part", "flags").agg(F.sum("n").alias("n")).filter("n != 0")


COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
REPORT_SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COLUMNS)


def weights() -> tuple[list[tuple[str, int]], np.ndarray]:
    """The (filter_order, step) rows of the report, and which flags each of its columns counts in each row."""
    rows = [("".join(o), s) for o in itertools.permutations(FILTERS) for s in range(1, 6)]
    out = np.zeros((len(rows), len(COLUMNS), FLAGS), np.int64)
    flags = np.arange(FLAGS)
    for k, (order, step) in enumerate(rows):
        own = 1 << FILTERS.index(order[step - 1])
        earlier = sum(1 << FILTERS.index(x) for x in order[:step - 1])
        fails, gone = flags & own != 0, flags & earlier != 0
        removed = fails & ~gone
        out[k, :6] = ~fails & ~gone, removed, fails & gone, flags & 31 == own, removed & (flags & GOOD != 0), removed & (flags & TOXIC != 0)
    letter = np.array([order[step - 1] for order, step in rows])
    for x in FILTERS:
        out[letter == x, 6] = out[letter == x, 1].sum(axis=0)
    return rows, out


def _reported(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows, table = weights()
    orders, steps = [o for o, _ in rows], [s for _, s in rows]
    for frame in frames:
        for part, found in zip(frame["part"], frame["found"]):
            n = np.zeros(FLAGS, np.int64)
            for x in found:
                n[x["flags"]] += x["n"]
            yield pd.DataFrame({"part": part, "filter_order": orders, "step": steps} | dict(zip(COLUMNS, (table @ n).T)))


def report(counted: DataFrame) -> DataFrame:
    """600 rows for each part of ``counters``, one for each order and step."""
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("flags", "n")).alias("found"))  # at most FLAGS of them
    return parts.mapInPandas(_reported, REPORT_SCHEMA)


def audit(spark: SparkSession, path: str, labels: DataFrame, work: str | None = None,
          micro_batches: int = MICRO_BATCHES, texts_per_key: int = TEXTS_PER_KEY) -> DataFrame:
    """The report over all documents (doc_id, text, source) in the Parquet files at ``path``.

    A null text is empty, a null source is the part ''; a row without doc_id has nothing smaller and is
    nobody's smaller one; rows that share text and doc_id are not smaller than each other.
    A label counts if any row of ``labels`` (doc_id, quality, toxic) gives it. Other columns are
    ignored. An empty table gives no rows.
    """
    common.configure(spark)
    docs = spark.read.parquet(path)
    files = len(docs.inputFiles())
    n = docs.count()  # from the files' footers
    if not n:
        return spark.createDataFrame([], REPORT_SCHEMA)
    work = work or new_work_dir(spark, "filter-audit")
    follow(spark, path, labels, work, max(common.shuffle_partitions(spark), -(-n // texts_per_key)), -(-files // micro_batches))
    return report(counters(spark, work))


def oracle_sql() -> str:
    """DuckDB SQL of the query: every order and step against the counted masks."""
    words = r"regexp_extract_all(txt, '[^\x20\x09-\x0D]+')"
    return f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS txt FROM documents),
     x AS (SELECT doc_id, part, {words} AS words, txt, coalesce(min(doc_id) OVER (PARTITION BY txt) < doc_id, false) AS e FROM d),
     l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
     m AS (SELECT part, (len(words) < {LEAST_WORDS})::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
                  + 4 * (100 * length(regexp_replace(txt, '[^A-Z]', '', 'g')) > 2 * length(txt))::INT
                  + 8 * regexp_matches(txt, '[#$%&*|]')::INT + 16 * e::INT AS mask,
                  coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
           FROM x LEFT JOIN l USING (doc_id) GROUP BY ALL),
     f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS b),
     o AS (SELECT [f1.b, f2.b, f3.b, f4.b, f5.b] AS bits, f1.c || f2.c || f3.c || f4.c || f5.c AS filter_order
           FROM f f1, f f2, f f3, f f4, f f5 WHERE f1.b + f2.b + f3.b + f4.b + f5.b = 31
             AND len(list_distinct([f1.b, f2.b, f3.b, f4.b, f5.b])) = 5),
     s AS (SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS earlier FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
     r AS (SELECT part, filter_order, step, own,
                  sum(n) FILTER (mask & (own | earlier) = 0) AS kept, sum(n) FILTER (mask & own != 0 AND mask & earlier = 0) AS removed,
                  sum(n) FILTER (mask & own != 0 AND mask & earlier != 0) AS redundant, sum(n) FILTER (mask = own) AS unique_fails,
                  sum(n) FILTER (good AND mask & own != 0 AND mask & earlier = 0) AS good_lost,
                  sum(n) FILTER (toxic AND mask & own != 0 AND mask & earlier = 0) AS toxic_lost
           FROM s, m GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
       coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
FROM r"""
