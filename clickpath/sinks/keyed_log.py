"""Replay-safe keyed logs: the Spark form of the reference's Redis writes.

A log is a parquet folder with one partition per micro-batch,
``<path>/batch_id=<N>/``. A batch is always written with ``overwrite`` into its
own partition, so re-running a batch (task retry, restart from a checkpoint)
replaces its rows instead of adding them twice. The three read sides give the
three Redis semantics:

* ``SetLog``        ``SADD`` / ``SMEMBERS``: distinct keys
* ``IncrementLog``  ``HINCRBY``: sum of the per-batch deltas per key
* ``ReplaceLog``    ``HSET`` / ``HGET``: value of the latest batch per key

``before=b`` restricts a read to batches ``< b``, so a replayed batch sees the
same state as its first run. Reads never go through the driver.

``compact(upto)`` folds batches ``<= upto`` into a snapshot, and later batches
go to a new generation folder. A read then takes the newest snapshot below
``before`` plus that one generation, so a long-running job's per-batch listing
and reads stop growing with its history. A snapshot seals what it covers: only the
``KEEP_SNAPSHOTS`` newest and the generations from the oldest of them on are kept. A
batch is replayed from the snapshot below it, which is always among them; a read below
that is refused, since what it needs is gone.

A log with ``buckets`` also deals its rows by a hash of ``bucket_keys``. A lookup of some keys
then opens the folders of their buckets only (at most ``buckets`` numbers come to the driver).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpath.session import remove_dir

BATCH_COL = "batch_id"
BUCKET_COL = "_bucket"

# Snapshots that compaction leaves. The second newest is what the newest batch is replayed from;
# one more gives readers that opened the log some time.
KEEP_SNAPSHOTS = 3


def _schema(schema: T.StructType | str) -> T.StructType:
    return T._parse_datatype_string(schema) if isinstance(schema, str) else schema


def mkdirs(spark: SparkSession, path: str) -> None:
    """Create a folder on the path's file system (local, HDFS, object store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def numbered_dirs(spark: SparkSession, path: str, prefix: str, complete: bool = False) -> list[int]:
    """The numbers of the folders ``<prefix><number>`` under ``path`` in order (a metadata
    listing); with ``complete`` only those that a finished job wrote."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    out = []
    for status in fs.listStatus(p):
        number = status.getPath().getName().removeprefix(prefix)
        if (f"{prefix}{number}" == status.getPath().getName() and number.lstrip("-").isdigit()
                and (not complete or fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")))):
            out.append(int(number))
    return sorted(out)


def _restrict(df: DataFrame, only: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key columns shared with ``only`` appear in ``only``."""
    on = [k for k in keys if k in only.columns]
    return df.join(only.select(*on).distinct(), on, "left_semi")


NO_SNAPSHOT = -1


class KeyedLog:
    """Parquet log partitioned by batch id; see the module notes.

    Layout: ``<path>/g<u>/batch_id=<N>/`` holds batch N, where u is the newest
    snapshot below N (``g-1`` before the first snapshot), and
    ``<path>/_snapshot/upto=<u>/`` holds the folded state of batches ``<= u``.
    A read below ``b`` takes snapshot u (the newest below b) plus the one
    generation folder ``g<u>``. Listing and reading are therefore bounded by
    the batches since the last snapshot, however long the job runs. A replayed
    batch computes the same generation and overwrites its own folder.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str,
                 buckets: int | None = None, bucket_keys: Sequence[str] = ()):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = _schema(schema)
        self.buckets, self.bucket_keys = buckets, list(bucket_keys)
        self._read_schema = T.StructType(
            list(self.schema.fields) + [T.StructField(BATCH_COL, T.LongType())]
            + ([T.StructField(BUCKET_COL, T.IntegerType())] if buckets else []))
        if not self._snapshots():
            mkdirs(spark, self._gen_dir(NO_SNAPSHOT))   # an empty log must be readable

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def snapshot_dir(self) -> str:
        return f"{self.path}/_snapshot"

    def _gen_dir(self, gen: int) -> str:
        return f"{self.path}/g{int(gen)}"

    def _snapshots(self) -> list[int]:
        return numbered_dirs(self.spark, self.snapshot_dir, "upto=", complete=True)

    def _snapshot_below(self, batch_id: int | None) -> int:
        ups = self._snapshots()
        below = [u for u in ups if batch_id is None or u < batch_id]
        if below:
            return below[-1]
        if ups and NO_SNAPSHOT not in numbered_dirs(self.spark, self.path, "g"):
            raise ValueError(f"what lies below batch {batch_id} is sealed in the snapshot of batch {ups[0]}")
        return NO_SNAPSHOT

    def _bucket(self) -> F.Column:
        return F.pmod(F.xxhash64(*self.bucket_keys), F.lit(self.buckets)).cast("int")

    def _save(self, rows: DataFrame, path: str) -> None:
        """Write rows to one folder; with buckets each task writes whole buckets, in order of their keys."""
        if not self.buckets:
            rows.write.mode("overwrite").parquet(path)
            return
        dealt = rows.withColumn(BUCKET_COL, self._bucket()).repartition(BUCKET_COL)
        (dealt.sortWithinPartitions(BUCKET_COL, *self.bucket_keys)
         .write.mode("overwrite").partitionBy(BUCKET_COL).parquet(path))

    def write(self, df: DataFrame, batch_id: int) -> None:
        """Write (or replace) the rows of one batch."""
        gen = self._snapshot_below(batch_id)
        self._save(df.select(*self.columns), f"{self._gen_dir(gen)}/{BATCH_COL}={int(batch_id)}")

    def write_many(self, df: DataFrame, batch_col: str = BATCH_COL) -> None:
        """Write rows of several batches in one job; only those batches are
        replaced. For logs without snapshots (bulk loads)."""
        if self.buckets or self._snapshot_below(None) != NO_SNAPSHOT:
            raise ValueError("write_many is for logs without buckets or snapshots; use write")
        (df.select(*self.columns, F.col(batch_col).cast("bigint").alias(BATCH_COL))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BATCH_COL).parquet(self._gen_dir(NO_SNAPSHOT)))

    def _read_gen(self, gen: int) -> DataFrame:
        path = self._gen_dir(gen)
        mkdirs(self.spark, path)
        return self.spark.read.schema(self._read_schema).option("basePath", path).parquet(path)

    def _state(self, before: int | None, snapshot_below: int | None) -> DataFrame:
        upto = self._snapshot_below(snapshot_below)
        df = self._read_gen(upto)
        if before is not None:
            df = df.where(F.col(BATCH_COL) < F.lit(int(before)))
        if upto == NO_SNAPSHOT:
            return df
        path = f"{self.snapshot_dir}/upto={upto}"
        snap = self.spark.read.schema(self._read_schema).option("basePath", path).parquet(path)
        return snap.unionByName(df.where(F.col(BATCH_COL) > F.lit(upto)))

    def lookup(self, only: DataFrame, keys: Sequence[str], before: int | None = None) -> DataFrame:
        """Rows whose key columns shared with ``only`` appear in ``only``; of a log with
        buckets only the folders of the buckets that ``only`` has are opened."""
        df = self.read(before)
        if self.buckets and set(self.bucket_keys) <= set(only.columns):
            wanted = [r[0] for r in only.select(self._bucket()).distinct().collect()]   # at most ``buckets``
            df = df.where(F.col(BUCKET_COL).isin(wanted))
        return _restrict(df, only, keys)

    def read(self, before: int | None = None) -> DataFrame:
        """All rows with their ``batch_id``; only batches ``< before`` if given.

        Batches covered by a snapshot come as its folded rows (tagged with the
        snapshot's ``upto`` as batch id).
        """
        return self._state(before, before)

    def read_batch(self, batch_id: int) -> DataFrame:
        """The rows written by one batch (never from a snapshot)."""
        return (self._read_gen(self._snapshot_below(batch_id))
                .where(F.col(BATCH_COL) == F.lit(int(batch_id))))

    def _fold(self, rows: DataFrame) -> DataFrame:
        """Fold rows of many batches into the rows of one (per log type)."""
        return rows.select(*self.columns).distinct()

    def compact(self, upto: int) -> None:
        """Write the folded state of batches ``<= upto`` as a snapshot.

        Call it when ``upto`` is the newest batch written (the jobs do so at the
        end of batch ``upto``); later batches then go to the new generation.
        Built from the newest snapshot strictly below ``upto``, so running it
        again (e.g. for a replayed batch) gives the same snapshot.
        """
        upto = int(upto)
        gen = self._snapshot_below(upto)
        later = [b for b in numbered_dirs(self.spark, self._gen_dir(gen), f"{BATCH_COL}=") if b > upto]
        if later:
            raise ValueError(f"batches {sorted(later)} were written after {upto}; "
                             "compact when the snapshot batch is the newest")
        folded = self._fold(self._state(upto + 1, upto))
        self._save(folded.select(*self.columns, F.lit(upto).cast("bigint").alias(BATCH_COL)),
                   f"{self.snapshot_dir}/upto={upto}")
        self._seal()

    def _seal(self) -> None:
        """Remove what no replay needs: snapshots but the newest, and the generations below them."""
        ups = self._snapshots()
        kept = ups[-KEEP_SNAPSHOTS:]
        if len(kept) < KEEP_SNAPSHOTS:
            return
        for u in ups[:-KEEP_SNAPSHOTS]:
            remove_dir(self.spark, f"{self.snapshot_dir}/upto={u}")
        for g in numbered_dirs(self.spark, self.path, "g"):
            if g < kept[0]:
                remove_dir(self.spark, self._gen_dir(g))


class LineLog(KeyedLog):
    """Rows as they come, repeats included; a snapshot only puts their batches together."""

    def _fold(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.columns)


class SetLog(KeyedLog):
    """``SADD``: the members are the distinct key rows over all batches."""

    def members(self, before: int | None = None) -> DataFrame:
        return self.read(before).select(*self.columns).distinct()


class IncrementLog(KeyedLog):
    """``HINCRBY``: per-batch deltas; the value is their sum per key."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str,
                 keys: Sequence[str], value: str, buckets: int | None = None,
                 bucket_keys: Sequence[str] = ()):
        super().__init__(spark, path, schema, buckets, bucket_keys or keys)
        self.keys, self.value = list(keys), value

    def totals(self, before: int | None = None, only: DataFrame | None = None) -> DataFrame:
        """Sum per key; ``only`` restricts to the keys present in that frame."""
        df = self.read(before) if only is None else self.lookup(only, self.keys, before)
        return df.groupBy(*self.keys).agg(F.sum(self.value).cast("bigint").alias(self.value))

    def _fold(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(F.sum(self.value).cast("bigint").alias(self.value))


class ReplaceLog(KeyedLog):
    """``HSET``: the value of a key is the one written by its latest batch."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str,
                 keys: Sequence[str], buckets: int | None = None, bucket_keys: Sequence[str] = ()):
        super().__init__(spark, path, schema, buckets, bucket_keys or keys)
        self.keys = list(keys)
        self.values = [c for c in self.columns if c not in self.keys]

    def latest(self, before: int | None = None, only: DataFrame | None = None) -> DataFrame:
        """Latest value per key, one aggregation (partial ``max_by`` before the shuffle)."""
        return self._fold(self.read(before) if only is None else self.lookup(only, self.keys, before))

    def _fold(self, rows: DataFrame) -> DataFrame:
        latest = F.max_by(F.struct(*self.values), F.col(BATCH_COL)).alias("_v")
        return (rows.groupBy(*self.keys).agg(latest)
                .select(*self.keys, *[F.col(f"_v.{v}").alias(v) for v in self.values]))
