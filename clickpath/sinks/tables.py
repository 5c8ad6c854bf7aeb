"""Table and JDBC sinks.

``publish`` replaces a folder's rows as one step: each version is written to a folder of
its own, and then a pointer file is switched by a rename. A reader that opened the
version before keeps its files, and a write that fails leaves the pointer as it was.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from clickpath.session import remove_dir
from clickpath.sinks.keyed_log import numbered_dirs

POINTER = "_current"

# Versions that a new one leaves in place, itself included.
KEEP_VERSIONS = 3


def _current(spark: SparkSession, path: str) -> int | None:
    """The number of the version that the pointer names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    f = fs.open(p)
    try:
        return int(f.readUTF())
    finally:
        f.close()


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Replace the rows of the folder ``path`` with ``df`` and return the new version's number.

    The switch is a rename over the pointer, which HDFS and local file systems do at
    once. One writer at a time; versions but the newest KEEP_VERSIONS are removed.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    version = max(numbered_dirs(spark, path, "v"), default=0) + 1   # above what a failed write left
    writer = df.write
    if partition_by:
        df = df.repartition(*partition_by)   # one file for each value, not for each task and value
        writer = df.write.partitionBy(*partition_by)
    writer.parquet(f"{path}/v{version}")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    new, pointer = (jvm.org.apache.hadoop.fs.Path(f"{path}/{n}") for n in (f"_new-{uuid.uuid4().hex}", POINTER))
    f = new.getFileSystem(conf).create(new)
    f.writeUTF(str(version))
    f.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    over = spark.sparkContext._gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(pointer.toUri(), conf).rename(new, pointer, over)
    for v in numbered_dirs(spark, path, "v"):
        if v <= version - KEEP_VERSIONS:
            remove_dir(spark, f"{path}/v{v}")
    return version


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the version that is current now, also after later ones are published."""
    version = _current(spark, path.rstrip("/"))
    if version is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/v{version}")


def write_bucketed(df: DataFrame, name: str, key: str, sort_by: list[str], buckets: int, path: str | None = None) -> None:
    """Save a table bucketed by ``key``, one sorted file for each bucket.

    Windows and aggregates by ``key`` over it need no shuffle of its rows (S1 with W1, W3, W4).
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key, *sort_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def overwrite_table(df: DataFrame, name: str, path: str | None = None,
                    partition_by: list[str] | None = None) -> None:
    """Replace a catalog table with ``df`` (S9); no separate drop step.

    ``path`` makes it an external table in a shared folder; ``partition_by``
    (e.g. ``["date"]``) lets later date-range reads prune whole folders. Rows of one
    partition value are brought together first, by as many tasks as AQE finds fit.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "append", batch_size: int = 1000,
               num_partitions: int | None = None) -> None:
    """Append rows to a JDBC table by column name.

    Each partition writes over its own connection in batched inserts; the
    reference's positional per-row inserts from the driver go away.
    ``num_partitions`` caps concurrent connections (coalesced before writing).
    """
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    out = df.coalesce(num_partitions) if num_partitions else df
    out.write.jdbc(url, table, mode=mode, properties=props)
