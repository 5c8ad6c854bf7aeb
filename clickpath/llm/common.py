"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import clickpath
from clickpath.session import new_work_dir, remove_dir

# Rows in one Arrow batch. Texts are long, so batches stay far below the default
# of 10,000 rows to keep a Python worker's memory small.
BATCH_ROWS = 1024

# Hex digits of an MD5 that choose a numbering bucket (see ``gapless``).
BUCKET_DIGITS = 3


# The application that has this package already.
_SHIPPED: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, and this package on the path of the Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    sc = spark.sparkContext
    if _SHIPPED.get("to") != sc.applicationId:
        root = Path(clickpath.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="clickpath-")) / "clickpath_package.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(str(archive))  # Spark hands it to every executor
        _SHIPPED["to"] = sc.applicationId
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts lineage, survives lost executors, and makes later passes read the
    result instead of computing it again. The folder goes with the application.
    """
    spark = df.sparkSession
    path = new_work_dir(spark, name)
    df.write.parquet(path + "/data")
    stored = spark.read.schema(df.schema).parquet(path + "/data")
    stored.stored_in = path
    return stored


def discard(stored: DataFrame) -> None:
    """Remove the files of a frame from ``materialise`` that nothing will read again."""
    remove_dir(stored.sparkSession, stored.stored_in)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that is not a column of ``df`` in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(doc_id: str, buckets: int, remainder: int) -> Column:
    """True where crc32 of the id written as text leaves ``remainder``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % buckets == remainder, F.lit(False))


def gapless(df: DataFrame, groups: list[str], keys: list[str], out: str) -> DataFrame:
    """Number the rows of each group from 0 without gaps, in order of an MD5 of ``keys``.

    A group may hold all rows: each is cut into buckets by the leading hex
    digits of the MD5, the bucket counts (at most groups x 4096 rows) are
    summed up, and only rows of one bucket are sorted together. ``df`` is read
    twice, so it should be stored. Rows with equal keys get different numbers
    in an arbitrary order.
    """
    digest, bucket, base = (fresh(df, n) for n in ("digest", "bucket", "base"))
    marked = df.withColumn(digest, F.md5(F.concat_ws("\x1f", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys))))
    marked = marked.withColumn(bucket, F.substring(digest, 1, BUCKET_DIGITS))
    counts = marked.groupBy(*groups, bucket).agg(F.count(F.lit(1)).alias(base))
    before = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*groups, bucket, F.coalesce(F.sum(base).over(before), F.lit(0)).alias(base))
    within = Window.partitionBy(*groups, bucket).orderBy(digest, *keys)
    numbered = marked.join(starts, [*groups, bucket])
    return numbered.withColumn(out, F.col(base) + F.row_number().over(within) - 1).drop(digest, bucket, base)


def text_batches(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Each Arrow batch with the UTF-8 bytes of its texts; null counts as empty."""
    for batch in batches:
        yield batch, [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]
