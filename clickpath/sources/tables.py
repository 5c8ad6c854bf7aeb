"""Batch table readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpath import schema as S
from clickpath.session import new_work_dir

# Largest side we broadcast on a planner-size check (plan statistics, no job run).
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """``spark.read.parquet``; the schema is inferred on every read, so a table whose
    files were replaced, at any depth, shows its present columns."""
    return spark.read.parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables; Catalyst prunes columns and pushes filters."""
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread rows over the cluster when the scan yields fewer partitions than it
    has cores (e.g. one large-row-group file feeding CPU-heavy text work).

    Large inputs already scan as many partitions, so this adds no shuffle at
    scale; the check only plans the scan, it runs nothing.
    """
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df


def plan_size_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan (file sizes for scans); runs no job."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size if isinstance(size, int) else size.toString())


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Hint a broadcast only when the side's planned size is within ``max_bytes``;
    beyond it the planner keeps a shuffle join (and AQE may still broadcast it
    once the real size is known)."""
    return F.broadcast(df) if plan_size_bytes(df) <= max_bytes else df


def read_visit_actions(spark: SparkSession, source: str) -> DataFrame:
    """The visit-action table by catalog name or parquet path, conformed to its schema.

    Extra columns (such as an ``event_id`` tie key) are kept.
    """
    if "/" in source or source.endswith(".parquet"):
        df = spark.read.parquet(source)
    else:
        df = spark.table(source)
    return S.conform(df, S.VISIT_ACTION, keep_extra=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """A frame written to the shared work folder and read again, so that its real size is known."""
    path = new_work_dir(df.sparkSession, name) + "/data"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_to_frame(spark: SparkSession, rows, schema) -> DataFrame:
    """A small local collection as a DataFrame (S8); for fixtures and parameters only."""
    return spark.createDataFrame(rows, schema)
