"""Streaming line sources (S3, S4): each yields a ``value string`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Text files appearing under ``path`` (a folder or a glob), one row per line.

    The replayable stand-in for a socket source (same ``value`` schema, no port).
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def kafka_lines(spark: SparkSession, bootstrap_servers: str, topic: str,
                starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None
                ) -> DataFrame:
    """Record values of a Kafka topic as strings (S3).

    Needs the Spark Kafka connector on the classpath. Offsets are tracked in the
    query checkpoint (not auto-committed), so a restart neither loses nor
    repeats a batch.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return reader.load().select(F.col("value").cast("string").alias("value"))
