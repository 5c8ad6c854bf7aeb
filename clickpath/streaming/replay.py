"""Replay table rows through a streaming job, one staged folder per micro-batch.

Used to check that a streaming job equals its batch form. Each part is written
by Spark (in parallel) into its own folder, then the query runs with
``availableNow`` and consumes exactly that folder as one micro-batch before the
next part is staged; the checkpoint carries state and offsets across the runs,
as it would across restarts of a long-running query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from clickpath.sinks import mkdirs
from clickpath.streaming.sources import file_lines


def replay(spark: SparkSession, parts: Sequence[DataFrame], job, work_dir: str) -> DataFrame:
    """Stage ``parts`` (each with a ``value`` column) in order; return ``job.result()``."""
    input_dir = f"{work_dir.rstrip('/')}/input"
    mkdirs(spark, input_dir)
    for i, part in enumerate(parts):
        part.select("value").write.mode("overwrite").text(f"{input_dir}/b{i:06d}")
        query = job.start(file_lines(spark, f"{input_dir}/*/*.txt"), {"availableNow": True})
        _finish(job, query, i)
    return job.result()


def _finish(job, query, i: int) -> None:
    try:
        job.await_all(query)
    except Exception as failure:
        raise RuntimeError(f"streaming batch {i} failed: {failure}") from failure


def run_by(spark: SparkSession, rows: DataFrame, key: str, job, work_dir: str) -> None:
    """Run ``rows`` (``value`` and a key column) through the job, one micro-batch per key in order.

    All rows are staged by one write that is partitioned by the key, so their
    source is read once; the folder of each key is then put under the stream's
    input, one after the other. Only folder names come to the driver.
    """
    staged, input_dir = f"{work_dir.rstrip('/')}/staged", f"{work_dir.rstrip('/')}/input"
    mkdirs(spark, input_dir)
    rows.select("value", key).write.partitionBy(key).text(staged)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(staged).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [str(f.getPath().getName()) for f in fs.listStatus(path(staged)) if f.isDirectory()]
    values = [(n.partition("=")[2], n) for n in names if n.startswith(f"{key}=")]
    ordered = sorted(values, key=lambda v: (0, int(v[0]), "") if v[0].lstrip("-").isdigit() else (1, 0, v[0]))
    for i, (_, folder) in enumerate(ordered):
        fs.rename(path(f"{staged}/{folder}"), path(f"{input_dir}/b{i:06d}"))
        _finish(job, job.start(file_lines(spark, f"{input_dir}/*/*.txt"), {"availableNow": True}), i)


def replay_by(spark: SparkSession, rows: DataFrame, key: str, job, work_dir: str) -> DataFrame:
    """``run_by``, then the job's result."""
    run_by(spark, rows, key, job, work_dir)
    return job.result()
