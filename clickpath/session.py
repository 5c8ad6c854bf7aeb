"""Spark session defaults and the shared work folder.

Scratch data (staged stream inputs, keyed logs, round-trip tables) always goes
under the folder the cluster names in ``spark.checkpoint.dir``; a private
temporary folder stands in for it only in local mode (tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on for correct results (not tuning).
REQUIRED_CONF = {
    # Times are formatted and parsed as UTC; the reference used the JVM zone.
    "spark.sql.session.timeZone": "UTC",
}

# Tuning defaults; a cluster's own values win when already set.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python call-site capture for DataFrame error messages costs extra JVM round
    # trips on every Column call; plan building is several times faster without.
    # PySpark reads it once per process, so it must be set before the first call.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Streaming state (running counts per date/ad/user, per bucket) lives in
    # RocksDB off the JVM heap, with incremental checkpoints; the default
    # in-memory store would hold all keys on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "clickpath", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's required settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as Hadoop sees it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    A private temporary folder stands in for it only under a ``local`` master,
    where driver and executors are one process; anywhere else a missing setting
    is an error, since each machine would write to its own disk.
    """
    path = spark.sparkContext.getCheckpointDir()
    if path:
        # getCheckpointDir returns a per-application child; use its parent so
        # our folders sit next to Spark's own checkpoint data.
        return path.rstrip("/").rsplit("/", 1)[0]
    conf_path = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_path:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all "
                             f"executors share (master {master})")
        conf_path = tempfile.mkdtemp(prefix="clickpath-ckpt-")
    spark.sparkContext.setCheckpointDir(conf_path)
    return conf_path


def new_work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared folder for one run.

    It is made with the Hadoop file system, so any store that Spark can write
    to will do, and goes when the application ends (``remove_dir`` removes it
    earlier).
    """
    path = f"{shared_dir(spark)}/clickpath/{name}-{uuid.uuid4().hex[:12]}"
    fs, p = _file_system(spark, path)
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return path


def remove_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``new_work_dir`` made, with all it holds."""
    fs, p = _file_system(spark, path)
    fs.delete(p, True)
