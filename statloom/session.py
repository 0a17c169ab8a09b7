"""Session settings, and the shared folder for data that has to be written between two stages."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Web pages are large values: bound an Arrow batch by bytes and not only by rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    # Small files, hundreds to a task: a task costs more than opening one.
    "spark.sql.files.openCostInBytes": str(512 * 1024),
    # Needed by transformWithState.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

SHARED = "spark.checkpoint.dir"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on to a session made elsewhere.

    A local session without a shared folder, as in tests, gets one of its own, which goes when Python ends.
    """
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    # Folders of many files are listed by a few tasks for each core. Spark would start one for nearly every folder.
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(4 * spark.sparkContext.defaultParallelism))
    if not spark.conf.get(SHARED, None) and re.match(r"local(\[|$)", spark.sparkContext.master):
        folder = tempfile.mkdtemp(prefix="statloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set(SHARED, folder)
    return spark


def build_session(app: str = "statloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``; an error without that setting."""
    shared = spark.conf.get(SHARED, None)
    if not shared:
        raise ValueError(f"set {SHARED} to a folder all executors share")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path without its scheme, if it lies in a file system of the machines and not in a store."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    local = "://" not in path and settings.get("fs.defaultFS", "file:///").startswith("file:")
    return os.path.abspath(path) if local else None


def written(table: DataFrame, label: str) -> DataFrame:
    """The table, written to the shared folder and read back, for results that several steps use.

    The steps read the columns they need instead of computing the table again, and a lost executor
    costs a read.
    """
    path = scratch_path(table.sparkSession, label)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)
