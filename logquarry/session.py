"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from functools import cache

from pyspark import cloudpickle
from pyspark.sql import SparkSession

import logquarry

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Vector blocks are wide rows: bound Arrow batches by bytes, not only by rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings every operator in this package relies on.

    Functions of this package travel to the executors by value, so it need not be installed there.
    """
    cloudpickle.register_pickle_by_value(logquarry)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; on a cluster pass your own to `configure`."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("logquarry")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession, name: str) -> str:
    """Folder `name` for this application below the cluster's shared `spark.checkpoint.dir`.

    Only on a single machine a temporary folder is used where that setting is absent.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"Set spark.checkpoint.dir to a folder that all executors of {master} share")
        base = _temporary_dir(spark)
    return f"{base.rstrip('/')}/logquarry/{spark.sparkContext.applicationId}/{name}"


@cache
def _temporary_dir(spark: SparkSession) -> str:
    base = tempfile.mkdtemp(prefix="logquarry-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(base)
    return base
