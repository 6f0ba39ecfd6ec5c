"""Spark session defaults and the shared checkpoint folder.

On a cluster the session is created by the platform; ``configure`` only
applies the SQL settings the pipelines rely on (UTC session zone, AQE,
dynamic partition overwrite).  ``build_session`` is for local runs and tests.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every pipeline assumes.  AQE re-plans joins at runtime from measured
# shuffle sizes (broadcast conversion, skew-join splitting, partition
# coalescing); dynamic overwrite makes ``insert_overwrite`` sinks replace only
# the partitions present in the result.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Sizing for a large cluster (~100 TB of input, ~1000 executors).  Input splits
# of 256 MB keep a task's working set well inside executor memory; the first
# shuffle of the largest fact starts at 40,000 partitions (~2.5 GB each at the
# biggest exchange before AQE) and AQE coalesces towards 256 MB per partition,
# so small exchanges do not pay for the large ones; skewed partitions above
# 5× the median and 512 MB are split.  Broadcasts stay capped at 64 MB of
# estimated size.
CLUSTER_SIZING = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "40000",
    "spark.sql.shuffle.partitions": "40000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def configure(spark: SparkSession, cluster_sizing: bool = False) -> SparkSession:
    """Apply the SQL settings the pipelines rely on; ``cluster_sizing`` adds the
    partition sizing meant for the large-cluster target (not for local runs)."""
    for key, value in {**SQL_DEFAULTS, **(CLUSTER_SIZING if cluster_sizing else {})}.items():
        spark.conf.set(key, value)
    return spark


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "quayside", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("QUAYSIDE_DRIVER_MEMORY", "8g"))
    )
    for key, value in {**SQL_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (distributed) folder there; it is read from the
    session.  Only when it is unset and the master is local, as in tests, a
    fresh folder under the system temp directory is created and registered;
    on a cluster an unset folder is an error, for executors could not share one.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="quayside-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path
