"""Spark session helpers.

Library code never creates its own cluster settings: it reads what the session
has. The helpers here are for tests, the bench and local runs.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  app: str = "emporia", extra: dict | None = None) -> SparkSession:
    """A local session with the settings the library is tested under."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("EMPORIA_DRIVER_MEMORY", "8g")))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only in local mode.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; a machine-local temporary folder would be lost
    with its executor, so outside local mode an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running emporia jobs")
    path = tempfile.mkdtemp(prefix="emporia-ckpt-", dir=os.environ.get("EMPORIA_SCRATCH", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def cluster_conf(target_partition_mb: int = 256, max_shuffle_partitions: int = 20000) -> dict:
    """Settings suggested for large runs (set them on the cluster's session).

    Shuffles start wide and adaptive execution coalesces them to the advisory
    size, so one setting serves both small and very large inputs; skewed join
    partitions are split; scan splits match the advisory size.
    """
    mb = f"{target_partition_mb}m"
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": mb,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": mb,
        "spark.sql.shuffle.partitions": str(max_shuffle_partitions),
        "spark.sql.files.maxPartitionBytes": mb,
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.session.timeZone": "UTC",
    }
