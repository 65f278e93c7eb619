"""SparkSession helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    # Values in the source systems are naive wall-clock times.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: partition coalescing, skew splitting and
    # broadcast conversion decided on real (not estimated) sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app: str = "plantwise", master: str | None = None,
              shuffle_partitions: int | None = None, driver_memory: str | None = None,
              **conf) -> SparkSession:
    """Return the active session or build one with the library defaults."""
    b = SparkSession.builder.appName(app)
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **conf}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Reliable checkpoint folder: the cluster's ``spark.checkpoint.dir``.

    Without that setting a local run gets a private folder; a cluster, whose
    executors would each see another disk under such a path, gets an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="plantwise-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def scale_conf(input_bytes: int, total_cores: int,
               partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Partition sizing for a given input volume and cluster size.

    Scan splits and post-shuffle partitions target ``partition_bytes`` (a
    size a task sorts and aggregates in executor memory without heavy
    spill); the initial shuffle partition count covers the input at that
    size and at least two waves of the cluster's cores, and AQE coalesces
    partitions that turn out small and splits skewed ones.  For 100 TB on
    1000 executors x 8 cores: ~410k initial partitions, 256 MB splits.
    """
    import math
    n = max(2 * total_cores, math.ceil(input_bytes / partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
