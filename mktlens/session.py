"""Session helpers.

Library code never creates a session; it receives DataFrames.  These helpers
are for tests, the bench and the command line.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every plan relies on: AQE for runtime re-planning (partition
# coalescing, skew join splitting, broadcast conversion from measured sizes).
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


# Suggested settings for the 100 TB / 1000-executor target (applied by the
# cluster's launcher, not by library code).  Shuffles start wide and AQE
# coalesces them to ~256 MB per task; scans split at 256 MB; a partition more
# than 5x the median and above 512 MB is split by the skew-join rule; joins
# broadcast only sides AQE has measured below 64 MB.
CLUSTER_CONF = {
    **PLAN_CONF,
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def _driver_memory(cap_gb: int = 16) -> str:
    """Heap for the local-mode JVM: 60 % of physical memory, at most ``cap_gb``."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
        gb = max(1, min(cap_gb, int(total * 0.6 / 2 ** 30)))
    except (ValueError, OSError, AttributeError):
        gb = 4
    return f"{gb}g"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "mktlens") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("MKTLENS_DRIVER_MEMORY", _driver_memory()))
    )
    for k, v in PLAN_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder, setting a scratch one only
    when the session has none (local tests).  On a cluster the folder named
    by ``spark.checkpoint.dir`` is a shared file system and is used as is."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                           "(a machine-local folder does not survive executor loss)")
    path = tempfile.mkdtemp(prefix="mktlens-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path
