"""Session helpers for tests, the benchmark and the pipeline entry point.

Library operators never create or configure a session: they run in whatever
session the caller hands them.  ``local_session`` is only a convenience for
local runs; on a cluster the submitter's settings win.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tillroll") -> SparkSession:
    """Local session: UTC, AQE on, no UI; used by tests and bench only."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("TILLROLL_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Base folder every executor can reach: the session's checkpoint dir.

    ``spark.checkpoint.dir`` names the shared folder (HDFS, S3, ...).  Only a
    local master, where every task runs on this machine, may leave it unset:
    then a fresh temporary folder is set.  Anywhere else a guess would put
    files on disks that other executors do not see, so this raises.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns checkpointing
        sc = None
    current = (sc.getCheckpointDir() if sc else None) or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if sc is None or not re.match(r"local($|\[)", sc.master):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="tillroll-ckpt-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared directory."""
    return f"{shared_dir(spark)}/tillroll-scratch/{name}-{uuid.uuid4().hex[:12]}"


def scale_conf(shuffle_bytes: int, partition_bytes: int = 200 << 20,
               max_split_bytes: int = 256 << 20) -> dict[str, str]:
    """Runtime SQL settings sized for an expected shuffle volume.

    ``spark.sql.shuffle.partitions`` is set so each reducer starts with about
    ``partition_bytes`` (AQE only coalesces downwards, so the initial number
    must be large enough for the biggest shuffle); skew handling and
    coalescing use the same target.  Example: 100 TiB of shuffle at 200 MiB
    per partition -> 524,288 partitions.  Nothing here is applied automatically.
    """
    parts = max(1, -(-int(shuffle_bytes) // int(partition_bytes)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(max_split_bytes),
    }
