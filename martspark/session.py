"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "martspark",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Local/test session. On a cluster, pass the cluster's own session instead."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.parquet.compression.codec", "zstd")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
    )
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Root of the shared folder jobs write staging data and lineage cuts to.

    The cluster names it in ``spark.checkpoint.dir``. Only a ``local[...]`` session may do
    without (a private temporary folder is created and registered): on a cluster the
    executors' own disks are not shared, so an unset folder raises there. One under ``file:``
    must be named by the cluster itself, as a mount that all its machines share.
    """
    sc = spark.sparkContext
    local = sc.master.startswith("local[") or sc.master == "local"
    named = spark.conf.get("spark.checkpoint.dir", None)
    root = sc.getCheckpointDir()
    if not local and not named and (not root or urlparse(root).scheme in ("", "file")):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share; master is {sc.master}, the folder is {root}")
    if not root:
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="martspark-ckpt-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared root (never reused between runs)."""
    return f"{shared_root(spark)}/martspark/{name}-{uuid.uuid4().hex[:12]}"


# Settings for a large cluster (100 TB scans, ~1000 executors). Applied by
# ``tune_for_scale`` only for keys the cluster has not set itself.
CLUSTER_SETTINGS = {
    # AQE: coalesce small shuffle partitions, split skewed ones, switch joins at runtime
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    # start wide, let AQE coalesce: ~256 MB per task for the largest shuffles
    "spark.sql.shuffle.partitions": "16000",
    # scan splits sized to executor memory
    "spark.sql.files.maxPartitionBytes": "256m",
    # runtime bloom filters prune the big side of a join with a filtered small side
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.parquet.filterPushdown": "true",
}


def tune_for_scale(spark: SparkSession, overrides: dict | None = None) -> dict:
    """Apply ``CLUSTER_SETTINGS`` (plus ``overrides``) where the session's launch
    configuration does not already name the key. Returns what was applied."""
    launched = {k for k, _ in spark.sparkContext.getConf().getAll()}
    applied = {}
    for k, v in {**CLUSTER_SETTINGS, **(overrides or {})}.items():
        if k not in launched:
            spark.conf.set(k, v)
            applied[k] = v
    return applied
