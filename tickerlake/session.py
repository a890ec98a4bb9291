"""Session helpers.

``build_session`` is for tests, the bench and local runs; library jobs never
create a session themselves. ``shared_dir`` hands out fresh folders below the
cluster's ``spark.checkpoint.dir`` (a shared filesystem on a real cluster). Only
in local mode without that setting -- tests -- does it take a new temp folder,
and registers it as the checkpoint dir; on any other master that is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session built here gets. AQE re-plans joins from runtime sizes
# (broadcast only after the build side is measured) and splits skewed partitions.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # One-file-per-symbol folders are many and tiny: list them with a task per core, not per folder.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "16",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tickerlake", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session (set one only if unset)."""
    root = spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master is {master})")
        root = tempfile.mkdtemp(prefix="tickerlake-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, unique (not yet existing) path below the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tickerlake/{name}-{uuid.uuid4().hex[:12]}"
