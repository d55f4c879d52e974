"""Session helpers: scratch locations and the few settings the library relies on.

Scratch data (round-trip files, snapshot slots in tests, stream checkpoints) always lives
below the shared folder the cluster names in ``spark.checkpoint.dir``. A local folder is
made only for a local master without that setting (unit tests); on a cluster its absence raises.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; set a local one only when unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":  # executors would not see a folder of the driver's
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tablesync-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the checkpoint root (never reused, never cleared)."""
    return f"{checkpoint_root(spark)}/tablesync/{name}-{uuid.uuid4().hex[:12]}"


def builder(master: str = "local[*]", shuffle_partitions: int = 8) -> SparkSession.Builder:
    """Builder with the settings used by tests and the bench (AQE on, UI off)."""
    return (
        SparkSession.builder.master(master)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
    )
