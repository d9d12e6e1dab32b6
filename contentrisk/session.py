"""Session construction and the shared scratch folder.

Scratch data (landed test files, per-batch tables, lineage cuts) always lives
under the folder the cluster names in ``spark.checkpoint.dir``. Only when that
setting is absent (local tests) do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app: str = "contentrisk") -> SparkSession:
    """Session for tests and local runs. On a cluster use the provided session."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    spark = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("WARN")
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Dates are derived from timestamps; pin the session zone so DATE(ts) is UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a local one only when none is configured."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        # Unset in a local run (tests): make one and register it.
        root = tempfile.mkdtemp(prefix="contentrisk-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    path = f"{root}/contentrisk/{name}-{uuid.uuid4().hex[:12]}"
    local_root = root[len("file:"):] if root.startswith("file:") else root
    if "://" not in local_root and os.path.isdir(local_root):
        # A folder on this machine (tests, local runs): create it so plain file
        # writes work too. Cluster storage is created by the Spark writers.
        os.makedirs(f"{local_root}/contentrisk/{path.rsplit('/', 1)[1]}", exist_ok=True)
    return path
