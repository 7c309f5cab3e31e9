"""Session helpers: a local session for tests and benchmarks, and the shared
scratch location used for lineage cuts and written intermediate tables.

Library functions never change session settings except one: if the cluster
names no checkpoint directory (``spark.checkpoint.dir``), one is created on a
local master, as tests need it. On a cluster the setting points at shared
storage and is used as it is; without it intermediate data is refused.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "quarry") -> SparkSession:
    """SparkSession for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint directory of the session.

    Read from the SparkContext, then from ``spark.checkpoint.dir``; only when
    neither is set and the master is local (tests on one machine) is a fresh
    local folder made; elsewhere that raises.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext on a Spark Connect client
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    else:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


def default_parallelism(spark: SparkSession) -> int:
    """Task slots of the session (falls back to the shuffle partition count
    when there is no SparkContext)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint directory for a written table."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/quarry-scratch/{name}-{uuid.uuid4().hex}"
