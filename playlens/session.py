"""Session and scratch-space helpers.

Written tables (state, checkpoints, sink output) always go under the shared
folder the cluster names in ``spark.checkpoint.dir``.  Only when a session
with a local master has none (unit tests, a laptop) do we create one under the
system temp dir; on a cluster a missing setting is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[*]", app: str = "playlens", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """A session configured the way every query here expects.

    AQE stays on so shuffle partitions coalesce and skewed joins split at run
    time; the session time zone is pinned to UTC because log dates carry a
    ``Z`` suffix and the fixtures are compared against naive UTC timestamps.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a private one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder all executors share")
        # Unset on a local master (tests, a laptop): a fresh private folder.
        configured = tempfile.mkdtemp(prefix="playlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A new, unique path under the shared checkpoint folder for written tables."""
    root = ensure_checkpoint_dir(spark)
    leaf = os.path.join(*parts) if parts else "run"
    return f"{root.rstrip('/')}/playlens/{leaf}-{uuid.uuid4().hex[:12]}"
