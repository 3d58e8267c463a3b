"""Session helpers.

On a cluster the session comes from the launcher and already names a shared
``spark.checkpoint.dir``; we only read it. A local default is set only when
the setting is absent (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "quire", conf: dict | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests and benches
    (``conf``: more settings)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = (
        SparkSession.builder.appName(app_name)
        .master(master or os.environ.get("QUIRE_MASTER", "local[*]"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QUIRE_DRIVER_MEMORY", "8g"))
    )
    for name, value in (conf or {}).items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared checkpoint folder; set a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get(_CHECKPOINT_KEY, None) \
        or sc.getConf().get(_CHECKPOINT_KEY, None)
    if not current:
        # Local runs (tests, benches) only: on a cluster a machine-local folder
        # would be invisible to the other executors, so a shared one must be named.
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a shared folder for master {sc.master}")
        current = tempfile.mkdtemp(prefix="quire-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables."""
    return ensure_checkpoint_dir(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (never machine-local)."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
