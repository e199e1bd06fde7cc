"""Spark session defaults and shared scratch locations.

Everything that must survive an executor loss (stream checkpoints, stream
sinks, lineage cuts of iterative jobs) goes below the directory the cluster
names in ``spark.checkpoint.dir``.  Only when that setting is absent (local
runs, tests) do we create one of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Session-level settings every flowlab job relies on.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Static settings: only effective when the session is created here.
BUILDER_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
}


def get_session(master: str | None = None, app_name: str = "flowlab",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with flowlab's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {**BUILDER_DEFAULTS, **SESSION_DEFAULTS}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if (master or "").startswith("local"):
        conf["spark.driver.memory"] = "16g"  # one JVM does all the work
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_session_defaults(spark: SparkSession) -> None:
    """Apply the runtime settings to a session someone else built."""
    for k, v in SESSION_DEFAULTS.items():
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, creating a local one if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises in some versions
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            # a machine-local folder would split checkpoints across hosts
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        # local / test runs only
        configured = tempfile.mkdtemp(prefix="flowlab-ckpt-", dir=os.environ.get("FLOWLAB_SCRATCH", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
