"""Session construction and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

# What right answers need: timestamps are read and cut in UTC.
PINNED_CONF = {"spark.sql.session.timeZone": "UTC"}

# Settings of a session that is built here. A session that somebody else built
# keeps its own.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM never compiles a method above 8000 bytes of code. A stage fused
    # into a larger one would be interpreted; unfused it is several times faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# For streams with state of many users or ids: keep it in RocksDB on the
# executors' disks instead of their heaps, and checkpoint only what changed.
LARGE_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_local_roots: dict[str, str] = {}


def pin_session(spark: SparkSession) -> SparkSession:
    """Set the options that results depend on, and no others, on any session."""
    for key, value in PINNED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def use_large_state(spark: SparkSession) -> SparkSession:
    """Keep the state of streams started from now on in RocksDB."""
    for key, value in LARGE_STATE_CONF.items():
        spark.conf.set(key, value)
    return spark


def get_session(
    app_name: str | None = None,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    log_level: str | None = None,
    **conf: str,
) -> SparkSession:
    """Return the active session, or build one.

    The master is only chosen here when neither an active session nor the
    launcher (spark-submit) has chosen one. Extra options are given as keyword
    arguments with ``__`` for dots: ``spark__driver__memory="4g"``.
    """
    active = SparkSession.getActiveSession()
    if active is None:
        builder = SparkSession.builder.appName(app_name or os.getenv("SPARK_APP_NAME", "ledgerlens"))
        master = master or os.getenv("SPARK_MASTER")
        if master is None and not SparkConf().contains("spark.master"):
            master = "local[*]"
        if master is not None:
            builder = builder.master(master)
        for key, value in RUNTIME_CONF.items():
            builder = builder.config(key, value)
        for key, value in conf.items():
            builder = builder.config(key.replace("__", "."), value)
        active = builder.getOrCreate()
        active.sparkContext.setLogLevel(log_level or os.getenv("SPARK_LOG_LEVEL", "WARN"))
    elif log_level:
        active.sparkContext.setLogLevel(log_level)
    if shuffle_partitions is not None:
        active.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return pin_session(active)


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for checkpoints and written tables.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``.
    Without that setting only a local master gets a temporary folder: on a
    cluster, executors could not read each other's machine-local files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="ledgerlens-")
        root = _local_roots[app]
    return f"{root.rstrip('/')}/ledgerlens/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"
