"""Session settings the jobs are written for, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesces small shuffle partitions, splits skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Stream-stream joins and daily actives hold keys for days: keep that state off the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting a store's rows takes a read per write.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # One RocksDB instance per partition and join instead of four.
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with :data:`SETTINGS`; cluster sizing stays with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Executors on other hosts must see it, so a machine-local folder is used only when the
    session itself is local and names none.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        root = os.path.join(tempfile.gettempdir(), "sluice")
        os.makedirs(root, exist_ok=True)
        return root
    raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below :func:`scratch_root`; never reused between runs."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
