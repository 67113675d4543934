"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
}


def build_session(app: str = "fairwait", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the operators expect.

    ``extra`` uses ``__`` for dots: ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, shared by all executors.

    Only a local session without that setting gets a temporary folder; a cluster
    without it is an error, since a machine-local folder would not survive there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = spark.conf.get("fairwait.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="fairwait-")
        spark.conf.set("fairwait.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared scratch folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
