"""Session settings and the folder that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Trips carry no zone; every timestamp is read and shown as UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Target size of a shuffle partition, and so of a file of the processed layer.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # Small batches over many days are bound by the number of files, so they need tasks, not bytes.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.parquet.compression.codec": "snappy",
}


def build_session(app: str = "meterline", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepared(spark: SparkSession) -> SparkSession:
    """The session settings on a session built elsewhere; results depend on the time zone only."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="meterline-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
