"""Session settings and the shared folder for intermediate results."""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Spares the sort of the large side where the other side's partitions are small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Checkpoints go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "watchlytics", master: str | None = None, **extra: str) -> SparkSession:
    """Session with this library's settings; cluster settings stay with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may do without the setting; it gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    local = spark.sparkContext.master.startswith("local")
    if folder:
        if not local and _is_temporary(folder):
            raise ValueError(f"spark.checkpoint.dir names {folder}, which every machine has for itself")
        return folder.rstrip("/")
    if not local:
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="watchlytics-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def _is_temporary(folder: str) -> bool:
    """Whether a path lies in this machine's folder for temporary files. Other ``file:`` paths may be mounted everywhere."""
    place = urlparse(folder)
    own = os.path.realpath(tempfile.gettempdir())
    return place.scheme == "file" and os.path.commonpath([own, os.path.realpath(place.path)]) == own


def new_folder(spark: SparkSession, purpose: str) -> str:
    """Path of a folder not used before, inside the shared folder."""
    return f"{shared_folder(spark)}/watchlytics/{purpose}-{uuid.uuid4().hex}"


def keep(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` in the shared folder, so that it is computed only once.

    The rows outlive lost executors, unlike cached blocks.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
