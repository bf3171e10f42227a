"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Settings that change results or plans; everything else is left to spark-submit.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "hailstat", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``master`` is only given for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.driver.memory", os.environ.get("HAILSTAT_DRIVER_MEMORY", "16g"))
            .config("spark.sql.shuffle.partitions", "8")
        )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_time_zone(spark: SparkSession) -> None:
    """Calendar days, weeks and hours are those of UTC whatever the session was started with."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="hailstat-")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for written tables and stream checkpoints.

    It lies below ``spark.checkpoint.dir``. Only a local session without that setting gets a
    temporary folder; a cluster without it is refused, since executors share no local disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_folder()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
