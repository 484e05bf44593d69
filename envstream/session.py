"""Session settings the operators rely on, and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Tables hold UTC instants; durations, dates and text forms of timestamps assume this zone.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Held results may be merged into fewer partitions, too, or each has a task per shuffle partition.
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder that every executor sees, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="envstream-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared folder; it is named, not created."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
