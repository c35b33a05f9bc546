"""Folders that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; local sessions without that setting use a temporary folder."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master or ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"file://{tempfile.gettempdir()}/checkpoints"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
