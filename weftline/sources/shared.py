"""Folders that driver and executors share, below spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new path; where no folder is set, a local one is made in sessions of one process alone."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir names no folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="weftline-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}/{uuid.uuid4().hex}"
