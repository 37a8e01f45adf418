"""Scratch tables in the folder that all machines share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_path(spark: SparkSession, what: str) -> str:
    """A fresh path under spark.checkpoint.dir; under a folder of this machine only where that isn't set, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    base = base or tempfile.mkdtemp(prefix="quantloom-")
    return f"{base.rstrip('/')}/quantloom-{what}-{uuid.uuid4().hex}"
