"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder under spark.checkpoint.dir; where that is unset and Spark is local (tests), under a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlark-"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
