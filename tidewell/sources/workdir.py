"""A new folder for a query that writes before it reads, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def new_folder(spark: SparkSession, name: str) -> str:
    """Below spark.checkpoint.dir; a local session without one gets a folder of its own, a cluster must name one."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = f"file://{tempfile.mkdtemp(prefix='tidewell-')}"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
