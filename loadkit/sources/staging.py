"""Where a job may put files that its other tasks read."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_LOCAL: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; in a local session without that setting, one temporary folder of this process."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="loadkit-"))
    return f"file://{_LOCAL[0]}"
