"""Where intermediate tables and stream checkpoints go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def work_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session without one gets a temporary folder; on a cluster a missing
    setting is an error, because executors could not see a local folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="feedforge-"))
    return context.getCheckpointDir().rstrip("/")


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder below the work root."""
    return f"{work_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"
