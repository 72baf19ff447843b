"""Where a job may write its scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting (a test) falls back to a temporary folder,
    since executors of a cluster could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
