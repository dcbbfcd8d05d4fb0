"""A shared folder for data that a job writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the one that the cluster names in ``spark.checkpoint.dir``.

    In local mode, where every task runs on this machine, a temporary folder stands in
    if that setting is missing. On a cluster it must be there.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="reelmetrics-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
