"""Where intermediate tables go."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def fresh_directory(spark: SparkSession, name: str) -> str:
    """A path not used before, under the shared folder the cluster names in
    ``spark.checkpoint.dir``."""
    shared = spark.conf.get(SETTING, None)
    if not shared:
        raise ValueError(f"set {SETTING} to a folder every executor can reach")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
