"""A place for tables that a query makes on its way, in the folder which all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's checkpoint folder; a single-machine run which names none gets its own folder."""
    root = spark.conf.get(SETTING, None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"{SETTING} must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="hushline-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
