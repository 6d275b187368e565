"""Intermediate tables in the folder which all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


_own: dict[str, str] = {}


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's checkpoint folder.

    Where the session names none, a single-machine run (as in tests) gets a temporary
    folder of its own; on a cluster that is an error.
    """
    context = spark.sparkContext
    root = spark.conf.get(SETTING, None) or context.getConf().get(SETTING, None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError(f"{SETTING} must name a folder that all executors share")
        root = _own.get(context.applicationId) or tempfile.mkdtemp(prefix="hushline-shared-")
        _own[context.applicationId] = root
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage is cut, and any executor can read it again."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Removes tables of ``written`` which nothing will read again."""
    for table in tables:
        spark = table.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column of df has it (case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
