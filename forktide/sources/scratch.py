"""Where intermediate tables may live: a folder every executor can reach."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only in local mode, where it is unset."""
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {SETTING} to a folder all executors share")
    return tempfile.mkdtemp(prefix="forktide-")


_MADE: list[tuple[str, str]] = []


def fresh(spark: SparkSession, purpose: str) -> tuple[str, str]:
    """A new folder for one use, and a database name to go with it; see ``release``."""
    name = f"{purpose}_{uuid.uuid4().hex[:12]}"
    _MADE.append((f"{shared_folder(spark)}/{name}", name))
    return _MADE[-1]


def release(spark: SparkSession) -> int:
    """Drop all databases and folders that ``fresh`` gave out in this process; returns how many.

    Only the caller knows when the DataFrames over them are no longer needed.
    """
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = len(_MADE)
    while _MADE:
        folder, database = _MADE.pop()
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
        path = paths(folder)
        path.getFileSystem(conf).delete(path, True)
    return n
