"""Where queries put files of their own: a new folder under the one that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from .operators.export import folder_names


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in ``spark.checkpoint.dir``. Where that is unset a local session gets a temporary folder; on a cluster it is an
    error, as executors would write to disks of their own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{(base or tempfile.gettempdir()).rstrip('/')}/listwell-{name}-{uuid.uuid4().hex}"


#: Names that are changed at a time.
RENAMES_AT_ONCE = 16


def rename_files(spark: SparkSession, source: str, target: str, suffix: str) -> None:
    """Move a folder that Spark wrote to ``target`` and give its part files another suffix; names only, no data."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(source).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.rename(path(source), path(target))
    names = [n for n in folder_names(spark, target) if n.startswith("part-")]

    def rename(name: str) -> None:
        if not fs.rename(path(f"{target}/{name}"), path(f"{target}/{name.rsplit('.', 1)[0]}.{suffix}")):
            raise OSError(f"not renamed: {target}/{name}")

    with ThreadPoolExecutor(RENAMES_AT_ONCE) as pool:
        list(pool.map(rename, names))
