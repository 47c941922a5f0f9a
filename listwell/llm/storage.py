"""Where intermediate results go: the folder that all executors share, named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's shared folder. Where none is set a local session gets a temporary one; on a cluster it is an error."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="listwell-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through a reliable checkpoint."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder and read it back: later uses share the one result."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._scratch = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a table that ``written`` made, once nothing reads it any more: all that was derived from it must be stored."""
    spark = table.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table._scratch)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
