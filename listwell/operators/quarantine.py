"""Rejected rows with their reasons, one partition for each layer, source and content hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.primitives import record_json
from ..functions.schemas import simple_schema
from .export import clear_partitions

REJECTS = simple_schema("run_id string, raw_record string, reason string, rejected_at timestamp_ntz, layer string, source string, content_hash string")


def reject_rows(rejected: DataFrame, columns: list[str], *, layer: str, source: str, run_id: str, now: Column, reason: str = "_reason") -> DataFrame:
    """Rejected rows in the shape of the quarantine table. ``rejected`` has ``_content_hash``."""
    return rejected.select(F.lit(run_id).alias("run_id"), record_json(columns).alias("raw_record"), F.col(reason).alias("reason"), now.alias("rejected_at"), F.lit(layer).alias("layer"), F.lit(source).alias("source"), F.col("_content_hash").alias("content_hash"))


class Quarantine:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._write(spark.createDataFrame([], REJECTS), "append")

    def _write(self, df: DataFrame, mode: str) -> None:
        df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("layer", "source", "content_hash").parquet(self.path)

    def put(self, rejects: DataFrame) -> None:
        """Replaces what an earlier run left for the same layer, source and content, so that a replay adds nothing twice."""
        self._write(rejects, "overwrite")

    def read(self) -> DataFrame:
        return self.spark.read.schema(REJECTS).parquet(self.path)

    def clear(self, layer: str, source: str, hashes: list[str]) -> None:
        """Drop the rejects of some contents of a source, once they have none any more."""
        clear_partitions(self.spark, f"{self.path}/layer={layer}/source={source}", "content_hash", hashes)

    def counts(self, layer: str, source: str, run_id: str) -> dict[str, int]:
        """Rejects that a run left, by content hash."""
        mine = self.read().where((F.col("layer") == layer) & (F.col("source") == source) & (F.col("run_id") == run_id))
        return {r["content_hash"]: r["count"] for r in mine.groupBy("content_hash").count().collect()}  # a row for each file


def registry(rejects: DataFrame) -> DataFrame:
    """Which rejects there are: rows and last time by layer and source."""
    return rejects.groupBy("layer", "source").agg(F.count(F.lit(1)).alias("n_rejects"), F.max("rejected_at").alias("last_rejected_at"))
