"""Append-only run log, one record per unit of work, and the queries over it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.schemas import simple_schema

RUN_LOG = simple_schema(
    "run_id string, stage string, started_at timestamp_ntz, finished_at timestamp_ntz, source_file string, content_hash string, "
    "target_table string, rows_ok bigint, rows_quarantined bigint, rows_deduplicated bigint, schema_json string, status string, error_message string, "
    "source_path string, rows_inserted bigint, rows_updated bigint, rows_unchanged bigint"
)
DONE_INGEST, DONE_TRANSFORM = ("success", "skipped"), ("success", "skipped", "partial")


def status_of(rejected: int, error: str | None) -> str:
    return "failed" if error else "partial" if rejected else "success"


def worst(states: Iterable[str]) -> str:
    """What stands for several units of one name."""
    return max(states, key=("skipped", "success", "partial", "failed").index)


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.UTC).replace(tzinfo=None)


class RunLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        spark.createDataFrame([], RUN_LOG).write.mode("append").parquet(path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(RUN_LOG).parquet(self.path)

    def append(self, records: list[dict]) -> None:
        """Records of one command: one for each unit of work that it began."""
        if records:
            rows = [tuple(r.get(f.name) for f in RUN_LOG) for r in records]
            self.spark.createDataFrame(rows, RUN_LOG).coalesce(1).write.mode("append").parquet(self.path)


def latest_status(log: DataFrame, *keys: str) -> DataFrame:
    """The last record for each key by start; ties by run id."""
    order = Window.partitionBy(*keys).orderBy(F.col("started_at").desc(), F.col("run_id").desc())
    return log.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def stage_totals(log: DataFrame) -> DataFrame:
    return log.groupBy("stage").agg(F.sum("rows_ok").alias("accepted"), F.sum("rows_quarantined").alias("rejected"))


def freshness(log: DataFrame, now) -> DataFrame:
    """Seconds since the latest success of each stage."""
    return log.where("status = 'success'").groupBy("stage").agg(F.timestamp_diff("SECOND", F.max("finished_at"), now).alias("age_seconds"))


def failed_runs(log: DataFrame, limit: int = 200) -> DataFrame:
    """The latest failures, newest first: a report of fixed length."""
    return log.where("status = 'failed'").select("started_at", "run_id", "stage", "source_file", "error_message").orderBy(F.col("started_at").desc(), "run_id").limit(limit)


def stale_sources(log: DataFrame, current: DataFrame) -> DataFrame:
    """Sources whose mapping differs from that of their last success or partial run.

    ``current`` holds (source, fingerprint); the log keeps the fingerprint in ``schema_json``.
    """
    done = log.where("stage = 'transform' AND status IN ('success', 'partial')").withColumn("source", F.col("source_file"))
    last = latest_status(done, "source").select("source", F.get_json_object("schema_json", "$.mapping_config_hash").alias("was"))
    return current.join(last, "source").where("was <> fingerprint").select("source", "was", "fingerprint")
