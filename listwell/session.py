"""Spark session with the settings that the lakehouse operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Old charsets for Cyrillic CSV files, hash-named partitions kept as text, partition-wise overwrite, and listings of many
#: files or folders by some tasks that take many each, not by a task for each.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}


def session(name: str = "listwell", **more: str) -> SparkSession:
    """A session with ``SETTINGS``; ``more`` holds further settings with dots as double underscores."""
    builder = SparkSession.builder.appName(name)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in more.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
