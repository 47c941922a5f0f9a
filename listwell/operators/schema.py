"""Reconciling a batch with the table it goes to: columns are only ever added, and existing types hold."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .export import folder_names

# Pairs of types that may meet; the table's type is kept.
COMPATIBLE = ({"bigint", "double"}, {"int", "bigint"}, {"int", "double"}, {"float", "double"})


class SchemaConflict(ValueError):
    """A column's new type can't be stored in the table's type."""


def merged_schema(table: StructType | None, batch: StructType) -> StructType:
    """The table's columns, then the batch's new ones as nullable columns."""
    if table is None:
        return StructType([StructField(f.name, f.dataType) for f in batch])
    known = {f.name: f.dataType.simpleString() for f in table}
    for f in batch:
        old, new = known.get(f.name), f.dataType.simpleString()
        if old is not None and old != new and {old, new} not in COMPATIBLE:
            raise SchemaConflict(f"column {f.name}: table has {old}, batch has {new}")
    return StructType([*table, *(StructField(f.name, f.dataType) for f in batch if f.name not in known)])


def aligned(batch: DataFrame, schema: StructType) -> DataFrame:
    """``batch`` under ``schema``: missing columns null, present ones cast; a value that doesn't fit becomes null."""
    return batch.select(*((F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in batch.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema))


def added_columns(declared: StructType, actual: StructType) -> list[str]:
    """Declared columns that a table lacks, in declared order."""
    have = set(actual.fieldNames())
    return [f.name for f in declared if f.name not in have]


class KeptSchema:
    """The schema of a folder of Parquet files, kept beside them, so that it is known before there is a row.

    Each change is a numbered version of its own that Spark writes; the last one that was committed counts. Scans of the
    data don't see it, as its name begins with an underscore.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.path = spark, f"{folder}/_schema"

    def _versions(self) -> list[int]:
        return sorted(int(name[1:]) for name in folder_names(self.spark, self.path) if name.startswith("v"))

    def read(self) -> StructType | None:
        for version in reversed(self._versions()):
            if "_SUCCESS" in folder_names(self.spark, f"{self.path}/v{version:06d}"):
                return StructType.fromJson(json.loads(self.spark.read.text(f"{self.path}/v{version:06d}/part-*").first()[0]))
        return None

    def write(self, schema: StructType) -> None:
        """Keep ``schema``, unless it is what is kept already."""
        if schema != self.read():
            version = max(self._versions(), default=0) + 1
            self.spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(f"{self.path}/v{version:06d}")
