"""Immutable dataset versions: ordered Parquet and JSON lines, and a manifest that is written last."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def next_version(names: Sequence[str]) -> str:
    """``v`` and three digits or more, one above the highest there is; other names don't count."""
    return f"v{max([int(m[1]) for n in names if (m := re.fullmatch(r'v(\d{3,})', n))], default=0) + 1:03d}"


def folder_names(spark: SparkSession, path: str) -> list[str]:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def delete_folder(spark: SparkSession, path: str) -> None:
    """Drop a folder of intermediate files."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def clear_partitions(spark: SparkSession, path: str, column: str, values: Sequence[str]) -> None:
    """Drop the partitions of a folder that hold the values given, as far as there are any."""
    there = set(folder_names(spark, path)) if values else set()
    for name in (f"{column}={value}" for value in values):
        if name in there:
            delete_folder(spark, f"{path}/{name}")


def json_line(df: DataFrame) -> Column:
    """A row as JSON with nulls; decimals as text, dates and times in ISO form."""
    return F.to_json(F.struct(*((F.col(f"`{n}`").cast("string") if t.startswith("decimal") else F.col(f"`{n}`")).alias(n) for n, t in df.dtypes)), {"ignoreNullFields": "false"})


def content_fingerprint(df: DataFrame) -> tuple[int, str]:
    """Row count and an order-free digest of the rows, which does not depend on how they are cut into files."""
    row = F.xxhash64(json_line(df))
    n, total, mixed = df.agg(F.count(F.lit(1)), F.sum(row.cast("decimal(38,0)")), F.bit_xor(row)).first()
    return n, f"{int(total or 0):x}.{int(mixed or 0) & (1 << 64) - 1:016x}"


#: Rows of a part file at first, and bytes that none may exceed: parts are hashed as whole values, which Spark limits to 2 GB.
PART_ROWS, PART_BYTES = 5_000_000, 1 << 30


def bounded_parts(write: Callable[[int], None], spark: SparkSession, path: str, *, rows: int, most: int) -> int:
    """Call ``write`` with a number of rows for each part file until no part under ``path`` is larger than ``most`` bytes.

    What was too large is dropped and written anew with as many rows as its size asks for; returns that number.
    """
    while True:
        write(rows)
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        largest = max((s.getLen() for s in target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(target) if s.isFile()), default=0)
        if largest <= most or rows == 1:
            return rows
        delete_folder(spark, path)
        rows = max(1, int(rows * most / largest * 0.8)) if rows * most > largest else 1


def export_dataset(df: DataFrame, root: str, *, key: str = "id", target: str | None = None, snapshot: str = "none", formats: Sequence[str] = ("parquet", "jsonl"), notes: str = "", part_rows: int = PART_ROWS, part_bytes: int = PART_BYTES) -> str:
    """Write ``df``, ordered by ``key`` across part files, as a new version under ``root``; returns its name.

    The version counts once ``manifest`` is there. Empty input is allowed. Nothing is ever overwritten. No part has more than
    ``part_rows`` rows or ``part_bytes`` bytes (a single row may), so that each can be hashed, however large the version is.
    """
    spark = df.sparkSession
    version = next_version(folder_names(spark, root))
    path = f"{root}/{version}"
    ordered = df.repartitionByRange(key).sortWithinPartitions(key) if df.head(1) else df
    bounded_parts(lambda rows: ordered.write.mode("errorifexists").option("maxRecordsPerFile", rows).parquet(f"{path}/parquet"), spark, f"{path}/parquet", rows=part_rows, most=part_bytes)
    stored = spark.read.schema(df.schema).parquet(f"{path}/parquet")
    if "jsonl" in formats:
        lines = stored.repartitionByRange(key).sortWithinPartitions(key) if stored.head(1) else stored
        text = lines.select(json_line(stored).alias("value"))
        bounded_parts(lambda rows: text.write.mode("errorifexists").option("maxRecordsPerFile", rows).text(f"{path}/jsonl"), spark, f"{path}/jsonl", rows=part_rows, most=part_bytes)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    hashed = files.select("path", "length", F.sha2("content", 256).alias("sha256"))
    nulls = stored.agg(F.count_if(F.col(target).isNull())).first()[0] if target else None
    n, fingerprint = content_fingerprint(stored)
    head = {"version": version, "rows": n, "content": fingerprint, "schema": [{"name": a, "type": b} for a, b in df.dtypes], "target": target, "target_nulls": nulls, "source_snapshot": snapshot, "notes": notes}
    spark.createDataFrame([(json.dumps(head, ensure_ascii=False, sort_keys=True),)], "value string").coalesce(1).write.mode("errorifexists").text(f"{path}/manifest-head")
    hashed.write.mode("errorifexists").parquet(f"{path}/manifest")
    return version


def read_manifest(spark: SparkSession, path: str) -> tuple[dict, DataFrame]:
    """(head, files with length and sha256) of a complete version; one without its manifest is an error."""
    files = spark.read.parquet(f"{path}/manifest")
    return json.loads(spark.read.text(f"{path}/manifest-head").first()[0]), files
