"""Tables on plain Parquet with the guarantees of a catalog: versions that appear whole, never change and can be pinned.

A table is a folder of parts, each with numbered versions. A version counts once Spark has committed it (its _SUCCESS
marker, written last); readers see the latest or a pinned one, never a half-written one.

A part may be divided into buckets by a hash of its key. An update then writes a version with the buckets that it touches
alone; the others stay in the version that holds them. Each bucket is a part of its own to snapshots, named ``part#bucket``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Snapshot = dict[str, int]
#: Folder column of buckets.
BUCKET = "_bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row's key."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


@dataclass
class _Divided:
    """The buckets with rows in a version, and what its mark says; a version without a mark doesn't count."""

    held: list[int] = field(default_factory=list)
    whole: bool = False
    buckets: int = 0


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, schema: StructType):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def _versions(self) -> dict[str, list[int]]:
        """Committed versions of each part."""
        return self._found("/_SUCCESS")

    def _found(self, marker: str = "") -> dict[str, list[int]]:
        """Versions of each part that have ``marker``: names in a folder, no data."""
        pattern = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/part=*/v*{marker}")
        found: dict[str, list[int]] = {}
        for status in pattern.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern) or []:
            part, version = re.search(rf"/part=([^/]*)/v(\d+){marker}$", status.getPath().toUri().getRawPath()).groups()
            found.setdefault(unquote(unquote(part)), []).append(int(version))
        return found

    def snapshot(self) -> Snapshot:
        """The latest version of each part, or of each bucket since the part was last written whole."""
        found: Snapshot = {}
        divided = self._divided()
        for part, versions in self._versions().items():
            held = {v: d for v, d in divided.get(part, {}).items() if v in versions and d.buckets}
            if part not in divided:
                found[part] = max(versions)
            whole = max((v for v, d in held.items() if d.whole), default=0)
            for version in sorted(v for v in held if v >= whole):
                found |= {f"{part}#{b}": version for b in held[version].held}
        return found

    def buckets(self, part: str) -> int | None:
        """Into how many buckets a part is divided; None for one that isn't, or isn't there."""
        marked = [d.buckets for _, d in sorted(self._divided().get(part, {}).items()) if d.buckets]
        return marked[-1] if marked else None

    def _divided(self) -> dict[str, dict[int, _Divided]]:
        """Buckets and mark of each version of divided parts: names of folders, no data."""
        pattern = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/part=*/v*/*")
        found: dict[str, dict[int, _Divided]] = {}
        for status in pattern.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern) or []:
            at = re.search(rf"/part=([^/]*)/v(\d+)/(?:{BUCKET}=(\d+)|_(whole|update)_(\d+))$", status.getPath().toUri().getRawPath())
            if at:
                one = found.setdefault(unquote(unquote(at[1])), {}).setdefault(int(at[2]), _Divided())
                if at[3]:
                    one.held.append(int(at[3]))
                else:
                    one.whole, one.buckets = at[4] == "whole", int(at[5])
        return found

    def _path(self, part: str, version: int) -> str:
        name, _, bucket = part.partition("#")
        return f"{self.root}/part={quote(name, safe='')}/v{version:06d}" + (f"/{BUCKET}={bucket}" if bucket else "")

    def read(self, snapshot: Snapshot | None = None, parts: list[str] | None = None) -> DataFrame:
        """All rows of a snapshot (default: the latest), or of some of its parts; an absent table is empty."""
        pinned = self.snapshot() if snapshot is None else snapshot
        paths = [self._path(p, v) for p, v in sorted(pinned.items()) if parts is None or p in parts or p.partition("#")[0] in parts]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _next(self, part: str) -> int:
        """Its number follows that of every folder there is, so one that a failed write left behind is in nobody's way."""
        return max(self._found().get(part, [0])) + 1

    def publish(self, df: DataFrame, part: str = "all") -> Snapshot:
        """Write ``df`` as the next version of a part; versions are never overwritten."""
        version = self._next(part)
        self._typed(df).write.mode("errorifexists").parquet(self._path(part, version))
        return {part: version}

    def publish_buckets(self, df: DataFrame, part: str, keys: Sequence[str], buckets: int, *, whole: bool) -> Snapshot:
        """Write ``df`` as the next version of a part's buckets: all of them, or those alone that ``df`` has rows of.

        Returns the new snapshot of the part. One job writes all buckets, a task for each.
        """
        version = self._next(part)
        path = f"{self.root}/part={quote(part, safe='')}/v{version:06d}"
        rows = self._typed(df).withColumn(BUCKET, bucket_of(keys, buckets))
        rows.repartition(buckets, BUCKET).write.mode("errorifexists").partitionBy(BUCKET).parquet(path)
        # until it is marked a version has no buckets that count
        mark = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_{'whole' if whole else 'update'}_{buckets}")
        mark.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).create(mark).close()
        return {p: v for p, v in self.snapshot().items() if p.partition("#")[0] == part}

    def _typed(self, df: DataFrame) -> DataFrame:
        return df.select(*(df[c.name].cast(c.dataType).alias(c.name) for c in self.schema))


def snapshot_id(snapshot: Snapshot) -> str:
    """A snapshot as text, the same for the same versions."""
    return json.dumps(snapshot, sort_keys=True, ensure_ascii=False) if snapshot else "none"
