"""File manifests: discovery, content hash, admission and dialect of input files, as one DataFrame row per file."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.export import folder_names

# File kinds taken in, largest file, size of the inspected beginning, share of control bytes that makes a
# text binary, candidate delimiters in order of preference.
SUFFIXES = ("csv", "xlsx", "json", "jsonl", "ndjson")
MAX_FILE_BYTES = 500 * 1024 * 1024
SAMPLE_BYTES = 65_536
MAX_CONTROL_SHARE = 0.30
DELIMITERS = (",", ";", "\t")
#: How many times as much of a file is looked at where its first record goes on.
GROWTH = 16
#: Suffixes in any case, as a glob.
_ANY_CASE = ",".join("".join(f"[{c}{c.upper()}]" for c in suffix) for suffix in SUFFIXES)


def file_manifest(spark: SparkSession, paths: list[str], *, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """(path, name, suffix, bytes, content_hash, head) of the files at ``paths``; a directory is taken one level deep.

    A missing path is an error. Files over ``max_bytes`` are listed without being read.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{{{_ANY_CASE}}}").option("recursiveFileLookup", "false").load(paths)
    name = F.element_at(F.split("path", "/"), -1)
    known = [F.col("path"), name.alias("name"), F.lower(F.element_at(F.split(name, r"\."), -1)).alias("suffix"), F.col("length").alias("bytes")]
    read = files.where(F.col("length") <= max_bytes).select(*known, F.sha2("content", 256).alias("content_hash"), F.substring("content", 1, SAMPLE_BYTES).alias("head"))
    large = files.where(F.col("length") > max_bytes).select(*known, F.lit(None).cast("string").alias("content_hash"), F.lit(None).cast("binary").alias("head"))
    return read.unionByName(large).unionByName(_empty_files(spark, paths, read.schema))


def _empty_files(spark: SparkSession, paths: list[str], schema) -> DataFrame:
    """Files without a byte, which a scan leaves out: they are found by listing."""
    hadoop, rows = spark.sparkContext._jvm.org.apache.hadoop.fs, []
    for p in paths:
        path = hadoop.Path(p)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        # folders and files are listed at once; of most files nothing but the length is asked for
        for status in fs.listStatus(hadoop.FileUtil.stat2Paths(fs.globStatus(path))):
            if status.getLen() == 0 and status.isFile():
                name = status.getPath().getName()
                suffix = name.rsplit(".", 1)[-1].lower()
                if suffix in SUFFIXES:
                    rows.append((status.getPath().toString(), name, suffix, 0, None, None))
    return spark.createDataFrame(rows, schema)


def refusal(max_bytes: int = MAX_FILE_BYTES) -> Column:
    """Why a file of the manifest is not taken in, or null."""
    control = F.regexp_count(F.decode("head", "ISO-8859-1"), F.lit(r"[\x00-\x08\x0B\x0C\x0E-\x1F]"))
    nul = F.instr(F.decode("head", "ISO-8859-1"), "\x00") > 0
    binary = (F.col("suffix") == "csv") & (nul | (control > MAX_CONTROL_SHARE * F.octet_length("head")))
    return F.when(F.col("bytes") == 0, "empty file").when(F.col("bytes") > max_bytes, "file too large").when(binary, "looks binary, not text")


def _valid_utf8(head: Column) -> Column:
    """A sample that was cut may end inside a character."""
    n = F.octet_length(head)
    cut = [F.is_valid_utf8(F.substring(head, F.lit(1), n - k).cast("string")) for k in (1, 2, 3)]
    return F.is_valid_utf8(head.cast("string")) | ((n >= SAMPLE_BYTES) & (cut[0] | cut[1] | cut[2]))


def with_dialect(manifest: DataFrame) -> DataFrame:
    """Adds ``encoding`` (UTF-8 if the sample decodes so, else windows-1251), ``delimiter`` and ``header`` for text files.

    The delimiter is counted on the first line, as far as the sample goes. The header is the first line, or null where that
    has quotes or doesn't end within the sample: ``first_records`` finds those.
    """
    encoding = F.when(_valid_utf8(F.col("head")), "UTF-8").when(F.instr(F.decode("head", "ISO-8859-1"), "\x98") > 0, "UTF-8").otherwise("windows-1251")
    # other files' bytes are no text; of text, bytes that are none are replaced
    text = F.when(F.col("suffix") != "csv", None).when(F.col("encoding") == "UTF-8", F.make_valid_utf8(F.col("head").cast("string"))).otherwise(F.decode("head", "windows-1251"))
    text = F.regexp_replace(text, "^\ufeff", "")
    line = F.regexp_replace(F.substring_index(text, "\n", 1), "\r$", "")
    ends = (F.col("bytes") <= SAMPLE_BYTES) | (F.instr(text, "\n") > 0)
    count = [F.length("header_line") - F.length(F.replace("header_line", F.lit(d))) for d in DELIMITERS]
    best = F.greatest(*count)
    delimiter = F.when(best <= 0, DELIMITERS[0])
    for d, n in zip(DELIMITERS, count, strict=True):
        delimiter = delimiter.when(n == best, d)
    known = manifest.withColumn("encoding", encoding).withColumn("header_line", line).withColumn("header", F.when(ends & ~F.contains("header_line", F.lit('"')), F.col("header_line")))
    return known.withColumn("delimiter", delimiter).drop("header_line")


def record_end(data: bytes) -> int:
    """Where the first record ends, without its line break; -1 if it goes on. Quotes, doubled ones too, hold line breaks."""
    raw = np.frombuffer(data, np.uint8)
    breaks = np.flatnonzero(raw == 0x0A)
    outside = np.searchsorted(np.flatnonzero(raw == 0x22), breaks) % 2 == 0
    if not outside.any():
        return -1
    end = int(breaks[outside][0])
    return end - 1 if end and raw[end - 1] == 0x0D else end


def first_records(spark: SparkSession, files: dict[str, str], *, sample: int = SAMPLE_BYTES) -> dict[str, str]:
    """The whole first record of each file (path -> encoding), however long it is.

    As much of a file is looked at as it takes: first a sample, then ``GROWTH`` times as much of those whose record goes on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                head = b.column(1)[i].as_py()
                end = record_end(head)
                end = len(head) if end < 0 and len(head) == b.column(2)[i].as_py() else end
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, 1), pa.array([head[:end] if end >= 0 else None], pa.binary())], names=["path", "record"])

    found: dict[str, str] = {}
    while left := [p for p in files if p not in found]:
        heads = spark.read.format("binaryFile").load(left).select("path", F.substring("content", 1, sample).alias("head"), "length")
        for path, record in heads.mapInArrow(run, "path string, record binary").where("record IS NOT NULL").collect():  # a header for each file
            found[path] = bytes(record).decode(files[path], "replace").removeprefix("\ufeff")
        sample *= GROWTH
    return found


ARCHIVE = "name string, content binary, content_hash string"
#: Bytes of the paths of new contents up to which they are broadcast, if they aren't all files there are.
BROADCAST_PATHS = 64 << 20


def archive_raw(spark: SparkSession, paths: list[str], archive: str) -> DataFrame:
    """Append files whose content is not yet in the archive (content_hash, name, content); returns the manifest of those.

    The same bytes are stored once, whatever the file is called. One path is chosen for each new content; bytes go from the
    scan to the archive without a shuffle, files of a task to one of the archive. An archive that began with a folder for
    each content goes on so.
    """
    clean = F.regexp_replace(F.element_at(F.split("path", "/"), -1), "[^A-Za-z0-9._-]", "_")
    files, sha = spark.read.format("binaryFile").load(paths), F.sha2("content", 256).alias("content_hash")
    known = spark.read.schema(ARCHIVE).parquet(archive).select("content_hash") if _exists(spark, archive) else None
    hashed = files.select("path", sha).persist()
    try:
        fresh = hashed if known is None else hashed.join(known.distinct(), "content_hash", "left_anti")
        chosen = fresh.groupBy("content_hash").agg(F.min_by("path", F.struct(clean, "path")).alias("path")).collect()  # a row for each file
        if chosen and len(chosen) < hashed.count():
            some = spark.createDataFrame([(r["path"],) for r in chosen], "path string")
            files = files.join(F.broadcast(some) if sum(len(r["path"]) for r in chosen) <= BROADCAST_PATHS else some.hint("merge"), "path", "left_semi")
    finally:
        hashed.unpersist()
    if chosen or known is None:
        rows = (files if chosen else files.limit(0)).select(clean.alias("name"), "content", sha).write.mode("append")
        by_content = known is not None and any(n.startswith("content_hash=") for n in folder_names(spark, archive))
        (rows.partitionBy("content_hash") if by_content else rows).parquet(archive)
    return spark.createDataFrame([(r["content_hash"],) for r in chosen], "content_hash string").join(spark.read.schema(ARCHIVE).parquet(archive), "content_hash").select("content_hash", "name")


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
