"""A large CSV file read by many tasks, quoted line breaks included.

Lines are read in splits. The quotes of each split are counted first; sums over the splits before it tell whether a split
begins inside quotes. Each task then cuts its lines into records where the parity is even. The pieces of records that
cross a split's bounds, at most two for each split, are put together by a grouping of their own, and Spark's CSV parser
takes the records one by one.

Parity holds for files whose quotes are well-formed. A quote inside an unquoted cell makes records run together: that shows
as a line break that no parsed cell has, and such a file is left to the reader of whole files.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.inference import filled
from ..functions.names import clean_names
from .readers import FILE, ORDINAL, file_path, plain_path, read_csv

#: Splits whose parity the tasks are told, some ten megabytes; the largest load is so many times the size of a split.
MOST_SPLITS = 200_000
PIECES = "file string, block long, part long, at int, text string"


def _lines(spark: SparkSession, paths: list[str], encoding: str) -> DataFrame:
    """(file, block, text) of all lines, in their order within a split; ``block`` is where the split begins."""
    raw = spark.read.option("lineSep", "\n").text(paths)
    text = F.make_valid_utf8("value") if encoding.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    return raw.select(file_path().alias("file"), F.col("_metadata.file_block_start").alias("block"), text.alias("text"))


def _odd_starts(lines: DataFrame) -> dict[tuple[str, int], bool]:
    """Whether each split begins inside quotes: quotes are counted in tasks, the sums run over a row for each split."""
    quotes = F.length("text") - F.length(F.replace("text", F.lit('"')))
    rows = lines.groupBy("file", "block").agg(F.sum(quotes)).limit(MOST_SPLITS + 1).collect()
    if len(rows) > MOST_SPLITS:
        raise ValueError(f"more than {MOST_SPLITS} splits: raise spark.sql.files.maxPartitionBytes")
    starts, before, last = {}, 0, None
    for file, block, n in sorted(map(tuple, rows)):
        before = before if file == last else 0
        starts[file, block] = bool(before % 2)
        before, last = before + n, file
    return starts


def _pieces(lines: DataFrame, starts: dict[tuple[str, int], bool]) -> DataFrame:
    """(file, block, part, at, text): whole records, ``at`` 0; of one that crosses bounds the beginning (1), the end (-1), or all
    of a split (2). ``part`` is the number of its first line within the split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, line, inside = None, 0, False
        held: list[str] = []  # lines of the record that is open, its first line, whether it began before the split
        begin, from_before = 0, False

        def rows(part: list[int] | np.ndarray, at: int, text: pa.Array) -> pa.RecordBatch:
            n = len(text)
            return pa.RecordBatch.from_arrays([pa.array([split[0]] * n), pa.array([split[1]] * n, pa.int64()), pa.array(part, pa.int64()), pa.array([at] * n, pa.int32()), text], names=["file", "block", "part", "at", "text"])

        for b in batches:
            if not b.num_rows:
                continue
            files, blocks = b.column(0).to_pylist(), b.column(1).to_pylist()
            edges = [i for i in range(b.num_rows) if not i or (files[i], blocks[i]) != (files[i - 1], blocks[i - 1])]
            for low, high in zip(edges, [*edges[1:], b.num_rows], strict=True):
                if (files[low], blocks[low]) != split:
                    if held:
                        yield rows([begin], 2 if from_before else 1, pa.array(["\n".join(held)]))
                    split, line, held, begin = (files[low], blocks[low]), 0, [], 0
                    inside = from_before = starts[split]
                text = b.column(2).slice(low, high - low)
                odd = np.cumsum(pc.count_substring(text, '"').to_numpy(zero_copy_only=False)) % 2 == 1
                goes_on = odd ^ inside
                began = np.concatenate([[inside], goes_on[:-1]])
                own = np.flatnonzero(~goes_on & ~began)
                if len(own):
                    yield rows(line + own, 0, text.take(pa.array(own)))
                for i in np.flatnonzero(goes_on | began).tolist():
                    if not began[i]:
                        held, begin, from_before = [], line + i, False
                    held.append(text[i].as_py())
                    if not goes_on[i]:
                        yield rows([begin], -1 if from_before else 0, pa.array(["\n".join(held)]))
                        held, from_before = [], False
                line, inside = line + len(text), bool(goes_on[-1])
        if held:
            yield rows([begin], 2 if from_before else 1, pa.array(["\n".join(held)]))

    return lines.mapInArrow(run, PIECES)


def records_of_pieces(pieces: DataFrame, between: str = "\n") -> DataFrame:
    """(file, block, part, text) of whole records, those that cross bounds put together with ``between``."""
    crossing = pieces.where("at <> 0")
    # two rows for each split of a file at most, the end of a record before the beginning of the next
    along = Window.partitionBy("file").orderBy("block", "part", "at")
    named = crossing.withColumn("begin", F.last(F.when(F.col("at") == 1, F.struct("block", "part")), ignorenulls=True).over(along))
    joined = named.groupBy("file", "begin").agg(F.sort_array(F.collect_list(F.struct("block", "part", "text"))).alias("pieces"))
    text = F.array_join(F.transform("pieces", lambda p: p["text"]), between)
    return pieces.where("at = 0").select("file", "block", "part", "text").unionByName(joined.select("file", "begin.block", "begin.part", text.alias("text")))


def _cells(records: DataFrame, columns: int, delimiter: str) -> DataFrame:
    """``records`` with ``cells``: a struct of text."""
    schema = StructType([StructField(f"c{i}", StringType()) for i in range(columns)])
    options = {"sep": delimiter, "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "maxColumns": str(max(20_480, 2 * columns))}
    return records.withColumn("cells", F.from_csv(F.regexp_replace("text", "\r$", ""), F.lit(schema.simpleString()), options))


def read_csv_splits(spark: SparkSession, paths: list[str], names: list[str], *, delimiter: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """The rows that ``read_csv`` gives for the same files, read in splits; the ordinal is that of a row's place in its file.

    Files whose quotes turn out not to be well-formed, or whose lines end in carriage returns alone, are read whole.
    """
    lines, clean = _lines(spark, paths, encoding), clean_names(names)
    records = records_of_pieces(_pieces(lines, _odd_starts(lines))).where("text NOT IN ('', '\r')")
    placed = _cells(records, len(clean), delimiter)
    breaks = lambda c: F.length(c) - F.length(F.replace(c, F.lit("\n")))
    within = F.aggregate(F.array(*(F.coalesce(breaks(F.col(f"cells.c{i}")), F.lit(0)) for i in range(len(clean)))), F.lit(0), lambda n, x: n + x)
    run_together = placed.where((breaks(F.col("text")) > 0) & (breaks(F.col("text")) != within) | F.regexp_like("text", F.lit("\r[^\n]")) & ~F.contains("text", F.lit('"')))
    header = (F.col("block") == 0) & (F.col("part") == 0)
    odd = {r[0] for r in run_together.where(~header).select("file").distinct().collect()}  # a row for each file
    rows = placed.where(~header & ~F.col("file").isin(list(odd)) if odd else ~header)
    table = rows.select(*(filled(F.col(f"cells.c{i}")).alias(c) for i, c in enumerate(clean)), F.col("file").alias(FILE), (F.col("block") + F.col("part")).alias(ORDINAL))
    whole = [p for p in paths if plain_path(p) in odd]
    return table.unionByName(read_csv(spark, whole, names, delimiter=delimiter, encoding=encoding)) if whole else table
