"""A large JSON array of objects read by many tasks.

Text is read in pieces that end at closing braces, so that no task holds more than a record, however few lines a file has.
What a split does to the state (inside a string or not, depth of brackets) is found first; the states at the beginnings of
splits follow from a row for each split. Tasks then cut records where an object of the outermost array ends. Each record is
parsed alone; brackets, commas and the number of bytes are checked, so that a file is taken only if the whole is one array.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import file_path
from .splits import MOST_SPLITS, PIECES, records_of_pieces

_SUMMARY = "file string, block long, odd boolean, outside long, inside long, bytes long, pieces long, opens string, size long"


def _braces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, block, size, bytes, text): what stands before each closing brace, in order within a split."""
    raw = spark.read.option("lineSep", "}").text(paths)
    return raw.select(file_path().alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size"), F.octet_length("value").cast("long").alias("bytes"), F.make_valid_utf8("value").alias("text"))


def _effects(text: pa.Array, closed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each piece: whether its quotes are odd, and what it adds to the depth if it begins outside or inside a string.

    ``closed`` tells which pieces follow a closing brace, which counts with them.
    """
    plain = pc.replace_substring_regex(text, r"(?s)\\.", "")
    odd = pc.count_substring(plain, '"').to_numpy(zero_copy_only=False) % 2 == 1

    def depth(outer: pa.Array) -> np.ndarray:
        n = [pc.count_substring(outer, sign).to_numpy(zero_copy_only=False).astype(np.int64) for sign in "{[]"]
        return n[0] + n[1] - n[2]

    strings = r'"[^"]*(?:"|\z)'
    outside = depth(pc.replace_substring_regex(plain, strings, ""))
    inside = depth(pc.replace_substring_regex(pc.replace_substring_regex(plain, r'\A[^"]*(?:"|\z)', ""), strings, ""))
    return odd, outside - closed, inside


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Runs of rows of one split."""
    for b in batches:
        files, blocks = b.column(0).to_pylist(), b.column(1).to_pylist()
        edges = [i for i in range(b.num_rows) if not i or (files[i], blocks[i]) != (files[i - 1], blocks[i - 1])]
        for low, high in zip(edges, [*edges[1:], b.num_rows], strict=True):
            yield (files[low], blocks[low]), b.slice(low, high - low)


def _closed(split: tuple[str, int], begins: bool, n: int) -> np.ndarray:
    closed = np.ones(n, np.int64)
    if begins and split[1] == 0:
        closed[0] = 0
    return closed


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    split, row = None, {}
    for at, part in _stretches(batches):
        if at != split:
            if row:
                yield pa.RecordBatch.from_pylist([row])
            split, row = at, {"file": at[0], "block": at[1], "odd": False, "outside": 0, "inside": 0, "bytes": 0, "pieces": 0, "opens": "", "size": part.column(2)[0].as_py()}
        text = part.column(4)
        odd, outside, inside = _effects(text, _closed(at, not row["pieces"], len(text)))
        if not row["pieces"]:
            row["opens"] = text[0].as_py().lstrip()[:1]
        begins = np.concatenate([[False], np.cumsum(odd)[:-1] % 2 == 1]) ^ row["odd"]
        row["outside"] += int(np.where(begins, inside, outside).sum())
        row["inside"] += int(np.where(begins, outside, inside).sum())
        row["odd"] ^= bool(odd.sum() % 2)
        row["bytes"] += pc.sum(part.column(3)).as_py()
        row["pieces"] += len(text)
    if row:
        yield pa.RecordBatch.from_pylist([row])


def _pieces(braces: DataFrame, starts: dict[tuple[str, int], tuple[bool, int]], others: frozenset[str]) -> DataFrame:
    """Records and pieces of records that cross bounds, as ``splits`` has them; none of ``others``.

    The scan isn't filtered: one of fewer files could have other splits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, line, begin, whole = None, 0, 0, False
        held: list[str] = []
        inside, depth = False, 0

        def rows(found: list[tuple[int, int, str]]) -> pa.RecordBatch:
            part, at, text = zip(*found, strict=True)
            n = len(found)
            return pa.RecordBatch.from_arrays([pa.array([split[0]] * n), pa.array([split[1]] * n, pa.int64()), pa.array(part, pa.int64()), pa.array(at, pa.int32()), pa.array(text, pa.string())], names=["file", "block", "part", "at", "text"])

        for here, b in _stretches(batches):
            if here[0] in others:
                continue
            if here != split:
                if held:
                    yield rows([(begin, 1 if whole else 2, "".join(held))])
                # the first record of a file begins with it; that of another split began before
                split, line, begin, held, whole = here, 0, 0, [], here[1] == 0
                inside, depth = starts[here]
            text = b.column(4)
            closed = _closed(here, not line, len(text))
            odd, outer, inner = _effects(text, closed)
            begins = np.concatenate([[False], np.cumsum(odd)[:-1] % 2 == 1]) ^ inside
            step = np.where(begins, inner, outer)
            before = depth + np.cumsum(step) - step
            ends = ~begins & (before == 2) & (closed == 1)
            found, values = [], text.to_pylist()
            for i, value in enumerate(values):
                if ends[i]:
                    held.append("}")
                    found.append((begin, 0 if whole else -1, "".join(held)))
                    held, begin, whole = [value], line + i, True
                else:
                    held.append("}" + value if closed[i] else value)
            if found:
                yield rows(found)
            line, inside, depth = line + len(text), bool(inside ^ (odd.sum() % 2 == 1)), int(depth + step.sum())
        if held:
            yield rows([(begin, 1 if whole else 2, "".join(held))])

    return braces.mapInArrow(run, PIECES)


def array_records(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, list[str]]:
    """(file, ordinal, text) of the records of files that hold one array each, and the files that don't begin with one.

    The text of a record is null where the file isn't an array of what stands between its braces: it is broken then.
    """
    braces = _braces(spark, paths)
    splits = braces.mapInArrow(_summaries, _SUMMARY).limit(MOST_SPLITS + 1).collect()  # a row for each split
    if len(splits) > MOST_SPLITS:
        raise ValueError(f"more than {MOST_SPLITS} splits: raise spark.sql.files.maxPartitionBytes")
    starts, found, others, state, last = {}, {}, [], (False, 0), None
    for s in sorted(splits, key=lambda s: (s.file, s.block)):
        if s.file != last:
            state, last, found[s.file] = (False, 0), s.file, [-1, s.size]
            if s.block == 0 and s.opens != "[":
                others.append(s.file)
        starts[s.file, s.block] = state
        state = (state[0] ^ s.odd, state[1] + (s.inside if state[0] else s.outside))
        found[s.file][0] += s.bytes + s.pieces
    short = sorted(f for f, (n, size) in found.items() if n != size and f not in others)
    whole = records_of_pieces(_pieces(braces, starts, frozenset(others)), "")
    first = (F.col("block") == 0) & (F.col("part") == 0)
    space = "[ \\t\\n\\r]*"
    end = F.when(first, F.regexp_like("text", F.lit(f"^{space}\\[{space}\\]{space}\\z"))).otherwise(F.regexp_like("text", F.lit(f"^{space}\\]{space}\\z")))
    sign = F.when(first, F.regexp_like("text", F.lit(f"^{space}\\["))).otherwise(F.regexp_like("text", F.lit(f"^{space},")))
    body = F.when(sign, F.regexp_replace("text", f"^{space}[\\[,]", ""))
    records = whole.where(~end).select("file", (F.col("block") + F.col("part")).alias("ordinal"), body.alias("text"))
    return records.unionByName(spark.createDataFrame([(f, 0, None) for f in short], "file string, ordinal long, text string")), others
