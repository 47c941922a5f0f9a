"""Hierarchical packing of tokenized documents into windows of several sizes.

Documents are cut into pieces of at most the largest window; what is left of each is routed to the tier of the smallest
window that holds it. Tiers are packed from the largest down: a tier's own pieces open its windows, gaps are filled best fit
with whole pieces of shorter tiers, and what stays open is closed with the beginning of a longer one, whose rest goes back
to the tier of its new length. No more windows open than there are tokens to fill them, so every window is full; fewer
tokens than the smallest window are left at the very end and go to windows of powers of two. Windows of one size are dealt
into step groups of equal token counts, and the groups of all tiers are interleaved in proportion.

The plan is made on the histogram of piece lengths, which has no more bins than a window has tokens: it works on runs of
ranks by length and never on documents. Ranks come from counts by (length, writing task), so no length is ranked in one task.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .memory import cached, lean
from .packing import ENCODED_BYTES
from .spaced_encoding import SpacedEncoder
from .storage import written
from .words import text_slices

TIERS = (2048, 1024, 512, 256)
#: Tokens of a step group, a multiple of every window.
STEP_TOKENS = 16_384


def tokenized_pieces(docs: DataFrame, *, tokenizer: str, max_tokens: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(id, start, length, doc_tokens, ids_crc32, ids binary, bucket, ordinal): each document's ids and ``end_id``, cut.

    ``bucket`` is the task, ``ordinal`` counts its pieces of one length: to be written before it is used.
    """
    schema = "id long, start long, length int, doc_tokens long, ids_crc32 long, ids binary, bucket int, ordinal long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = cached(f"units {tokenizer}", lambda: SpacedEncoder(tokenizer))
        seen, bucket = np.zeros(max_tokens + 1, np.int64), TaskContext.get().partitionId()
        for b in batches:
            for row, rows, data, offsets in text_slices(b.column(1), ENCODED_BYTES):
                ids, first = encoder.encode(data, offsets)
                size = np.diff(first) + 1
                ends = np.cumsum(size)
                out = np.full(int(ends[-1]), end_id, "<u4")
                inside = np.ones(len(out), bool)
                inside[ends - 1] = False
                out[inside] = ids
                n = -(-size // max_tokens)
                doc = np.repeat(np.arange(rows), n)
                start = (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)) * max_tokens
                length = np.minimum(max_tokens, size[doc] - start)
                at = (ends - size)[doc] + start
                raw = memoryview(out).cast("B")
                crc = [zlib.crc32(raw[4 * a : 4 * (a + k)]) for a, k in zip(at.tolist(), length.tolist(), strict=True)]
                # ordinals go on by length from what the task has seen
                order = np.argsort(length, kind="stable")
                by = length[order]
                ordinal = np.empty(len(length), np.int64)
                ordinal[order] = np.arange(len(by)) - np.searchsorted(by, by) + seen[by]
                seen += np.bincount(length, minlength=max_tokens + 1)
                packed = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer((np.append(at, len(out)) * 4).astype(np.int32).tobytes()), pa.py_buffer(raw)])
                columns = [b.column(0).take(pa.array(row + doc)), pa.array(start), pa.array(length.astype(np.int32)), pa.array(size[doc]), pa.array(crc, pa.int64()), packed, pa.array(np.full(len(at), bucket, np.int32)), pa.array(ordinal)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "start", "length", "doc_tokens", "ids_crc32", "ids", "bucket", "ordinal"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(lean(run, f"units {tokenizer}"), schema)


@dataclass(frozen=True)
class Run:
    """``count`` pieces of one original ``length`` from rank ``first`` on, of which ``start`` tokens are placed."""

    length: int
    first: int
    count: int
    start: int = 0
    level: int = 0  # cuts so far

    @property
    def left(self) -> int:
        return self.length - self.start


@dataclass
class Plan:
    """Where runs go: (level, length, first rank, count, start, tokens, window size, first window, offset)."""

    parts: list[tuple[int, ...]] = field(default_factory=list)
    windows: dict[int, int] = field(default_factory=lambda: defaultdict(int))


class _Stock:
    """Runs that wait for a place, by tokens left."""

    def __init__(self, histogram: np.ndarray):
        self.runs: list[list[Run]] = [[] for _ in histogram]
        self.count = np.zeros(len(histogram), np.int64)
        for length in np.flatnonzero(histogram).tolist():
            if length:
                self.add(Run(length, 0, int(histogram[length])))

    def add(self, run: Run) -> None:
        self.runs[run.left].append(run)
        self.count[run.left] += run.count

    def take(self, left: int, most: int) -> Run:
        """A run with ``left`` tokens each, of no more than ``most`` pieces."""
        run = self.runs[left].pop()
        if run.count > most:
            self.runs[left].append(Run(run.length, run.first + most, run.count - most, run.start, run.level))
            run = Run(run.length, run.first, most, run.start, run.level)
        self.count[left] -= run.count
        return run

    def tokens(self) -> int:
        return int(self.count @ np.arange(len(self.count)))

    def longest(self, most: int | None = None) -> int:
        """The most tokens left of any piece, within a bound; zero if there is none."""
        at = np.flatnonzero(self.count[: None if most is None else most + 1])
        return int(at[-1]) if len(at) else 0


def _pack_tier(stock: _Stock, plan: Plan, size: int, least: int) -> None:
    """Open windows for pieces of ``least`` tokens and more, and fill them all."""
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]  # (first window, windows) by open tokens
    open_ = np.zeros(size + 1, np.int64)

    def place(run: Run, tokens: int, window: int, gap: int) -> None:
        plan.parts.append((run.level, run.length, run.first, run.count, run.start, tokens, size, window, size - gap))
        if tokens < run.left:
            stock.add(Run(run.length, run.first, run.count, run.start + tokens, run.level + 1))
        if gap > tokens:
            gaps[gap - tokens].append((window, run.count))
            open_[gap - tokens] += run.count

    def fill(gap: int, left: int, tokens: int) -> None:
        window, n = gaps[gap].pop()
        run = stock.take(left, n)
        if n > run.count:
            gaps[gap].append((window + run.count, n - run.count))
        open_[gap] -= run.count
        place(run, tokens, window, gap)

    while (left := stock.longest()) > size:
        run = stock.take(left, int(stock.count[left]))
        place(run, size, plan.windows[size], size)
        plan.windows[size] += run.count
    may = stock.tokens() // size
    while may and (left := stock.longest()) >= least:
        run = stock.take(left, may)
        place(run, left, plan.windows[size], size)
        plan.windows[size] += run.count
        may -= run.count
    for left in range(stock.longest(), 0, -1):
        while stock.count[left] and len(fits := np.flatnonzero(open_[left:])):
            fill(int(fits[0]) + left, left, left)
    while len(at := np.flatnonzero(open_)):
        gap = int(at[-1])
        left = stock.longest(gap) or stock.longest()
        fill(gap, left, min(left, gap))


def plan_tiers(histogram: np.ndarray, tiers: tuple[int, ...] = TIERS) -> Plan:
    """Every token of the histogram's pieces in a window; all windows are full, those of the last rest powers of two."""
    stock, plan = _Stock(histogram), Plan()
    for size, shorter in zip(tiers, (*tiers[1:], 0), strict=True):
        _pack_tier(stock, plan, size, shorter + 1)
    while rest := stock.tokens():
        # one window of the largest power of two: opened by the longest piece, or its beginning
        _pack_tier(stock, plan, 1 << (rest.bit_length() - 1), 1)
    return plan


def _steps(window: np.ndarray, tier: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Step of each window (number within its tier): dealt in turn to the tier's groups, all groups in order of their share."""
    group = window % groups[tier]
    at, n = 2 * group + 1, groups[tier]
    step = group.copy()
    for t, m in enumerate(groups.tolist()):
        share = at * m
        before = np.where(t < tier, (share // n + 1) // 2, -(-share // n) // 2)
        step += np.where(t == tier, 0, np.minimum(before, m))
    return step


def place_pieces(pieces: DataFrame, plan: Plan, *, with_ids: bool) -> DataFrame:
    """Parts of ``pieces`` (with their rank by length) in windows; the plan travels to the tasks, its size bounded by the bins."""
    schema = "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, window int, step_id long" + ", ids array<int>" * with_ids
    sizes = np.array(sorted(plan.windows, reverse=True), np.int64)
    counts = np.array([plan.windows[int(s)] for s in sizes], np.int64)
    base = np.cumsum(counts) - counts
    groups = np.maximum(1, -(-counts * sizes // STEP_TOKENS))
    parts = np.array(sorted(plan.parts), np.int64).reshape(-1, 9)
    levels = [parts[parts[:, 0] == level] for level in range(int(parts[:, 0].max(initial=-1)) + 1)]
    span = int(max((p[2] + p[3] for p in plan.parts), default=0)) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column("length").to_numpy().astype(np.int64), b.column("rank").to_numpy()
            live = np.arange(b.num_rows)
            found = []
            for table in levels:
                key = length[live] * span + rank[live]
                at = np.searchsorted(table[:, 1] * span + table[:, 2], key, "right") - 1
                part = table[at]
                found.append(np.column_stack([live, part[:, 4:8], part[:, 8], rank[live] - part[:, 2]]))
                live = live[part[:, 4] + part[:, 5] < length[live]]
                if not len(live):
                    break
            row, start, tokens, size, window, offset, nth = np.concatenate(found or [np.zeros((0, 7), np.int64)]).T
            tier = np.searchsorted(-sizes, -size)
            window = window + nth
            take = pa.array(row)
            crc = b.column("ids_crc32").to_numpy()[row].copy()
            ids = b.column("ids")
            bounds = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1].astype(np.int64)
            raw = memoryview(ids.buffers()[2]) if len(ids) else memoryview(b"")
            for i in np.flatnonzero(tokens < length[row]).tolist():
                a = int(bounds[row[i]] + 4 * start[i])
                crc[i] = zlib.crc32(raw[a : a + 4 * int(tokens[i])])
            columns = [b.column("id").take(take), pa.array(b.column("start").to_numpy()[row] + start), pa.array(tokens), pa.array(crc), b.column("doc_tokens").take(take), pa.array(base[tier] + window), pa.array(offset), pa.array(size.astype(np.int32)), pa.array(_steps(window, tier, groups))]
            if with_ids:
                flat = [np.frombuffer(raw, "<i4", int(n), int(bounds[r] + 4 * s)) for r, s, n in zip(row, start, tokens, strict=True)]
                columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(tokens)]).astype(np.int32)), pa.array(np.concatenate([np.zeros(0, np.int32), *flat]))))
            yield pa.RecordBatch.from_arrays(columns, names=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window", "step_id", "ids"][: len(columns)])

    return pieces.select("id", "start", "length", "ids_crc32", "doc_tokens", "ids", "rank").mapInArrow(lean(run), schema)


def pack_tiers(docs: DataFrame, *, tokenizer: str, tiers: tuple[int, ...] = TIERS, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(``id_col``, start, length, ids_crc32, doc_tokens, sequence_id, offset, window, step_id[, ids]): a row for each part.

    Every id lies in one part, every window is full; a window is one of ``tiers`` (falling powers of two), but for the
    last tokens, fewer than the smallest tier, which go to smaller powers of two. Windows of one ``step_id`` have one size
    and hold ``STEP_TOKENS`` together, fewer where a tier's windows don't divide evenly. A null or empty text is ``end_id``
    alone; null ids and repeated rows are packed like others. An empty table gives an empty result; other columns are not
    looked at. A long text is held whole by one task, its ids are cut at once.
    """
    if list(tiers) != sorted({*tiers}, reverse=True) or any(t & (t - 1) or not 1 <= t <= STEP_TOKENS for t in tiers):
        raise ValueError(f"tiers must be falling powers of two up to {STEP_TOKENS}")
    pieces = written(tokenized_pieces(docs, tokenizer=tokenizer, max_tokens=tiers[0], end_id=end_id, id_col=id_col, text_col=text_col), "tier-pieces")
    counts = pieces.groupBy("bucket", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # a written table, so that its size is known when the join is planned
    offsets = written(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "tier-offsets")
    histogram = np.zeros(tiers[0] + 1, np.int64)
    for length, n in offsets.groupBy("length").agg(F.sum("n")).collect():  # as many rows as a window has tokens
        histogram[length] = n
    ranked = pieces.join(offsets.drop("n"), ["bucket", "length"]).withColumn("rank", F.col("ordinal") + F.col("before"))
    return place_pieces(ranked, plan_tiers(histogram, tiers), with_ids=with_ids).withColumnRenamed("id", id_col)
