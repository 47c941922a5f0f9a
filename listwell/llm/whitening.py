"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance is never formed: Spark passes over packed blocks of centred vectors give XᵀXQ for a narrow block Q. A
three-term Chebyshev recurrence over such passes damps the part of the spectrum that isn't wanted, QR makes the block
orthonormal, and a Rayleigh-Ritz step gives eigenvalues, eigenvectors and their residuals. Vectors that have settled are
locked and projected out of what is filtered on. It ends once all wanted residuals are below the tolerance and a random
block orthogonal to all that was found holds no larger eigenvalue.

Only matrices of (dimensions x block) numbers reach the driver, summed in two steps where there are many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import written
from .topk import quantised, usable

#: Vectors of one packed block, and partial results that the driver adds up itself.
BLOCK_ROWS, DRIVER_PARTS = 4_096, 64
#: Columns of the block beyond the wanted ones, passes that bound the spectrum from below, columns of the last probe.
SPARE, LANCZOS_STEPS, PROBE = 16, 12, 8
#: A filter's largest amplification over that of the last wanted value; more would drown it in rounding.
MOST_SPREAD = 1e7
MOST_ROUNDS = 200


@dataclass(frozen=True)
class Vectors:
    """Integer vectors packed as differences from a whole-number centre, with what their statistics say."""

    blocks: DataFrame  # ids array<long>, x binary: rows x width little-endian integers of ``dtype``
    n: int
    center: np.ndarray  # whole numbers near the means
    rest: list[int]  # exact sums of the differences from the centre, by dimension
    dtype: str
    trace: float

    @property
    def width(self) -> int:
        return len(self.center)

    @property
    def shift(self) -> np.ndarray:
        """Mean of the differences: each below one half."""
        return np.array([r / self.n for r in self.rest])


@dataclass(frozen=True)
class Whitening:
    """``vectors`` holds an eigenvector of the covariance in each column; ``identity_error`` is measured over all rows."""

    values: np.ndarray
    vectors: np.ndarray
    residual: float
    explained: np.ndarray
    identity_error: float
    passes: int


def _rows(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of a list column; shorter ones end in zeros."""
    n = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width)[None, :] < n[:, None]] = column.flatten().to_numpy()
    return out


def _summed(partial: DataFrame, parts: int) -> list[bytes]:
    """Rows of (part int, m binary of doubles): the matrices, added up in groups where there are very many."""
    if parts > DRIVER_PARTS:
        fan = math.isqrt(parts)

        def add(group: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(v.as_py()) for c in group.column("m").chunks for v in c)
            return pa.table({"part": pa.array([0], pa.int32()), "m": pa.array([total.tobytes()], pa.binary())})

        partial = partial.withColumn("part", F.col("part") % fan).groupBy("part").applyInArrow(add, "part int, m binary")
    return [bytes(r.m) for r in partial.select("m").collect()]  # DRIVER_PARTS or the root of the tasks' number


def _over_blocks(v: Vectors, each: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all blocks of ``each(centred rows)``."""
    width, dtype, shift = v.width, v.dtype, v.shift

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for x in b.column(0):
                one = each(np.frombuffer(x.as_py(), dtype).reshape(-1, width) - shift)
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "m"])

    found = _summed(v.blocks.select("x").mapInArrow(run, "part int, m binary"), v.blocks.rdd.getNumPartitions())
    return sum(np.frombuffer(m) for m in found)


def packed_vectors(vectors: DataFrame, *, scale: int, offset: int, id_col: str, vector_col: str) -> Vectors | None:
    """The usable vectors as whole numbers floor(scale * c) + offset; None if there are none."""
    x = vectors.where(usable(F.col(vector_col))).select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, low, high = 0, np.zeros(0, object), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            width = max(len(total), int(b.column(1).value_lengths().to_numpy(zero_copy_only=False).max()))
            part = _rows(b.column(1), width)
            grown = np.zeros(width, object)
            grown[: len(total)] = total
            # halves of the numbers, so that no sum of a batch can overflow
            total = grown + (part >> 32).sum(axis=0).astype(object) * (1 << 32) + (part & 0xFFFFFFFF).sum(axis=0).astype(object)
            low, high = (f(np.pad(a, (0, width - len(a))), part.min(axis=0) if f is np.minimum else part.max(axis=0)) for f, a in ((np.minimum, low), (np.maximum, high)))
            n += b.num_rows
        if n:
            k = len(total)
            yield pa.RecordBatch.from_arrays([pa.array([n] * k, pa.int64()), pa.array(range(k), pa.int32()), pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0)), pa.array(low), pa.array(high)], names=["n", "i", "s", "low", "high"])

    stats = x.mapInArrow(sums, "n long, i int, s decimal(38,0), low long, high long").groupBy("i").agg(F.max("n"), F.sum("s").alias("s"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("i").collect()
    n = x.count()
    if not n:
        return None
    width = len(stats)
    # padded zeros are in the sums as they are: centre and rest are those of scaled vectors, the offset cancels out
    center = np.array([round(int(r.s) / n) for r in stats], np.int64)
    rest = [int(r.s) - n * int(c) for r, c in zip(stats, center, strict=True)]
    most = max((max(abs(int(r.low) - int(c)), abs(int(r.high) - int(c)), abs(int(c))) for r, c in zip(stats, center, strict=True)), default=0)
    if most + abs(offset) >= 1 << 62:
        raise ValueError("vector components are too large for 64-bit integers: use a smaller scale")
    dtype = next(t for t, top in (("<i2", 1 << 15), ("<i4", 1 << 31), ("<i8", 1 << 63)) if most < top)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(a, BLOCK_ROWS)
                rows = (_rows(part.column(1), width) - center).astype(dtype)
                ids = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), part.column(0))
                yield pa.RecordBatch.from_arrays([ids, pa.array([rows.tobytes()], pa.binary())], names=["ids", "x"])

    blocks = written(x.mapInArrow(pack, "ids array<long>, x binary"), "whitening-blocks")
    out = Vectors(blocks, n, center, rest, dtype, 0.0)
    return Vectors(blocks, n, center, rest, dtype, float(_over_blocks(out, lambda b: np.array([(b**2).sum()]))[0] / n) if width else 0.0)


class _Covariance:
    """Products with the covariance, one Spark pass each."""

    def __init__(self, v: Vectors):
        self.v, self.passes = v, 0

    def __matmul__(self, q: np.ndarray) -> np.ndarray:
        self.passes += 1
        return _over_blocks(self.v, lambda b: b.T @ (b @ q)).reshape(q.shape) / self.v.n


def _less(locked: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``y`` without its part in the span of ``locked``."""
    return y - locked @ (locked.T @ y)


def _block(locked: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """An orthonormal block for the span of ``y`` beside ``locked``; columns without anything of their own are drawn anew."""
    size = np.linalg.norm(y, axis=0)
    y = _less(locked, y / np.where(size > 0, size, 1.0))
    gone = np.linalg.norm(y, axis=0) < 1e-6
    y[:, gone] = rng.standard_normal((len(y), int(gone.sum())))
    for _ in range(2):
        y = np.linalg.qr(_less(locked, y))[0]
    return y


def lower_end(cov: _Covariance, rng: np.random.Generator, steps: int = LANCZOS_STEPS) -> float:
    """An estimate from below of the smallest eigenvalue by a few Lanczos steps; it need not hold, a filter corrects it."""
    q = rng.standard_normal((cov.v.width, 1))
    basis = [q / np.linalg.norm(q)]
    alpha, beta = [], []
    for _ in range(min(steps, cov.v.width)):
        w = cov @ basis[-1]
        alpha.append((basis[-1].T @ w).item())
        w = _less(np.hstack(basis), _less(np.hstack(basis), w))
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-13 * max(alpha):
            break
        basis.append(w / beta[-1])
    m = len(alpha)
    values, vectors = np.linalg.eigh(np.diag(alpha) + np.diag(beta[: m - 1], 1) + np.diag(beta[: m - 1], -1))
    return max(0.0, float(values[0] - beta[-1] * abs(vectors[-1, 0])))


def filtered(cov: _Covariance, y: np.ndarray, locked: np.ndarray, degree: int, low: float, high: float, top: float) -> np.ndarray:
    """Chebyshev polynomial of the covariance, small on [low, high] and scaled to one at ``top``, applied to ``y``."""
    half, mid = (high - low) / 2, (high + low) / 2
    first = half / (top - mid)
    sigma, before = first, y
    now = _less(locked, cov @ y - mid * y) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        now, before = 2 * after / half * _less(locked, cov @ now - mid * now) - sigma * after * before, now
        sigma = after
    return now


def degree_for(top: float, wanted: float, low: float, high: float, need: float, most: int = 24) -> int:
    """Least degree that damps by ``need``, as far as the largest value's lead over the last wanted one allows."""
    half, mid = (high - low) / 2, (high + low) / 2
    at, lead = (math.acosh(max(1.0 + 1e-9, (x - mid) / half)) for x in (wanted, top))
    allowed = math.log(MOST_SPREAD) / max(lead - at, 1e-9)
    return max(2, min(most, int(allowed), math.ceil(math.log(max(need, 2.0)) / at)))


def principal_components(v: Vectors, components: int, *, tolerance: float = 1e-13, seed: int = 7) -> tuple[np.ndarray, np.ndarray, float, int]:
    """(eigenvalues falling, eigenvectors as columns, largest residual over the first value, passes).

    A value below 1e-12 of the first is none: vectors in a smaller space have fewer components.
    """
    cov, rng, d = _Covariance(v), np.random.default_rng(seed), v.width
    none = np.zeros(0), np.zeros((d, 0)), 0.0, 0
    if not d or v.trace <= 0:
        return none
    want = min(components, d)
    width = min(d, want + SPARE)
    low = lower_end(cov, rng) if width < d else 0.0
    locked, held = np.zeros((d, 0)), np.zeros(0)
    y = rng.standard_normal((d, width))
    for _ in range(MOST_ROUNDS):
        q = _block(locked, y, rng)
        w = cov @ q
        values, turn = np.linalg.eigh((q.T @ w + w.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, w = q @ turn, w @ turn
        first = max(values[0], held.max(initial=0.0))
        off = np.linalg.norm(w - q * values, axis=0)
        settled = off <= tolerance * first
        left = want - len(held)
        if settled[:left].all():
            everything = np.hstack([locked, q])
            probe = np.linalg.qr(_less(everything, rng.standard_normal((d, min(PROBE, d - everything.shape[1])))))[0]
            if not probe.shape[1] or _probed(cov, everything, probe) <= values[:left].min() * (1 + 1e-9) + 1e-12 * first:
                break
            y = np.hstack([q[:, : width - len(held) - probe.shape[1]], probe])
            continue
        # what has settled at the front is locked; the rest is filtered on
        k = int(np.argmin(settled[:left]))
        locked, held = np.hstack([locked, q[:, :k]]), np.append(held, values[:k])
        q, values, off, left = q[:, k:], values[k:], off[k:], left - k
        # the rest lies between the two; what rounding can't tell from zero is zero
        high = max(float(values[-1]), 1e-10 * first)
        low = max(0.0, min(low, high - 1e-3 * high))
        if values[left - 1] - high <= 1e-12 * first:
            y = cov @ q  # nothing to part the wanted from the rest by
            continue
        worst = float(off[:left].max() / (tolerance * first))
        y = filtered(cov, q, locked, degree_for(float(values[0]), float(values[left - 1]), low, high, 10 * worst), low, high, float(values[0]))
    else:
        raise ArithmeticError(f"no convergence in {MOST_ROUNDS} rounds: largest residual {off[:left].max() / first:.2g}")
    q, w = np.hstack([locked, q]), None
    # all together once more: the locked ones and the rest in one Rayleigh-Ritz step
    q = np.linalg.qr(q)[0]
    w = cov @ q
    values, turn = np.linalg.eigh((q.T @ w + w.T @ q) / 2)
    order = np.argsort(-values)[:want]
    values, q, w = values[order], q @ turn[:, order], w @ turn[:, order]
    keep = values > 1e-12 * values[0]
    residual = float(np.linalg.norm(w - q * values, axis=0).max() / values[0])
    return values[keep], q[:, keep], residual, cov.passes


def _probed(cov: _Covariance, found: np.ndarray, probe: np.ndarray) -> float:
    """Largest Ritz value of a block that is orthogonal to all that was found, after a step of power iteration."""
    probe = _less(found, cov @ probe)
    size = np.linalg.norm(probe, axis=0).max(initial=0.0)
    if not size:
        return 0.0
    probe = np.linalg.qr(_less(found, probe / size))[0]
    w = cov @ probe
    return float(np.linalg.eigvalsh((probe.T @ w + w.T @ probe) / 2)[-1])


def fit_whitening(v: Vectors, components: int) -> Whitening:
    """Components of the packed vectors; the covariance of what they give is measured in a pass of its own."""
    values, q, residual, passes = principal_components(v, components)
    if not len(values):
        return Whitening(values, q, 0.0, values, 0.0, passes)
    k, onto = len(values), q / np.sqrt(values)

    def moments(b: np.ndarray) -> np.ndarray:
        z = b @ onto
        return np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])

    m = _over_blocks(v, moments) / v.n
    mean, second = m[:k], m[k:].reshape(k, k)
    error = float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())
    return Whitening(values, q, residual, values / v.trace, error, passes + 1)


def whitened(v: Vectors, w: Whitening, *, id_col: str = "vec_id") -> DataFrame:
    """(``id_col``, component, n, deviation, whitened, explained, identity_error): a row for each vector and component."""
    n, dtype, width, shift, rest, k = v.n, v.dtype, v.width, v.shift, v.rest, len(w.values)
    onto, explained, error = w.vectors / np.sqrt(w.values), w.explained, w.identity_error
    schema = f"`{id_col}` long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"

    def deviations(x: np.ndarray) -> list[Decimal]:
        most = n * (int(np.abs(x).max(initial=0)) + 1)
        if most * most * width < 1 << 62:
            off = n * x - np.array(rest, np.int64)
            return [Decimal(t) for t in (off * off).sum(axis=1).tolist()]
        off = n * x.astype(object) - np.array(rest, object)
        return [Decimal(int(t)) for t in (off * off).sum(axis=1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                ids = b.column(0).slice(i, 1).flatten()
                x = np.frombuffer(b.column(1)[i].as_py(), dtype).reshape(-1, width).astype(np.int64)
                z = (x - shift) @ onto
                each = pa.array(np.repeat(np.arange(len(x)), k))
                columns = [ids.take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(z.size, n)), pa.array(deviations(x), pa.decimal128(38, 0)).take(each), pa.array(z.ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(z.size, error))]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    blocks = v.blocks if k else v.blocks.limit(0)
    return blocks.select("ids", "x").mapInArrow(run, schema)


def whiten(vectors: DataFrame, *, components: int = 32, scale: int = 64, offset: int = 1_000_000, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Each usable vector on the first ``components`` eigenvectors of the covariance, scaled to unit variance.

    Components are floor(scale * c) + offset as whole numbers. Vectors that are null or hold null or non-finite entries
    are left out; shorter vectors end in zeros before the offset is added. Rows with a null id and repeated rows count as
    rows of their own. ``deviation`` is exact: the sum over dimensions of (n * x - S) squared. Vectors that span fewer
    dimensions have fewer components; equal vectors, and an empty table, give an empty result. Other columns are not
    looked at. It is an error if a component doesn't fit a 64-bit integer.
    """
    v = packed_vectors(vectors, scale=scale, offset=offset, id_col=id_col, vector_col=vector_col)
    if v is None:
        empty = f"`{id_col}` long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], empty)
    return whitened(v, fit_whitening(v, components), id_col=id_col)
