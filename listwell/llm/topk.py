"""Exact top-k by inner product over an impact-ordered index, score at a time.

Vectors are dealt into shards and queries into blocks; each pair of a shard and a block is one task. A shard's postings
are grouped into segments by quantised impact, which are processed in falling order into accumulators, each as one product
of the segment's postings with a block of queries. What a vector has not yet contributed is bounded by the norm of its
unprocessed rest times the query's norm (Cauchy-Schwarz), so a bar of k scores that are known to be reached proves which
vectors cannot be members. Processing stops once few possible members are left, and those are scored exactly in integers.

The first shard proves against its own lower bounds; its k-th exact score is then the bar of each query in all other
shards, which travels as one number with the query. Equal scores go to the smaller id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import checkpointed

SHARD_ROWS, BLOCK_QUERIES = 16_384, 1_024
LEVELS, AT_ONCE = 12, 128
#: Scores are exact in 64 bits below this product of norms.
LARGEST_SCORE = float(1 << 62)


def usable(vector: Column) -> Column:
    """Not null and without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~bad


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of integers; shorter vectors are filled up with zeros."""
    flat = column.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) and flat.num_chunks == 1 else flat
    length = flat.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(flat), width), np.int64)
    out[np.arange(width)[None, :] < length[:, None]] = flat.flatten().to_numpy()
    return out


class ImpactIndex:
    """Posting segments of one shard by falling quantised impact, and the norm of each vector's rest after each segment."""

    def __init__(self, x: np.ndarray, levels: int = LEVELS):
        self.x, self.levels = x, levels
        size = np.abs(x).astype(np.float64)
        self.width = max(1.0, float(size.max(initial=0))) / levels
        self.level = np.where(x != 0, np.minimum((size / self.width).astype(np.int8), levels - 1), -1)
        self.sign = np.sign(x).astype(np.int8)
        self.norm = np.sqrt((size**2).sum(axis=1))
        self.rest: list[np.ndarray] = []
        left = x.astype(np.float64)
        for lv in range(levels - 1, -1, -1):
            left -= self.segment(lv)
            self.rest.append(np.sqrt((left**2).sum(axis=1)))

    def segment(self, level: int) -> np.ndarray:
        """Postings of one level of impact, by vector and dimension."""
        return np.where(self.level == level, self.sign * ((level + 0.5) * self.width), 0.0)

    def possible(self, q: np.ndarray, k: int, own: np.ndarray, bar: np.ndarray) -> np.ndarray:
        """(vectors x queries) flags of all that may be among a query's k best; ``own`` marks pairs that take no part.

        ``bar``: for each query a score that k vectors are known to reach, minus infinity where none is known.
        """
        n, m = len(self.x), len(q)
        q = q.astype(np.float64)
        norm = np.sqrt((q**2).sum(axis=1))
        total = np.zeros((n, m))
        for step, rest in enumerate(self.rest):
            total += self.segment(self.levels - 1 - step) @ q.T
            last = step == self.levels - 1
            if not last and step < self.levels // 2:
                continue
            # a little more for rounding, which goes with the whole vector
            slack = (rest * (1 + 1e-9) + 1e-12 * self.norm)[:, None] * norm + 1e-6
            known = bar
            if n > k and not np.isfinite(bar).all():
                low = np.where(own, -np.inf, total - slack)
                known = np.maximum(bar, np.partition(low, n - k, axis=0)[n - k])
            may = (total + slack >= known) & ~own
            if last or may.sum() <= max(4 * k * m, 0.02 * n * m):
                return may
        return ~own


def _search(vectors: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    out = {"query_id": [], "id": [], "score": []}
    if vectors.num_rows and queries.num_rows:
        width = max(1, *(int(t.column("v").combine_chunks().value_lengths().to_numpy(zero_copy_only=False).max(initial=0)) for t in (vectors, queries)))
        x, q = _matrix(vectors.column("v"), width), _matrix(queries.column("v"), width)
        ids, qids, bars = vectors.column("id").to_numpy(), queries.column("id").to_numpy(), queries.column("bar").to_numpy()
        index = ImpactIndex(x)
        for a in range(0, len(q), AT_ONCE):
            part, names = q[a : a + AT_ONCE], qids[a : a + AT_ONCE]
            may = index.possible(part, k, ids[:, None] == names[None, :], bars[a : a + AT_ONCE])
            for j, name in enumerate(names):
                at = np.flatnonzero(may[:, j])
                score = x[at] @ part[j]
                best = np.lexsort((ids[at], -score))[:k]
                out["query_id"].append(np.full(len(best), name))
                out["id"].append(ids[at][best])
                out["score"].append(score[best])
    none = np.zeros(0, np.int64)
    return pa.table({c: np.concatenate([none, *v]) for c, v in out.items()})


def _largest(df: DataFrame, vector_col: str, scale: int) -> tuple[int, float]:
    """Number of vectors and the largest norm among them, once scaled."""
    squares = F.aggregate(F.col(vector_col), F.lit(0.0), lambda total, x: total + F.pow(F.abs(x.cast("double")) * scale + 1, F.lit(2.0)))
    n, most = df.agg(F.count(F.lit(1)), F.max(squares)).first()
    return n, (most or 0.0) ** 0.5


def exact_top_k(vectors: DataFrame, queries: DataFrame, *, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, ``id_col``, score): each query's k highest integer inner products, all if there are fewer.

    Rows of the query's own id are no candidates of it. Vectors that are null or hold null or non-finite components, and
    rows with a null id, take no part on either side. Shorter vectors count as ending in zeros. Of query rows that share
    an id one counts; repeated candidate rows are repeated results. An empty side gives an empty result. It is an error if
    vectors are so long that a score might not fit a 64-bit integer.
    """
    good = lambda df: df.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull())
    clean = lambda df: good(df).select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v"))
    (n, longest), (m, longest_query) = _largest(good(vectors), vector_col, scale), _largest(good(queries), vector_col, scale)
    if longest * longest_query >= LARGEST_SCORE:
        raise ValueError(f"scores of up to {longest * longest_query:.3g} don't fit 64 bits: use a smaller scale")
    x, q = clean(vectors), clean(queries).groupBy("id").agg(F.min("v").alias("v"))
    shards, blocks = max(1, math.ceil(n / SHARD_ROWS)), max(1, math.ceil(m / BLOCK_QUERIES))
    dealt = lambda df, own, parts: df.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"))
    left = dealt(x, "shard", shards).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = dealt(q, "block", blocks)

    def search(vectors: DataFrame, queries: DataFrame) -> DataFrame:
        return vectors.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block")).applyInArrow(lambda a, b: _search(a, b, k), "query_id long, id long, score long")

    unknown = F.lit(float("-inf")).alias("bar")
    found = search(left.where("shard = 0"), right.select("id", "v", F.lit(0).alias("shard"), "block", unknown))
    if shards > 1:
        found = checkpointed(found)
        bars = found.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score").cast("double")).alias("bar"))
        told = right.join(bars, F.col("id") == F.col("query_id"), "left").select("id", "v", "block", F.coalesce("bar", F.lit(float("-inf"))).alias("bar"))
        everywhere = told.withColumn("shard", F.explode(F.sequence(F.lit(1), F.lit(shards - 1)))).select("id", "v", "shard", "block", "bar")
        found = found.unionByName(search(left.where("shard > 0"), everywhere))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
