import math
import random

import numpy as np
import pytest

from listwell.llm import whitening as W
from listwell.llm.queries import QUERIES
from listwell.llm.whitening import fit_whitening, packed_vectors, principal_components, whiten

SF = "/root/testdata/sf0.01"


def whole(rows):
    return np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in rows], np.int64)


def check(rows, x, components):
    """Rows of whiten() against a dense eigendecomposition and exact Python integers."""
    n, d = x.shape
    s = x.sum(axis=0)
    center = x - (s // n)
    y = center - (s - n * (s // n)) / n
    cov = y.T @ y / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, d, int((values > 1e-12 * values[0]).sum()))
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert len(rows) == n * k and all(sorted(c) == list(range(1, k + 1)) for c in by.values())
    z = np.array([[by[i][c].whitened for c in range(1, k + 1)] for i in range(n)])
    for i in range(n):
        want = sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[i], s, strict=True))
        assert {int(r.deviation) for r in by[i].values()} == {want} and by[i][1].n == n
    explained = np.array([by[0][c].explained for c in range(1, k + 1)])
    assert np.allclose(explained, values[:k] / np.trace(cov), rtol=1e-9, atol=0)
    measured = np.abs((z - z.mean(axis=0)).T @ (z - z.mean(axis=0)) / n - np.eye(k)).max()
    assert measured < 1e-8 and abs(by[0][1].identity_error - measured) < 1e-9
    # the direction of each component, found again from the values, is an eigenvector
    e = explained * np.trace(cov)
    q = np.linalg.lstsq(y, z * np.sqrt(e), rcond=None)[0] if n > d else None
    if q is not None:
        assert np.abs(cov @ q - q * e).max() < 1e-9 * e[0] and np.abs((q**2).sum(axis=0) - 1).max() < 1e-9


def test_embeddings(spark):
    source = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = QUERIES["op13_embedding_whitening"](spark, SF).collect()
    kept = [r for r in source.orderBy("vec_id").collect() if r.embedding is not None]
    assert [r.vec_id for r in kept] == list(range(len(kept)))
    check(rows, whole([r.embedding for r in kept]), 32)
    assert dict(QUERIES["op13_embedding_whitening"](spark, SF).dtypes)["deviation"] == "bigint"


@pytest.mark.parametrize("kind", ["steep", "flat", "few", "tied", "large"])
def test_shapes_of_spectra(spark, kind):
    rng = np.random.default_rng(5)
    n, d = {"few": (6, 20)}.get(kind, (400, 40))
    x = rng.standard_normal((n, d))
    if kind == "steep":
        x *= np.logspace(2, -1, d)
    if kind == "tied":
        x = np.repeat(x[:, : d // 4], 4, axis=1) * 3
    if kind == "large":
        x = x * 1e12 + 3e13
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    check(whiten(df, components=8).collect(), whole(x), 8)


def test_edges(spark, monkeypatch):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25]), (1, [0.5, 0.25]), (None, [0.0]), (2, []), (3, [1.5, -2.0]), (4, None), (5, [nan, 1.0]), (6, [1.0, None]), (7, [-inf, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "2 as x", "3 as n", "4 as component")
    got = whiten(df).collect()
    # shorter vectors end in zeros
    x = whole([[0.5, 0.25], [0.5, 0.25], [0, 0], [0, 0], [1.5, -2.0]])
    assert len(got) == 10 and {r.n for r in got} == {5} and sum(r.vec_id is None for r in got) == 2
    want = [sum((5 * int(a) - int(b)) ** 2 for a, b in zip(v, x.sum(axis=0), strict=True)) for v in x]
    assert sorted(int(r.deviation) for r in got) == sorted(want * 2)
    assert whiten(df.limit(0)).count() == 0 and whiten(df.where("vec_id in (4, 5)")).count() == 0
    assert whiten(df.where("vec_id = 1")).count() == 0  # equal vectors vary in no direction
    with pytest.raises(Exception, match="64-bit|OVERFLOW|overflow"):
        whiten(spark.createDataFrame([(1, [1e300]), (2, [0.0])], "vec_id long, embedding array<double>")).collect()


def test_exact_deviations_beyond_64_bits(spark):
    x = [[1e13, 0.0], [-1e13, 1.0], [5e12, 2.0]]
    got = whiten(spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>"), components=1).collect()
    y = whole(x)
    assert {r.vec_id: int(r.deviation) for r in got} == {i: sum((3 * int(a) - int(b)) ** 2 for a, b in zip(y[i], y.sum(axis=0), strict=True)) for i in range(3)}


def test_no_pass_sees_the_whole_space(spark, monkeypatch):
    """Passes take narrow blocks; sums in two steps are the same; the rounds end with a certificate."""
    widths = []
    times = W._Covariance.__matmul__
    monkeypatch.setattr(W._Covariance, "__matmul__", lambda self, q: widths.append(q.shape) or times(self, q))
    monkeypatch.setattr(W, "DRIVER_PARTS", 1)
    monkeypatch.setattr(W, "BLOCK_ROWS", 50)
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(80)]) for i in range(1000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(9)
    v = packed_vectors(df, scale=64, offset=0, id_col="vec_id", vector_col="embedding")
    values, q, residual, passes = principal_components(v, 8)
    assert max(k for _, k in widths) == 8 + W.SPARE and passes == len(widths) and residual < 1e-12
    x = whole([r for _, r in rows]).astype(float)
    assert np.allclose(values, np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1][:8], rtol=1e-11)
    assert fit_whitening(v, 8).identity_error < 1e-9
