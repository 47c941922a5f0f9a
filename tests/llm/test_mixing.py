import random

import duckdb

from listwell.llm.mixing import mix_sources, mixing_sql, source_rates, with_copies
from listwell.llm.queries import op5_source_mixing

SF = "/root/testdata/sf0.01"


def brute_targets(sizes, weights=(1, 2, 3), cap=3):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target, fixed = sum(sizes.values()), {}, set()
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(cap * sizes[s] for s in fixed)
        level = left / sum(w[s] for s in free) if free else 0
        target = {s: cap * sizes[s] if s in fixed else level * w[s] for s in names}
        over = {s for s in free if target[s] > cap * sizes[s] * (1 + 1e-12)}
        if not over:
            return target
        fixed |= over


def test_targets(spark):
    rng = random.Random(3)
    for case in range(4):
        sizes = {f"s{i:02d}": int(rng.paretovariate(0.6)) for i in range(11 + case)} | {None: 40, "empty": 0}
        got = {r.source: r.target for r in source_rates(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()}
        want = brute_targets(sizes)
        assert all(abs(got[s] - want[s]) <= 1e-6 * max(1, want[s]) for s in sizes) and len(got) == len(sizes)


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = sorted(con.execute(mixing_sql()).fetchall())
    got = sorted(tuple(r) for r in op5_source_mixing(spark, SF).select("doc_id", "size", "source_size", "target", "taken").collect())
    assert got == want


def test_taken_is_near_target_at_scale(spark):
    df = spark.range(60_000).selectExpr("id as doc_id", "concat('s', id % 7) as source", "repeat('w ', int(id % 20) + 1) as text")
    rows = with_copies(df).selectExpr("doc.source as source", "mix.size * mix.copies as t", "mix.target as g", "mix.copies as c").groupBy("source").agg({"t": "sum", "g": "max", "c": "max"}).collect()
    for r in rows:
        assert abs(r["sum(t)"] - r["max(g)"]) < 0.03 * r["max(g)"] and r["max(c)"] <= 3


def test_mix_repeats_rows_and_edges(spark):
    rows = [(1, "a b", "x"), (2, None, None), (3, "", "y"), (None, "q", "x"), (1, "a b", "x"), (7, "w " * 300_000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as size", "2 as target", "3 as rate", "4 as mix", "5 as r", "6 as doc", "7 as u")
    out = mix_sources(df)
    assert out.columns == df.columns
    counts = {r[0]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    want = {}
    for r in with_copies(df).selectExpr("doc.doc_id as doc_id", "mix.copies as copies").collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.copies
    assert counts == {k: v for k, v in want.items() if v}
    assert mix_sources(df.limit(0)).count() == 0


def test_small_sources_end_near_their_targets(spark):
    """Sources of 50 documents or more within a twentieth, on tables of few and uneven documents."""
    out = op5_source_mixing(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source"), "doc_id")
    rows = out.groupBy("source").agg({"taken": "sum", "target": "max", "doc_id": "count"}).collect()
    far = [(r["source"], r["sum(taken)"] / r["max(target)"]) for r in rows if r["count(doc_id)"] >= 50 and abs(r["sum(taken)"] - r["max(target)"]) > 0.05 * r["max(target)"]]
    assert rows and not far


def test_a_copy_is_as_likely_as_the_fraction(spark):
    """Over many seeds each document is taken in proportion to its rate, alone or drawn together."""
    rows = [(i, "w " * (1 + 7 * i % 40), "a" if i % 3 else "b") for i in range(40)] + [(99, "w " * 9000, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    seen, seeds = {}, 12
    for seed in range(seeds):
        for r in with_copies(df, seed=seed, weights=(3, 1, 1)).selectExpr("doc.doc_id as i", "mix.copies as c", "mix.rate as rate").collect():
            seen.setdefault(r.i, []).append(r.c - r.rate)
            assert abs(r.c - r.rate) < 1 + 1e-9
    means = [sum(v) / seeds for v in seen.values()]
    assert max(map(abs, means)) < 0.6 and abs(sum(means) / len(means)) < 0.1
