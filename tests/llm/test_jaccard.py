import random
from fractions import Fraction

import pyarrow as pa
import pytest

import corpus_pipeline
from listwell.llm.jaccard import jaccard_components, one_of_each_similar
from listwell.llm.words import whole_runs

SF = "/root/testdata/sf0.01"


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, t=Fraction(4, 5)):
    """Least id of each id's group, over all pairs."""
    sets = {i: shingles(x) for i, x in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if min(len(x), len(y)) >= t * max(len(x), len(y)) and (x == y or len(x & y) >= t * len(x | y)):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def near(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_stage_keeps_one_of_each_exact_group(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()}
    assert got == set(want.values()) and len(got) < len(want)


def test_pairs_on_both_sides_of_the_threshold(spark):
    rng = random.Random(5)
    rows = []
    for g in range(60):
        base = [f"w{g}x{rng.randrange(400)}" for _ in range(rng.choice([8, 30, 200, 900, 4000]))]
        rows.append((len(rows), " ".join(base)))
        rows += [(len(rows) + k, edited(rng, base, max(1, len(base) * rng.randrange(1, 8) // 200))) for k in range(3)]
    rng.shuffle(rows)
    want = brute(rows)
    got = {r.id: r.least_id for r in jaccard_components(near(spark, rows)).collect()}
    assert got == want and 60 < len(set(want.values())) < len(rows)


def test_large_group_and_common_line(spark):
    rng = random.Random(6)
    base = [f"b{i}" for i in range(120)]
    line = " ".join(f"common{i}" for i in range(40))
    rows = [(i, edited(rng, base, rng.randrange(4))) for i in range(150)]
    rows += [(1000 + i, line + " " + " ".join(f"u{i}_{k}" for k in range(20))) for i in range(150)]
    got = {r.id: r.least_id for r in jaccard_components(near(spark, rows)).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, empty):
    rows = [(1, None), (2, ""), (3, "a b c d e f"), (4, "A B  C\nD e F"), (4, "other words that stand all alone here"), (None, "a b c d e f"), (9, "zz"), (10, "ZZ")]
    docs = near(spark, [] if empty else rows)
    kept = sorted((str(r.doc_id), r.text) for r in one_of_each_similar(docs).collect())
    assert kept == ([] if empty else [("1", None), ("3", "a b c d e f"), ("4", "other words that stand all alone here"), ("9", "zz"), ("None", "a b c d e f")])


def test_components_too_large_for_a_task(spark, monkeypatch):
    """Chunks of few shingles: groups that only members of other chunks join are found all the same."""
    monkeypatch.setattr("listwell.llm.jaccard.CHUNK_SHINGLES", 700)
    rng = random.Random(8)
    base = [f"b{i}" for i in range(120)]
    rows, now = [], list(base)
    for i in range(40):  # a chain: each is near the one before, the ends are far apart
        now = list(now)
        now[(i * 7) % 120] = f"c{i}"
        rows.append((i, " ".join(now)))
    rows += [(100 + i, edited(rng, base, rng.randrange(4))) for i in range(60)]
    rng.shuffle(rows)
    got = {r.id: r.least_id for r in jaccard_components(near(spark, rows)).collect()}
    assert got == brute(rows)


def test_runs_stay_whole_across_batches():
    rng = random.Random(1)
    keys = sorted(rng.choices([-5, -1, 0, 3, 3, 9], k=200))
    for width in (1, 3, 50, 300):
        batches = [pa.RecordBatch.from_pydict({"k": keys[i : i + width], "i": list(range(i, min(200, i + width)))}) for i in range(0, 200, width)]
        runs = [(k.to_pylist(), i.to_pylist()) for k, i in whole_runs(iter([*batches, batches[0].slice(0, 0)]))]
        assert sum((k for k, _ in runs), []) == keys and sum((i for _, i in runs), []) == list(range(200))
        assert sum(len(set(k)) for k, _ in runs) == len(set(keys))
