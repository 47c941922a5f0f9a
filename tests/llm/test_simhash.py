import random

import numpy as np
import pytest
import xxhash

from listwell.llm import simhash
from listwell.llm.components import connected_components
from listwell.llm.simhash import allocate, fingerprint, near_fingerprint_links, simhash_components

SF = "/root/testdata/sf0.01"


def brute_fp(text, k):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    sh = [b" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, d):
    parent = {i: i for i in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(fps)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= d:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def components(spark, fps):
    rows = [(int(np.array([f], np.uint64).view(np.int64)[0]), i) for i, f in fps.items()]
    found = connected_components(near_fingerprint_links(spark.createDataFrame(rows, "fp long, rep long"), 4))
    got = {r.node: r.component for r in found.collect()}
    return {i: got.get(i, i) for i in fps}


@pytest.mark.parametrize("k", [4, 5])
def test_documents_match_brute_force(spark, k):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    fps = {r.doc_id: brute_fp(r.text, k) for r in docs.collect()}
    want = brute_components(fps, 4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_components(docs, shingle_words=k).collect()}
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in fps}
    assert len(set(want.values())) < len(want)


def test_long_text_uses_the_same_bits():
    rng = random.Random(1)
    text = " ".join(str(rng.randrange(500)) for _ in range(3000))
    assert fingerprint(text.encode(), 4) == brute_fp(text, 4)


@pytest.mark.parametrize("parts", [2, 3, 4, 5])
def test_no_link_is_lost_for_any_number_of_parts(spark, monkeypatch, parts):
    rng = random.Random(parts)
    base = [rng.getrandbits(64) for _ in range(12)]
    fps = {i: base[i % 12] ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for i in range(300)}
    fps = {i: f for f, i in {f: i for i, f in fps.items()}.items()}

    def fixed(n, together, distance):
        groups = simhash.group_bits(n, together, parts)
        budgets = [(distance + 1) // parts + (i < (distance + 1) % parts) for i in range(parts)]
        return [(g, b - 1) for g, b in zip(groups, budgets) if b]

    monkeypatch.setattr(simhash, "allocate", fixed)
    assert components(spark, fps) == brute_components(fps, 4)


def test_thresholds_cover_the_distance():
    for n, distance in [(n, d) for n in (0, 1, 10, 10**5, 10**7) for d in (0, 4, 12)]:
        plan = allocate(n, np.full((64, 64), n / 4) + np.eye(64) * n / 4, distance)
        assert sum(t + 1 for _, t in plan) == distance + 1 and len(simhash._masks(plan)) < 10**5
        assert len({b for g, _ in plan for b in g}) == sum(len(g) for g, _ in plan)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "a b c d e f"), (4, "A B  C\nD e F"), (4, "A B  C\nD e F"), (None, "a b c d e f"), (9, "zz")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as fp", "2 as id", "3 as component_id")
    got = sorted((str(r.doc_id), r.component_id) for r in simhash_components(df).collect())
    assert got == [("1", 1), ("2", 1), ("3", 3), ("4", 3), ("4", 3), ("9", 9), ("None", 3)]
    assert simhash_components(df.limit(0)).count() == 0


def test_large_bucket_and_chain(spark):
    # a chain whose ends are far apart still is one component
    chain = {i: (1 << (4 * i)) - 1 for i in range(16)}
    ball = {100 + i: (1 << 63) | (1 << (i % 50)) | (1 << ((i * 7) % 50)) for i in range(200)}
    fps = {i: f for f, i in {f: i for i, f in reversed({**chain, **ball}.items())}.items()}
    assert components(spark, fps) == brute_components(fps, 4)


def test_hubs_are_split(spark, monkeypatch):
    monkeypatch.setattr("listwell.llm.components.HUB", 7)
    rng = random.Random(2)
    edges = [(0, i) for i in range(1, 60)] + [(500 + i, 500) for i in range(40)] + [(rng.randrange(900, 960), rng.randrange(900, 960)) for _ in range(40)] + [(59, 700), (700, 539)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    parent = {x: x for e in edges for x in e}
    for _ in range(len(parent)):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == {x: p for x, p in parent.items() if x != p}
