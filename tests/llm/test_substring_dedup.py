import hashlib
import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from listwell.llm.fm_index import FMIndex
from listwell.llm.substring_dedup import substring_dedup

SF = "/root/testdata/sf0.01"


def brute(rows, n=13):
    first = {}
    words = {i: (t or "").encode().split() for i, t in rows}
    for i in sorted(words):
        for p in range(len(words[i]) - n + 1):
            first.setdefault(tuple(words[i][p : p + n]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for p in range(len(w) - n + 1):
            if first[tuple(w[p : p + n])] < i:
                gone.update(range(p, p + n))
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def result(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()}


def test_matches_brute_force_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    want = brute(rows)
    assert sum(v[1] for v in want.values()) > 1000
    assert result(substring_dedup(docs)) == want


@pytest.mark.parametrize("n,anchor", [(2, 1), (5, 2), (13, 5)])
def test_small_alphabet_and_edges(spark, n, anchor):
    rng = random.Random(n)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(0, 60)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \t\n"), (103, "ü x " * 400), (104, "ü x " * 400), (105, "x" * 200_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "'a' as chunk", "2 as shard")
    assert result(substring_dedup(df, min_words=n, anchor_words=anchor)) == brute(rows, n)


def test_spans_null_ids_and_empty(spark):
    long = " ".join(f"w{i}" for i in range(20))
    rows = [(1, long), (2, "x y " + long + " z"), (None, long), (2, "q")]
    got = substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    cut = next(r for r in got if r.n_removed)
    assert cut.kept_text == "x y z" and [tuple(s) for s in cut.removed] == [(2, 22)]
    assert len(got) == 4 and next(r for r in got if r.doc_id is None).n_removed == 0
    assert substring_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_matching_statistics_match_brute_force():
    rng = random.Random(4)
    passages = [[rng.randrange(1, 4) for _ in range(rng.randrange(1, 30))] for _ in range(12)]
    ids = np.array([x for p in passages for x in [*p, 0]])
    owner = np.repeat(np.arange(len(passages)), [len(p) + 1 for p in passages])
    ends = np.flatnonzero(ids)
    text, most = ids.tolist(), 9
    found = {}
    for e in range(len(text)):
        for k in range(1, most + 1):
            run = tuple(text[max(0, e - k + 1) : e + 1])
            if len(run) == k and 0 not in run:
                found.setdefault(run, set()).add(e)
    want = [max((k for k in range(1, most + 1) if len(found.get(tuple(text[max(0, e - k + 1) : e + 1]), ())) > 1 and k <= e + 1), default=0) for e in ends.tolist()]
    index = FMIndex(ids, 4, most, owner)
    length, low, high = index.matching_statistics(ids, ends, most)
    assert length.tolist() == want
    for e, k, a, b in zip(ends.tolist(), want, low.tolist(), high.tolist()):
        assert sorted(index.owner[a:b].tolist()) == sorted(owner[x] for x in (found[tuple(text[e - k + 1 : e + 1])] if k else ()))


def test_hot_anchors_and_words_alike_in_structure(spark, monkeypatch):
    """Windows of anchors that many documents hold go alone; Thue-Morse words are different words."""
    monkeypatch.setattr("listwell.llm.substring_dedup.HOT_DOCS", 3)
    rng = random.Random(9)
    hot = "a b c d"
    a, b = ("".join(p[i.bit_count() % 2] for i in range(2048)) for p in ("xy", "yx"))
    rows = [(i, " ".join(rng.choice([hot, "e f", "g", "h i j"]) for _ in range(rng.randrange(1, 30)))) for i in range(60)]
    rows += [(100, " ".join([a] * 14)), (101, " ".join([b] * 14)), (102, " ".join([b] * 14))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(substring_dedup(df, min_words=6, anchor_words=3, chunks=5, shards=3)) == brute(rows, 6)
