import math
import re
from collections import Counter

import pytest

from listwell.llm import bag_search as B
from listwell.llm.bag_search import Items, bag_classes, corpus_counts, document_bags, ranked_search

SF = "/root/testdata/sf0.01"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    bags = [(i, Counter(t), len(t)) for i, text in docs if (t := terms(text))]
    n, total = len(bags), sum(b[2] for b in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    wanted = {}
    for i, text in items:
        wanted.setdefault(i, set()).update(terms(text))
    out = []
    for item, ts in wanted.items():
        scored = []
        for i, c, length in bags:
            m = 10 + (90 * length * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in ts if c[t])
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=lambda r: (r[0] is None, r))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r))


DOCS = [(3, "The cat. the CAT"), (2, "cat the the cat"), (2, "cat the the cat"), (9, None), (8, ""), (7, "... !!"), (None, "the cat the cat"), (None, "dog"), (6, "Ünder ünder the cat x" + " y" * 50_000), (5, "dog cat 42 bird"), (1, "dog dog İstanbul a_b"), (4, "the " * 40)]
ITEMS = [(1, "cat"), (1, "dog cat"), (2, None), (3, "zebra"), (None, "the a B"), (4, "the cat Ünder"), (5, "bird bird 42 a"), (6, "ünder")]


@pytest.mark.parametrize("block,at_once", [(100_000, 4 << 20), (2, 8)])
def test_small_tables(spark, monkeypatch, block, at_once):
    monkeypatch.setattr(B, "BLOCK_TERMS", block)
    monkeypatch.setattr(B, "SCORES_AT_ONCE", at_once)
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "1 as id", "2 as m", "3 as item", "4 as n")
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 as id", "2 as term")
    assert rows(ranked_search(docs, items)) == brute(DOCS, ITEMS)
    assert rows(ranked_search(docs, items, k=2)) == brute(DOCS, ITEMS, 2)
    assert ranked_search(docs.limit(0), items).count() == 0 and ranked_search(docs, items.limit(0)).count() == 0
    assert ranked_search(docs, items.where("item_id in (2, 3)")).count() == 0


def test_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()][:300]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = ranked_search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert rows(got) == brute(docs, items)


def test_a_class_is_scored_once_and_never_held_whole(spark):
    docs = [(i, "copy of one text" if i % 3 else f"text {i} of one") for i in range(3000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    block = Items.of([(1, ["copy", "text"])])
    bags = document_bags(df, block, id_col="doc_id", text_col="text")
    n, total, frequency = corpus_counts(bags, 2)
    assert (n, total, sorted(frequency)) == (3000, 12_000, [2000, 3000])
    classes = bag_classes(bags, n, total, 5)
    got = sorted([m.id for m in r.members] for r in classes.collect())
    assert got == [[0, 3, 6, 9, 12], [1, 2, 4, 5, 7]]
    plan = bag_classes(bags, n, total, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange hashpartitioning") == 1
    items = spark.createDataFrame([(1, "copy text")], "item_id long, text string")
    assert rows(ranked_search(df, items)) == brute(docs, [(1, "copy text")])


def test_hash_matches_are_verified(spark, monkeypatch):
    """With a hash that says nothing but the length, other words of the same length are no terms."""
    monkeypatch.setattr(B, "keyed_hashes", lambda data, starts, ends, key: (ends - starts).astype("uint64"))
    block = Items.of([(1, ["cat", "horse"])])
    import numpy as np

    data = np.frombuffer(b"cat dog horse", np.uint8)
    at = block.terms_of(data, np.array([0, 4, 8]), np.array([3, 7, 13]))
    assert [bytes(block.data[block.bounds[i] : block.bounds[i + 1]]) if i >= 0 else None for i in at] == [b"cat", None, b"horse"]
