import itertools
import math
import re
from collections import Counter

import numpy as np
import pytest

from listwell.llm.quality import char_buckets, fit_quality_model, quality_report, word_buckets
from listwell.llm.words import split_words

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w))


def stats(rows):
    return [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows]


@pytest.fixture(scope="module")
def report(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = fit_quality_model(docs, labels)
    return {r.doc_id: r for r in quality_report(docs, model).collect()}, {r.doc_id: r.text for r in docs.collect()}, {r.doc_id: r.quality for r in labels.collect()}


def test_counts_match_brute_force(report):
    rows, texts, _ = report
    assert len(rows) == len(texts)
    for i, text in texts.items():
        assert stats([rows[i]]) == [brute(text)], i


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    train, test = labels.where("doc_id % 3 > 0"), labels.where("doc_id % 3 = 0")
    out = quality_report(docs.join(test, "doc_id"), fit_quality_model(docs, train, per_class=300)).join(test, "doc_id").collect()
    judged = [r for r in out if not r.base_failed]
    assert sum((r.probability >= 0.3) == (r.quality == 1) for r in judged) >= 0.99 * len(judged)
    good, junk = ([r for r in out if r.quality == k] for k in (1, 0))
    assert sum(r.kept or r.base_failed for r in good) >= 0.99 * len(good) and sum(r.kept for r in junk) <= 0.02 * len(junk)


def test_edges(spark):
    texts = [None, "", " \n\t\n ", "a\nb\na\n\na\n b\nb", "x y z x y z x y z q", "é|ü <#>  ", "a" * 300_000, "\n\n", "w\x0bv\x0cu"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a b c"), (3, texts[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as n_words", "3 as kept")
    got = quality_report(df, None).collect()
    assert sorted(stats(got)) == sorted(brute(t) for _, t in rows)
    assert all(r.probability is None for r in got)
    assert quality_report(df.limit(0), None).count() == 0
    one = spark.createDataFrame([(0, 1), (1, None), (None, 0)], "doc_id long, quality int")
    assert fit_quality_model(df, one) is None


def test_lines_that_differ_in_structure_only(spark):
    a = "".join("ab"[i.bit_count() % 2] for i in range(4096))
    b = "".join("ba"[i.bit_count() % 2] for i in range(4096))
    text = f"{a}\n{b}\n{a}\n" + "w " * 60
    got = quality_report(spark.createDataFrame([(1, text)], "doc_id long, text string"), None).collect()
    assert stats(got) == [brute(text)] and got[0].n_dup_lines == 1


def test_scores_match_a_plain_scorer(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    model = fit_quality_model(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()} | {-1: "", -2: "é", -3: "ab", -4: "привет мир " * 30}
    bucket, bits = {}, lambda t: (np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))

    def one(kind, gram):
        """Bucket of one n-gram on its own."""
        if (kind, gram) not in bucket:
            raw = bits(gram)
            bucket[kind, gram] = int(char_buckets(*raw)[0][0]) if kind == "char" else int(word_buckets(split_words(*raw))[0 if kind == "word" else 1][0])
        return bucket[kind, gram]

    def plain(text):
        w = WORD.findall(text)
        parts = [("word", w, model.word), ("pair", [f"{a} {b}" for a, b in itertools.pairwise(w)], model.word), ("char", [text[i : i + 4] for i in range(len(text) - 3)], model.char)]
        score = sum(10 * sum(float(table[one(kind, g)]) * k for g, k in Counter(grams).items()) / len(grams) for kind, grams, table in parts if grams)
        return 1 / (1 + math.exp(-max(-50, min(50, model.slope * (score + model.bias) + model.shift))))

    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = quality_report(df, model).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.probability == pytest.approx(plain(texts[r.doc_id]), abs=1e-5)
        assert r.kept == (not r.base_failed and r.probability >= 0.3)
