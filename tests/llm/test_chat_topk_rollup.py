import random

import pytest
from pyspark.sql import functions as F

from listwell.llm.chat import rotate_perspectives
from listwell.llm.token_rollup import TokenRollup, image, nothing
from listwell.llm.topk import exact_top_k


def test_rotation_of_three_parties(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob b", "yo <|im_end|>"), (1, 3, "ann", None), (1, None, None, "early"), (None, 1, "x", "ö"), (2, 0, "system", "alone"), (None, 0, "x", "é")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as conv", "2 as speaker", "3 as n")
    rows = rotate_perspectives(df).collect()
    # turns without a conversation stand alone
    assert sorted(r.text for r in rows if r.conv_id is None) == [f"<|im_start|>assistant\n{c}<|im_end|>\n" for c in "éö"]
    got = {(r.conv_id, r.speaker): r for r in rows if "ö" not in r.text}
    assert set(got) == {(1, "ann"), (1, "bob_b"), (1, "unknown"), (None, "x")}
    ann = got[(1, "ann")]
    assert ann.text == "<|im_start|>user name=unknown\nearly<|im_end|>\n<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n<|im_start|>user name=bob_b\nyo < |im_end|><|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    assert [ann.text[s.start : s.end] for s in ann.spans] == ["hi<|im_end|>", "<|im_end|>"] and ann.n_trained == 22 and ann.n_turns == 5
    assert [got[(None, "x")].text[s.start : s.end] for s in got[(None, "x")].spans] == ["é<|im_end|>"]
    plan = rotate_perspectives(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert rotate_perspectives(df)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert rotate_perspectives(df.limit(0)).count() == 0


def test_every_role_is_a_participant(spark):
    """Roles that look alike stay apart; ties and repeated rows are turns of their own; long texts stay whole."""
    roles = ["bob b", "bob_b", None, "unknown", "  ", "bob_b#1", "ann", "ann", "system"]
    rows = [(1, 0, r, "same") for r in roles] + [(2, 1, "a", "é" * 300_000), (2, 0, "b", "")]
    got = rotate_perspectives(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    views = {r.speaker: r for r in got if r.conv_id == 1}
    assert set(views) == {"bob_b#1", "bob_b#2", "unknown#1", "unknown#2", "unknown#3", "bob_b#1#1", "ann"}
    assert all(r.n_turns == 9 and r.n_trained == 14 * (2 if r.speaker == "ann" else 1) for r in views.values())
    assert all(r.text.count("<|im_start|>assistant") == (2 if r.speaker == "ann" else 1) for r in views.values())
    assert [s.end - s.start for r in got if r.conv_id == 2 and r.speaker == "a" for s in r.spans] == [300_010]


def brute(rows, queries, k):
    out = []
    for q, qv in queries:
        scored = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in rows if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("shard,block,same", [(50, 7, 0), (16_384, 1_024, 0), (40, 3, 60)])
def test_top_k_matches_brute_force(spark, monkeypatch, shard, block, same):
    import math

    from listwell.llm import topk

    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", block)
    rng = random.Random(same)
    one = [rng.gauss(0, 0.2) for _ in range(8)]
    rows = [(i, one if i < same else [rng.gauss(0, 0.2) * (j % 3) for j in range(8)]) for i in range(240)]
    bad = [(1000, None), (1100, [None] * 8), (1200, [float("nan")] * 8), (1300, [float("inf")] * 8), (None, one)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "2 as v", "3 as rank")
    ints = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    got = sorted(tuple(r) for r in exact_top_k(df, df.where("vec_id % 20 = 0"), k=10).collect())
    assert got == brute(ints, [r for r in ints if r[0] % 20 == 0], 10)


def test_top_k_edges(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0]), (2, []), (100, [0.0, -1.0])], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in exact_top_k(df, df.where("vec_id % 100 = 0"), scale=1).collect())
    assert got == [(0, 1, 1, 3), (0, 2, 2, 0), (0, 3, 100, -2), (100, 1, 1, 0), (100, 2, 2, 0), (100, 3, 0, -2)]
    assert exact_top_k(df, df.limit(0)).count() == 0 == exact_top_k(df.limit(0), df).count()


def test_top_k_refuses_scores_beyond_64_bits_and_keeps_repeated_rows(spark):
    df = spark.createDataFrame([(0, [1e13, 0.0]), (1, [1e13, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        exact_top_k(df, df)
    rows = [(0, [1.0]), (1, [2.0]), (1, [2.0]), (2, [2.0]), (0, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in exact_top_k(df, df.where("vec_id = 0"), scale=1, k=3).collect())
    assert got == [(0, 1, 1, 2), (0, 2, 1, 2), (0, 3, 2, 2)]


def totals(rollup):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()}


def test_rollup_batches_and_replays(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a", "en", 10), (2, "a", "en", 5), (3, None, "de", None)], "doc_id long, source string, lang string, tokens long").selectExpr("*", "1 as sign", "2 as i")
    v1 = image(tokenizer="v1", tokens=F.col("tokens"))
    rollup = TokenRollup(spark, str(tmp_path / "r"))
    assert totals(rollup) == {}
    load = docs.select(nothing().alias("before"), v1.alias("after"))
    assert rollup.commit("load", load) and not rollup.commit("load", load)
    assert totals(rollup) == {("a", "en", "v1"): (2, 15), (None, "de", "v1"): (1, 0)}
    moved = docs.where("doc_id = 2").select(v1.alias("before"), F.struct(F.lit("b").alias("source"), F.lit("en").alias("lang"), F.lit("v1").alias("tokenizer"), F.lit(7).cast("long").alias("tokens")).alias("after"))
    rollup.stage("move", moved)  # broke off before its commit
    assert totals(rollup)[("a", "en", "v1")] == (2, 15)
    again = TokenRollup(spark, str(tmp_path / "r"))
    assert again.commit("move", moved) and again.commit("gone", docs.where("doc_id = 3").select(v1.alias("before"), nothing().alias("after")))
    assert again.commit("none", load.limit(0))
    assert totals(again) == {("a", "en", "v1"): (1, 10), ("b", "en", "v1"): (1, 7), (None, "de", "v1"): (0, 0)}


def test_folded_totals_are_those_of_all_batches(spark, tmp_path):
    row = image(tokenizer="v", tokens=F.col("n"))
    batch = lambda n: spark.createDataFrame([("a", None, n), (None, "en", 1)], "source string, lang string, n long").select(nothing().alias("before"), row.alias("after"))
    rollup = TokenRollup(spark, str(tmp_path / "r"), fold_every=2)
    for i in range(5):
        assert rollup.commit(f"b{i}", batch(i)) and not rollup.commit(f"b{i}", batch(i))
        assert totals(rollup) == {("a", None, "v"): (i + 1, sum(range(i + 1))), (None, "en", "v"): (i + 1, i + 1)}
    assert rollup._open().count() == 1 and totals(TokenRollup(spark, str(tmp_path / "r"))) == totals(rollup)
    with pytest.raises(ValueError):
        rollup.commit("", batch(1))


def test_query_counts_tokens_as_the_tokenizers_do(spark):
    import base64

    import public_tokenizers as P
    import tiktoken
    from tokenizers import Tokenizer

    from listwell.llm.queries import op7_token_rollup

    sf = "/root/testdata/sf0.001"
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    word, byte = Tokenizer.from_file(P.path("word_bpe_49k.json")), tiktoken.Encoding("x", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        n = len(word.encode(r.text or "", add_special_tokens=False).ids)
        for version, docs, tokens in (("word_bpe_49k", int(n >= 50), n + (n >= 1000) if n >= 50 else 0), ("byte_bpe_50k", 1, len(byte.encode_ordinary(r.text or "")))):
            a, b = want.get((r.source, r.lang, version), (0, 0))
            want[r.source, r.lang, version] = (a + docs, b + tokens)
    assert {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in op7_token_rollup(spark, sf).collect()} == want
