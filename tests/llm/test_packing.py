import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from listwell.llm.packing import WordEncoder, best_fit, fitted_patterns, pack_documents, plan_packing, slot_table, token_pieces

SF = "/root/testdata/sf0.01"
PATH = P.path("word_bpe_49k.json")


def check(rows, texts, size):
    t = Tokenizer.from_file(PATH)
    want = []
    for i, text in texts:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        want += [(i, k, s, len(ids[s : s + size]), zlib.crc32(np.array(ids[s : s + size], "<u4").tobytes())) for k, s in enumerate(range(0, len(ids), size))]
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        end = 0
        for a, n in sorted(spans):
            assert a == end
            end = a + n
        assert end <= size
    return len(by)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = pack_documents(docs, tokenizer=PATH).collect()
    n = check(rows, [(r.doc_id, r.text) for r in docs.collect()], 2048)
    assert n <= 1.01 * np.ceil(sum(r.length for r in rows) / 2048) + 1


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "It's <|endoftext|> don't 42 ¼ É é"), (3, "a"), (None, "x y"), (5, "wörd x y " * 900), (6, "́ a\ńb ΑΣ ΣΑ İI")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as piece", "3 as length")
    check(pack_documents(df, tokenizer=PATH, max_tokens=64).collect(), rows, 64)
    assert pack_documents(df.limit(0), tokenizer=PATH).count() == 0
    ids = {(r.doc_id, r.piece): r.ids for r in pack_documents(df.where("doc_id = 2"), tokenizer=PATH, with_ids=True).collect()}
    assert ids == {(2, 0): [0]}


def test_encoder_cache_can_turn_over(monkeypatch):
    monkeypatch.setattr("listwell.llm.packing.CACHE_WORDS", 3)
    e, t = WordEncoder(PATH), Tokenizer.from_file(PATH)
    for text in ("one two three four", "four five one", "", "six"):
        raw = np.frombuffer(text.encode(), np.uint8)
        assert e.encode(raw, np.array([0, len(raw)]))[0].tolist() == t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(4))
def test_plan_covers_the_histogram(seed):
    rng, size = np.random.default_rng(seed), 256
    h = np.zeros(size + 1, np.int64)
    n = [0, 5, 400, 20_000][seed]
    np.add.at(h, np.minimum(size, rng.geometric(0.02, n)), 1)
    for plan in (best_fit(h, size), plan_packing(h, size)):
        used = np.zeros_like(h)
        for p, k in plan.items():
            assert sum(p) <= size
            np.add.at(used, list(p), k)
        assert (used == h).all()
    total = int((h * np.arange(size + 1)).sum())
    assert sum(plan.values()) <= -(-total // size) * 1.01 + 2
    assert len(slot_table(plan)[0]) == sum(map(len, plan))


def test_words_that_differ_in_structure_only(spark):
    a, b = ("".join(p[i.bit_count() % 2] for i in range(2048)) for p in ("ab", "ba"))
    rows = [(1, a), (2, b), (3, f"{a} {b} {a}")]
    check(pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer=PATH).collect(), rows, 2048)


def test_runs_of_letters_give_the_tokenizers_ids():
    e, t = WordEncoder(PATH), Tokenizer.from_file(PATH)
    assert e.fine
    rng = random.Random(3)
    bits = ["Don't", "x'SAY", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "a<b|c", "42nd", "É×é", "÷", "Привет,", "мир1", "ѓ", "Ω", "ΑΣ", "ﬁ", "\u0301", "e\u0301", "İx", "ŉ", "—", "ab—cd", "\x00", "\x1c", "\x7f", "\u00a0", "漢字", "C:\\x", "...", "http://a.b/c?d=1&e=2", "'", "''s", "ſ", "🙂!"]
    for _ in range(400):
        texts = ["".join(rng.choice(bits) + rng.choice(["", "", " ", "\n"]) for _ in range(rng.randrange(0, 9))) for _ in range(4)]
        raw = [x.encode() for x in texts]
        ids, first = e.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == [t.encode(x, add_special_tokens=False).ids for x in texts], texts


def test_most_sequences_come_from_patterns_of_several_pieces(spark):
    pieces = token_pieces(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), tokenizer=PATH)
    h = np.zeros(2049, np.int64)
    for length, n in pieces.groupBy("length").count().collect():
        h[length] = n
    fitted, left = fitted_patterns(h, 2048)
    plan = plan_packing(h, 2048)
    several = sum(n for p, n in fitted.items() if len(p) > 1)
    assert several >= 0.9 * (sum(plan.values()) - h[2048]) and left.sum() <= 0.1 * h.sum()
    assert sum(plan.values()) <= 1.002 * -(-int(h @ np.arange(2049)) // 2048)
