import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from listwell.llm.queries import QUERIES
from listwell.llm.spaced_encoding import SpacedEncoder
from listwell.llm.tier_packing import STEP_TOKENS, TIERS, pack_tiers, plan_tiers

SF = "/root/testdata/sf0.01"
PATH = P.path("byte_bpe_50k.json")
T = Tokenizer.from_file(PATH)


def check(rows, texts, tiers=TIERS):
    """Every id in one part, windows gapless and full, parts' sums right; returns how many parts there are beyond need."""
    parts = defaultdict(list)
    for r in rows:
        parts[r.doc_id].append(r)
    docs = defaultdict(list)
    for i, text in texts:
        docs[i].append([*T.encode(text or "", add_special_tokens=False).ids, 1])
    assert set(parts) == set(docs)
    for i, ids in docs.items():
        # rows of one id are told apart by what they hold
        want = sorted(zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids)
        if len(ids) == 1:
            at = 0
            for r in sorted(parts[i], key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(ids[0]) and r.ids_crc32 == zlib.crc32(np.array(ids[0][at : at + r.length], "<u4").tobytes())
                at += r.length
            assert at == len(ids[0])
        else:
            assert sum(r.length for r in parts[i]) == sum(map(len, ids)) and want
    windows = defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append(r)
    for spans in windows.values():
        end = 0
        for r in sorted(spans, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert {r.window for r in spans} == {end} and end & (end - 1) == 0
    sizes = sorted(spans[0].window for spans in windows.values())
    small = [s for s in sizes if s < tiers[-1]]
    assert len(small) == len(set(small)) and max(sizes) <= tiers[0]
    steps = defaultdict(set)
    for r in rows:
        steps[r.step_id].add((r.sequence_id, r.window))
    for s in steps.values():
        assert len({w for _, w in s}) == 1 and sum(w for _, w in s) <= STEP_TOKENS
    assert sorted(steps) == list(range(len(steps)))
    return len(rows) - sum(-(-len(x) // tiers[0]) for ids in docs.values() for x in ids)


def test_documents(spark):
    rows = QUERIES["op11_tier_packing"](spark, SF).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    extra = check(rows, docs)
    assert extra < 0.7 * len(docs) and len({r.window for r in rows}) >= 2
    # steps of one tier are of equal size but for one window
    by = defaultdict(set)
    for r in rows:
        by[(r.window, r.step_id)].add(r.sequence_id)
    for w in TIERS:
        sizes = [len(v) for (s, _), v in by.items() if s == w]
        assert not sizes or max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("tiers", [TIERS, (16, 8, 4), (4,)])
def test_edges(spark, tiers):
    rows = [(1, None), (2, ""), (3, "It's <|endoftext|> don't 42 ¼ É é"), (3, "a"), (None, "x y"), (5, "wörd x y " * 900), (6, "́ a\ńb ΑΣ ΣΑ İI\u00a0 x"), (7, "a " * 3), (8, "the end")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as start", "3 as length", "4 as bucket")
    check(pack_tiers(df, tokenizer=PATH, tiers=tiers).collect(), rows, tiers)
    assert pack_tiers(df.limit(0), tokenizer=PATH).count() == 0
    got = pack_tiers(df.where("doc_id = 8"), tokenizer=PATH, tiers=tiers, with_ids=True).orderBy("start").collect()
    assert [i for r in got for i in r.ids] == [*T.encode("the end").ids, 1]
    with pytest.raises(ValueError, match="powers of two"):
        pack_tiers(df, tokenizer=PATH, tiers=(4, 8))


@pytest.mark.parametrize("seed", range(6))
def test_plans_place_every_token_once(seed):
    rng = np.random.default_rng(seed)
    n = [0, 1, 7, 300, 20_000, 1_000_000][seed]
    h = np.zeros(2049, np.int64)
    np.add.at(h, np.minimum(2048, 1 + rng.geometric([0.5, 0.001, 0.005, 0.002, 0.001, 0.02][seed], n)), 1)
    plan = plan_tiers(h)
    covered = {length: np.zeros((int(h[length]), length), np.int8) for length in np.flatnonzero(h).tolist()} if n <= 300 else None
    used = np.zeros(2049, np.int64)
    for _, length, first, count, start, tokens, size, window, offset in plan.parts:
        assert count > 0 and tokens > 0 and start + tokens <= length and offset + tokens <= size and window + count <= plan.windows[size]
        used[length] += count * tokens
        if covered:
            covered[length][first : first + count, start : start + tokens] += 1
    assert (used == h * np.arange(2049)).all()
    assert covered is None or all((c == 1).all() for c in covered.values())
    assert sum(s * k for s, k in plan.windows.items()) == used.sum()
    # the plan grows with the bins, not with the documents; nearly all pieces stay whole
    assert len(plan.parts) < 30_000
    assert sum(p[3] for p in plan.parts) <= 1.5 * n + 20


def test_units_give_the_tokenizers_ids(monkeypatch):
    e = SpacedEncoder(PATH)
    rng = random.Random(3)
    bits = ["Don't", "x'SAY", "<|endoftext|>", "<|", "<|x", "a<b|c", "42nd", "É×é", "÷", "Привет,", "мир1", "Ω", "\u0301", "e\u0301", "ŉ", "—", "ab—cd", "“q”", "\x00", "\x1c", "\x85", "\x7f", "\u00a0", "\u2003", "\u3000", "\u2028", "\u1680", "漢字", "C:\\x", "...", "http://a.b/c?d=1", "'", "''s", "🙂!", "½", "٣"]
    space = ["", " ", "  ", "   ", "\n", "\n\n", " \n", "\n ", "\t", " \t ", "\r\n"]
    for _ in range(1500):
        texts = [rng.choice(space) + "".join(rng.choice(bits) + rng.choice(space) for _ in range(rng.randrange(0, 9))) for _ in range(4)]
        raw = [x.encode() for x in texts]
        ids, first = e.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == [T.encode(x, add_special_tokens=False).ids for x in texts], texts
    monkeypatch.setattr("listwell.llm.packing.CACHE_WORDS", 3)
    for text in ("one two three four", "four five one", "", "six"):
        raw = np.frombuffer(text.encode(), np.uint8)
        assert e.encode(raw, np.array([0, len(raw)]))[0].tolist() == T.encode(text, add_special_tokens=False).ids
    with pytest.raises(ValueError, match="byte-level"):
        SpacedEncoder(P.path("word_bpe_49k.json"))
