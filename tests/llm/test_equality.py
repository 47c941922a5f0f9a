"""Words that collide under a hash that is the same in every run, as whoever writes the texts could know it, are told apart."""

import hashlib

import numpy as np
import pytest

from listwell.llm.jaccard import jaccard_components
from listwell.llm.quality import quality_report
from listwell.llm.substring_dedup import substring_dedup
from listwell.llm.words import drawn_key, exact_codes, keyed_hashes, mix, span_hashes

WORD_CHARS = frozenset(range(33, 127))


def colliding_words():
    """Two ASCII words of 17 bytes with one span hash: what the first lane changes the second takes back."""
    length = mix(np.array([17], np.uint64) ^ np.uint64(0x243F6A8885A308D3))[0]
    rng = np.random.default_rng(1)
    while True:
        first = rng.integers(33, 127, (200_000, 8), dtype=np.uint8)
        state = mix(length ^ first.copy().view("<u8").ravel())
        # the second lane must carry the difference of the states: look for one that keeps ASCII letters
        base = rng.integers(33, 127, 8, dtype=np.uint8)
        for i in rng.integers(0, len(state), 2000).tolist():
            other = (base.view("<u8")[0] ^ state[i] ^ state).view(np.uint8).reshape(-1, 8)
            good = np.flatnonzero(((other >= 33) & (other < 127)).all(axis=1))
            good = good[good != i]
            if len(good):
                j = int(good[0])
                return bytes(first[i]) + bytes(base) + b"?", bytes(first[j]) + bytes(other[j]) + b"?"


@pytest.fixture(scope="module")
def words():
    a, b = colliding_words()
    both = np.frombuffer(a + b, np.uint8)
    at = np.array([0, 17]), np.array([17, 34])
    assert a != b and len(set(span_hashes(both, *at).tolist())) == 1
    assert len(set(keyed_hashes(both, *at, drawn_key()).tolist())) == 2 and exact_codes(both, *at).tolist() == [0, 1]
    return a.decode(), b.decode()


def test_passages(spark, words):
    a, b = words
    run = [f"w{i}" for i in range(12)]
    docs = spark.createDataFrame([(1, " ".join([*run, a])), (2, " ".join([*run, b])), (3, " ".join(["x", *run, a]))], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in substring_dedup(docs).collect()} == {1: 0, 2: 0, 3: 13}


def test_repeated_windows(spark, words):
    a, b = words
    docs = spark.createDataFrame([(1, f"x y {a} x y {b}"), (2, f"x y {a} x y {a}")], "doc_id long, text string")
    assert {r.doc_id: r.n_repeat_words for r in quality_report(docs, None).collect()} == {1: 0, 2: 6}


def test_similar_sets(spark, words):
    a, b = words
    docs = spark.createDataFrame([(1, f"{a} " * 5), (2, f"{b} " * 5), (3, f"{a} " * 6)], "doc_id long, text string")
    assert {r.id: r.least_id for r in jaccard_components(docs).collect()} == {1: 1, 2: 2, 3: 1}


def test_keyed_hashes():
    texts = [b"", b"a", b"b", b"ab", b"a\0", b"12345678", b"123456789", b"x" * 255, b"x" * 256, b"x" * 257, bytes(range(1, 200))]
    data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    key = hashlib.sha256(b"k").digest()
    h = keyed_hashes(data, starts, ends, key)
    assert len(set(h.tolist())) == len(texts) and (h == keyed_hashes(data, starts, ends, key)).all()
    assert not (h == keyed_hashes(data, starts, ends, drawn_key()))[1:].any()
    # places in the data make no difference
    again = np.frombuffer(b"zz" + b"".join(texts), np.uint8)
    assert (h == keyed_hashes(again, starts + 2, ends + 2, key)).all()
