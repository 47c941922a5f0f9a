"""Quality rules: base counts, and a logistic regression on hashed word and character n-grams with calibrated output.

The model is fitted on a bounded sample of labelled documents (``per_class`` of each label): words, pairs of words and
4-grams of characters (code points) are hashed to fixed buckets, their shares of a text are the features. A quarter of the sample is held out to calibrate the
probability (Platt scaling). Scoring and all counts run in Arrow batches over every whole text, against fixed thresholds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memory import lean
from .training import labelled_sample
from .words import Words, exact_codes, gram_hashes, split_words, sums_by_text, text_slices

WORD_BITS, CHAR_BITS, CHAR_GRAM = 18, 16, 4
#: Features are shares of a text, times this.
SCALE = 10.0
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Probability from which a document is kept. On held-out labelled rows that pass the base rules, junk stays below 0.1 and
#: good text above 0.45.
KEEP_AT = 0.3
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def word_buckets(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of words, buckets of pairs of words, and whether a pair lies within one text."""
    h, text = words.hashes(), words.text_of
    pair = gram_hashes(h, 2)
    return (h >> np.uint64(64 - WORD_BITS)).astype(np.int64), (pair >> np.uint64(64 - WORD_BITS)).astype(np.int64), text[:-1] == text[1:]


def char_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the n-gram of code points at each place, whether it lies within one text, and each text's first place."""
    first = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.uint64)
    n = len(points) - CHAR_GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, bool), first
    code = np.zeros(n, np.uint64)
    for j in range(CHAR_GRAM):
        code = (code + points[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
    whole = np.ones(n, bool)
    for j in range(1, CHAR_GRAM):
        cut = first[1:-1] - j
        whole[cut[(cut >= 0) & (cut < n)]] = False
    return (code >> np.uint64(64 - CHAR_BITS)).astype(np.int64), whole, first


def _within(first: np.ndarray, n: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(bounds of each text's n-grams among ``n`` places, how many it has)."""
    return np.minimum(first, n), np.maximum(np.diff(first) - gram + 1, 0)


@dataclass
class QualityModel:
    word: np.ndarray
    char: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def scores(self, words: Words, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Score of each text: weights times shares, an empty share being zero."""
        word, pair, joined = word_buckets(words)
        total = sums_by_text(self.word[word], words.first) / np.maximum(words.counts, 1)
        at, n = _within(words.first, len(pair), 2)
        total += sums_by_text(self.word[pair] * joined, at) / np.maximum(n, 1)
        char, whole, first = char_buckets(data, offsets)
        at, n = _within(first, len(char), CHAR_GRAM)
        total += sums_by_text(self.char[char] * whole, at) / np.maximum(n, 1)
        return SCALE * total + self.bias

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * scores + self.shift, -50, 50)))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse features of each sampled text: bucket numbers (characters after words) and values."""
    for b in batches:
        rows = []
        for _, n, data, offsets in text_slices(b.column(0)):
            words = split_words(data, offsets)
            w, pair, joined = word_buckets(words)
            c, whole, first = char_buckets(data, offsets)
            for i in range(n):
                a, z = words.first[i], words.first[i + 1]
                inside = slice(first[i], min(first[i + 1], len(c)))
                own = (w[a:z], pair[a : max(a, z - 1)], c[inside][whole[inside]] + (1 << WORD_BITS))
                at, value = [], []
                for part in own:
                    u, k = np.unique(part, return_counts=True)
                    at.append(u)
                    value.append(SCALE * k / max(len(part), 1))
                rows.append((np.concatenate(at).astype(np.int32).tobytes(), np.concatenate(value).astype(np.float32).tobytes()))
        yield pa.RecordBatch.from_arrays([b.column(1), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary()), b.column(2)], names=["label", "at", "value", "id"])


def _logistic(row: np.ndarray, col: np.ndarray, val: np.ndarray, y: np.ndarray, width: int, l2: float = 1e-4, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Accelerated gradient descent on the mean log loss, both classes weighing the same."""
    n = len(y)
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    norms = np.bincount(row, val**2, n)
    step = 1 / (0.25 * (float((share * (norms + 1)).sum()) + 1e-9) + l2)
    w = v = np.zeros(width + 1)
    t = 1.0
    for _ in range(rounds):
        score = np.bincount(row, val * v[col], n) + v[-1]
        g = share * (1 / (1 + np.exp(-np.clip(score, -50, 50))) - y)
        grad = np.append(np.bincount(col, val * g[row], width), g.sum())
        grad[:-1] += l2 * v[:-1]
        new = v - step * grad
        t, was = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        v, w = new + (was - 1) / t * (new - w), new
    return w[:-1], float(w[-1])


def _platt(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the calibrated logit, with smoothed targets; Newton's method with a small ridge."""
    pos, neg = max(1, int((y == 1).sum())), max(1, int((y == 0).sum()))
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    share = np.where(y == 1, 0.5 / pos, 0.5 / neg)
    x, beta = np.stack([score, np.ones_like(score)], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hess = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        move = np.linalg.solve(hess, x.T @ (share * (p - target)) + 1e-6 * (beta - [1, 0]))
        beta = beta - move * min(1.0, 2.0 / (np.abs(move).max() + 1e-9))
    return (float(beta[0]), float(beta[1])) if beta[0] > 0 else (1.0, 0.0)


def fit_quality_model(docs: DataFrame, labels: DataFrame, *, per_class: int = 750, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> QualityModel | None:
    """The calibrated model, or None where the labels hold one class only (then no document is rejected by it).

    ``per_class`` bounds what the driver holds: that many sparse rows of each class, each at most one value for a bucket.
    """
    sample = labelled_sample(docs, labels, label_col=label_col, per_class=per_class, id_col=id_col, text_col=text_col)
    rows = sorted(sample.mapInArrow(lean(_features), "label int, at binary, value binary, id long").collect(), key=lambda r: (r.id, r.label, bytes(r.at)))
    y = np.array([r.label for r in rows], float)
    if len(set(y.tolist())) < 2:
        return None
    # every fourth row of a class calibrates
    held = np.zeros(len(rows), bool)
    for k in (0, 1):
        held[np.flatnonzero(y == k)[3::4]] = True
    parts = []
    for chosen in (~held, held):
        index = np.flatnonzero(chosen)
        at = [np.frombuffer(rows[i].at, np.int32) for i in index]
        row = np.repeat(np.arange(len(index)), [len(a) for a in at])
        none = np.zeros(0, np.int32)
        parts.append((row, np.concatenate([none, *at]), np.concatenate([none.astype(np.float32), *(np.frombuffer(rows[i].value, np.float32) for i in index)]).astype(float), y[index]))
    width = (1 << WORD_BITS) + (1 << CHAR_BITS)
    w, bias = _logistic(*parts[0], width)
    model = QualityModel(w[: 1 << WORD_BITS].astype(np.float32), w[1 << WORD_BITS :].astype(np.float32), bias)
    row, col, val, truth = parts[1]
    if len(set(truth.tolist())) == 2:
        model.slope, model.shift = _platt(np.bincount(row, val * w[col], len(truth)) + bias, truth)
    return model


def _repeats(words: Words, text: np.ndarray, gram: int = 3) -> np.ndarray:
    """Words of each text that stand in a window of ``gram`` words found twice or more in that text."""
    word = words.codes()
    n = len(word) - gram + 1
    if n <= 0:
        return np.zeros(len(words.counts), np.int64)
    inside = text[:n] == text[gram - 1 :]
    # windows by number: a text's number, then one word after the other, so that equal numbers are equal words
    code = text[:n][inside]
    for j in range(gram):
        code, _ = pd.factorize(code.astype(np.int64) * (int(word.max()) + 1) + word[j : j + n][inside])
    twice = np.zeros(n, bool)
    twice[inside] = (np.bincount(code) > 1)[code] if len(code) else False
    covered = np.zeros(len(word), bool)
    for j in range(gram):
        covered[j : j + n] |= twice
    return sums_by_text(covered.astype(np.int64), words.first)


def _dup_lines(data: np.ndarray, offsets: np.ndarray, words: Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    texts = len(offsets) - 1
    cuts = np.flatnonzero(data == 10)
    # a line begins at a text's begin and after each newline, and ends before the next newline or at the text's end
    start = np.concatenate([offsets[:-1], cuts + 1])
    text = np.concatenate([np.arange(texts), np.searchsorted(offsets, cuts, "right") - 1])
    order = np.lexsort((start, text))
    start, text = start[order], text[order]
    end = np.append(start[1:] - 1, 0)
    last = np.append(text[1:] != text[:-1], True)
    end[last] = offsets[1:][text[last]]
    filled = np.searchsorted(words.starts, end) > np.searchsorted(words.starts, start)
    start, end, text = start[filled], end[filled], text[filled]
    if not len(start):
        return np.zeros(texts, np.int64)
    line = exact_codes(data, start, end)
    again = pd.Series(text.astype(np.int64) * (int(line.max()) + 1) + line).duplicated().to_numpy()
    return np.bincount(text[again], minlength=texts)


def _judged(texts: pa.Array, model: QualityModel | None, threshold: float) -> Iterator[tuple]:
    """(first row, rows, counts, base_failed, probability, kept) of whole texts, slice by slice."""
    for row, n, data, offsets in text_slices(texts):
        words = split_words(data, offsets)
        inside = np.zeros(len(data) + 1, np.int8)
        inside[words.starts] += 1
        inside[words.ends] -= 1
        points = (np.cumsum(inside[:-1]) > 0) & ((data & 0xC0) != 0x80)
        count, repeat = words.counts, _repeats(words, words.text_of)
        failed = (count < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * count)
        p = model.probabilities(model.scores(words, data, offsets)) if model else None
        kept = ~failed if p is None else ~failed & (p >= threshold)
        columns = [count, sums_by_text(points.astype(np.int64), offsets), sums_by_text(_SYMBOL[data].astype(np.int64), offsets), _dup_lines(data, offsets, words), repeat]
        yield row, n, columns, failed, p, kept


def quality_report(docs: DataFrame, model: QualityModel | None, *, threshold: float = KEEP_AT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    probability (of good quality; null without a model), kept.

    A document fails the base rules with fewer than 50 words, or if more than half of its words stand in repeated windows
    of three; it is kept if it passes them and its probability reaches ``threshold``. A null text has no words. Null ids and repeated rows
    get rows like others; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, n, columns, failed, p, kept in _judged(b.column(1), model, threshold):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(row, n), *(pa.array(c.astype(np.int64)) for c in columns), pa.array(failed), pa.nulls(n, pa.float64()) if p is None else pa.array(p), pa.array(kept)], names=["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "probability", "kept"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lean(run), "id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, probability double, kept boolean").withColumnRenamed("id", id_col)


def good_documents(docs: DataFrame, model: QualityModel | None, *, threshold: float = KEEP_AT, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass all rules, columns unchanged; one pass without a shuffle."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = [k for *_, k in _judged(b.column(at).cast(pa.string()), model, threshold)]
            if kept:
                yield b.filter(pa.array(np.concatenate(kept)))

    return docs.mapInArrow(lean(run), docs.schema)
