"""Toxicity by cumulative-link (proportional odds) ordinal regression on sparse word features.

Features are the distinct lower-cased letter runs of a text, named by 64-bit hashes. One weight vector is shared by all
ordered thresholds: P(grade <= k) = logistic(theta_k - w.x). An L1 penalty keeps few weights, so scoring is a lookup of
each word in a short sorted table, in Arrow batches over whole texts. The expected severity is the mean grade.

Labels say only toxic or not. Grades of a toxic document in the sample come from how many distinct marker words it has,
markers being words far more frequent in its class than in the other: 1 up to the median of toxic documents, 2 above.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .training import labelled_sample
from .words import Words, split_words, text_slices

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_NO_LETTER = np.ones(256, bool)
_NO_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def letter_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Runs of ASCII letters and non-ASCII bytes, A-Z lower-cased."""
    return split_words(_LOWER[data], offsets, _NO_LETTER)


def word_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every word."""
    words = letter_words(data, offsets)
    return words.text_of, words.hashes()


@dataclass
class OrdinalModel:
    keys: np.ndarray  # sorted word hashes with a weight
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than grades

    def scores(self, text: np.ndarray, keys: np.ndarray, texts: int) -> np.ndarray:
        """w.x of each text, each distinct feature counting once."""
        if not len(self.keys):
            return np.zeros(texts)
        # most features have no weight: a table of their low bits rules out nearly all before the search
        maybe = np.flatnonzero(self._low_bits[(keys & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, keys[maybe]), len(self.keys) - 1)
        hit = self.keys[at] == keys[maybe]
        pairs = np.unique(text[maybe[hit]] * len(self.keys) + at[hit])
        return np.bincount(pairs // len(self.keys), self.weights[pairs % len(self.keys)], texts)

    def __post_init__(self) -> None:
        self._low_bits = np.zeros(1 << 16, bool)
        self._low_bits[(self.keys & np.uint64(0xFFFF)).astype(np.int64)] = True

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        """One column for each grade."""
        up_to = 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - scores[:, None], -50, 50)))
        bounds = np.concatenate([np.zeros((len(scores), 1)), up_to, np.ones((len(scores), 1))], axis=1)
        return np.diff(bounds, axis=1)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for _, n, data, offsets in text_slices(b.column(0)):
            text, keys = word_features(data, offsets)
            cuts = np.searchsorted(text, np.arange(n + 1))
            rows += [np.unique(keys[cuts[i] : cuts[i + 1]]).tobytes() for i in range(n)]
        yield pa.RecordBatch.from_arrays([b.column(1), pa.array(rows, pa.binary()), b.column(2)], names=["label", "keys", "id"])


def fit_ordinal(row: np.ndarray, col: np.ndarray, grade: np.ndarray, share: np.ndarray, width: int, grades: int, l1: float = 1e-3, rounds: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds of the cumulative-link model, by accelerated proximal gradient.

    Thresholds are kept in order through a first one and positive gaps. ``share`` weighs the rows and sums to one.
    """
    n = len(grade)
    rate = np.cumsum([share[grade == k].sum() for k in range(grades)])[:-1]
    theta = np.log(np.clip(rate, 1e-3, 1 - 1e-3) / (1 - np.clip(rate, 1e-3, 1 - 1e-3)))
    theta = np.maximum.accumulate(theta + 1e-3 * np.arange(len(theta)))
    probe, norm = np.ones(width), 1.0
    for _ in range(20):
        probe = np.bincount(col, (share * np.bincount(row, probe[col], n))[row], width)
        norm = float(np.linalg.norm(probe)) or 1.0
        probe /= norm
    step = 1 / (0.5 * norm + 0.5)
    w = v = np.zeros(width)
    t, momentum_theta = 1.0, theta
    logistic = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for _ in range(rounds):
        s = np.bincount(row, v[col], n)
        edge = np.concatenate([[-40.0], momentum_theta, [40.0]])
        hi, lo = logistic(edge[grade + 1] - s), logistic(edge[grade] - s)
        p = np.maximum(hi - lo, 1e-9)
        d_hi, d_lo = hi * (1 - hi) / p, lo * (1 - lo) / p
        g_score = share * (d_hi - d_lo)  # of the negative log likelihood
        grad_theta = np.array([-(share * d_hi)[grade == k].sum() + (share * d_lo)[grade == k + 1].sum() for k in range(grades - 1)])
        new = v - step * np.bincount(col, g_score[row], width)
        new = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0)
        new_theta = np.maximum.accumulate(momentum_theta - step * grad_theta + 1e-6 * np.arange(grades - 1))
        t, was = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        v, w, momentum_theta, theta = new + (was - 1) / t * (new - w), new, new_theta + (was - 1) / t * (new_theta - theta), new_theta
        momentum_theta = np.maximum.accumulate(momentum_theta)
    return w, theta


def fit_toxicity_model(docs: DataFrame, labels: DataFrame, *, per_class: int = 1500, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", min_rows: int = 5) -> OrdinalModel | None:
    """Model on at most ``per_class`` documents of each label, or None if the labels hold one class only.

    The driver holds the distinct word hashes of that many documents, nothing that grows with the corpus.
    """
    sample = labelled_sample(docs, labels, label_col=label_col, per_class=per_class, id_col=id_col, text_col=text_col)
    rows = sorted(sample.mapInArrow(_features, "label int, keys binary, id long").collect(), key=lambda r: (r.id, r.label, bytes(r["keys"])))
    label = np.array([r.label for r in rows], np.int64)
    if len(set(label.tolist())) < 2:
        return None
    sets = [np.frombuffer(r["keys"], np.uint64) for r in rows]
    row = np.repeat(np.arange(len(rows)), [len(k) for k in sets])
    keys, col, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    frequent = count >= min(min_rows, max(1, int(label.sum()) // 4))
    use = frequent[col]
    row, col, keys = row[use], (np.cumsum(frequent) - 1)[col[use]], keys[frequent]
    toxic_rate = np.bincount(col[label[row] == 1], minlength=len(keys)) / label.sum()
    other_rate = np.bincount(col[label[row] == 0], minlength=len(keys)) / (1 - label).sum()
    marker = (toxic_rate > 0.02) & (toxic_rate > 10 * other_rate)
    marks = np.bincount(row, marker[col], len(rows))
    middle = np.median(marks[label == 1])
    grade = np.where(label == 0, 0, np.where(marks > middle, 2, 1))
    grades = int(grade.max()) + 1
    # both labels weigh the same
    share = np.where(label == 1, 0.5 / label.sum(), 0.5 / (1 - label).sum())
    w, theta = fit_ordinal(row, col, grade, share, len(keys), grades)
    own = np.flatnonzero(w)
    return OrdinalModel(keys[own], w[own], theta)


def toxicity_scores(docs: DataFrame, model: OrdinalModel | None, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per document: ``id_col``, severity (expected grade), grade (the likeliest), p_toxic (of grade 1 or more), toxic.

    ``toxic`` is set where p_toxic reaches ``threshold``. A text without letters, null or empty, has no features. Without a
    model every severity is zero. Null ids and repeated rows get rows like others; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, n, data, offsets in text_slices(b.column(1)):
                p = model.probabilities(model.scores(*word_features(data, offsets), n)) if model else np.ones((n, 1))
                severity, bad = p @ np.arange(p.shape[1]), p[:, 1:].sum(axis=1)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(row, n), pa.array(severity), pa.array(p.argmax(axis=1).astype(np.int32)), pa.array(bad), pa.array(bad >= threshold)], names=["id", "severity", "grade", "p_toxic", "toxic"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, severity double, grade int, p_toxic double, toxic boolean").withColumnRenamed("id", id_col)
