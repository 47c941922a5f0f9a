"""Columnar text helpers shared by the operators of this subpackage.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, that is ``[^\\x20\\x09-\\x0D]+``.
Everything works on Arrow buffers through NumPy: no Python object is made per word. A null text
counts as an empty one. Texts are walked in slices of a few megabytes, so memory follows the slice
(or the longest single text), not the batch.
"""

from __future__ import annotations

import functools
import hashlib
import secrets
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 2 << 20
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Key of the span hash, and the length in bytes from which a span is hashed by xxhash.
_KEY, _LONG = 0x243F6A8885A308D3, 256
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads entropy over all 64 bits."""
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Words of consecutive texts: byte spans, the text each belongs to, first word of each text."""

    data: np.ndarray  # uint8, the texts back to back
    offsets: np.ndarray  # byte offset of each text, one more at the end
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # index of each text's first word, one more at the end

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, key: bytes | None = None) -> np.ndarray:
        """A 64-bit hash of every word's bytes, equal for equal words wherever they stand.

        Where equality decides a result it is taken under the run's own ``key``; without one it serves for features.
        """
        return span_hashes(self.data, self.starts, self.ends) if key is None else keyed_hashes(self.data, self.starts, self.ends, key)

    def codes(self) -> np.ndarray:
        """A small number for every word, equal for equal bytes only: by hash, then byte by byte."""
        return exact_codes(self.data, self.starts, self.ends)


def _lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one little-endian number; bytes past the end are zeros."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of byte spans: eight bytes at a time through a keyed mixer, long spans by XXH3.

    A step is one-to-one in the bytes it takes in, so spans of one length that differ in one lane alone never collide.
    """
    lanes, n = _lanes(data), ends - starts
    h = mix(n.astype(np.uint64) ^ np.uint64(_KEY))
    live = np.flatnonzero(n < _LONG)
    at = 0
    while len(live):
        left = n[live] - at
        h[live] = mix(h[live] ^ (lanes[starts[live] + at] & _KEEP[np.minimum(left, 8)]))
        live = live[left > 8]
        at += 8
    if (n >= _LONG).any():
        raw = memoryview(np.ascontiguousarray(data))
        for i in np.flatnonzero(n >= _LONG).tolist():
            h[i] = xxhash.xxh3_64_intdigest(raw[starts[i] : ends[i]], _KEY)
    return h


def drawn_key() -> bytes:
    """A key of a run's own: texts can't be made to collide under it beforehand. The driver draws it, tasks are told."""
    return secrets.token_bytes(32)


@functools.lru_cache(maxsize=8)
def _multipliers(key: bytes) -> np.ndarray:
    """Two rows of numbers drawn by the key: one for each four bytes of a span below ``_LONG``, the last for its length."""
    stream = hashlib.shake_256(key).digest(16 * (_LONG // 4 + 1))
    return np.frombuffer(stream, "<u8").reshape(2, -1)


def keyed_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: bytes) -> np.ndarray:
    """64-bit hash of byte spans under a key: two unequal spans below 256 bytes collide with a chance of 2^-64.

    Two multilinear hashes (a sum of products with random numbers, of which the upper half is kept) make the two halves;
    long spans go through keyed BLAKE2.
    """
    lanes, n, k = _lanes(data), ends - starts, _multipliers(key)
    a, b = n.astype(np.uint64) * k[0, -1], n.astype(np.uint64) * k[1, -1]
    live = np.flatnonzero(n < _LONG)
    low, half = np.uint64(0xFFFFFFFF), np.uint64(32)
    at = 0
    while len(live):
        left = n[live] - at
        x = lanes[starts[live] + at] & _KEEP[np.minimum(left, 8)]
        lower, upper, i = x & low, x >> half, at // 4
        a[live] += lower * k[0, i] + upper * k[0, i + 1]
        b[live] += lower * k[1, i] + upper * k[1, i + 1]
        live = live[left > 8]
        at += 8
    out = mix((a & ~low) | (b >> half))
    if (n >= _LONG).any():
        raw = memoryview(np.ascontiguousarray(data))
        for i in np.flatnonzero(n >= _LONG).tolist():
            out[i] = int.from_bytes(hashlib.blake2b(raw[starts[i] : ends[i]], digest_size=8, key=key).digest(), "little")
    return out


def same_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether spans a[i] and b[i] hold the same bytes."""
    lanes, n = _lanes(data), ends - starts
    same = n[a] == n[b]
    live = np.flatnonzero(same & (a != b))
    at = 0
    while len(live):
        x, y = a[live], b[live]
        left = n[x] - at
        keep = _KEEP[np.clip(left, 0, 8)]
        equal = (lanes[starts[x] + np.minimum(at, n[x])] & keep) == (lanes[starts[y] + np.minimum(at, n[y])] & keep)
        same[live[~equal]] = False
        live = live[equal & (left > 8)]
        at += 8
    return same


def exact_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number from 0 on for every span, in the order of their first places; equal numbers are equal bytes."""
    code, _ = pd.factorize(span_hashes(data, starts, ends))
    first = np.empty(int(code.max(initial=-1)) + 1, np.int64)
    first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
    if not same_spans(data, starts, ends, np.arange(len(code)), first[code]).all():
        raw, known = data.tobytes(), {}
        code = np.array([known.setdefault(raw[a:b], len(known)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.int64)
    return code


def split_words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = _IS_SPACE) -> Words:
    """``separator``: 256 flags of the bytes that part words."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(data, offsets, none, none, np.zeros(len(offsets), np.int64))
    inside = ~separator[data]
    breaks = np.zeros(len(data) + 1, bool)
    breaks[offsets] = True
    left, right = np.ones(len(data), bool), np.ones(len(data), bool)
    left[1:] = ~inside[:-1]
    right[:-1] = ~inside[1:]
    starts = np.flatnonzero(inside & (left | breaks[:-1]))
    ends = np.flatnonzero(inside & (right | breaks[1:])) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def text_slices(column: pa.ChunkedArray | pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, byte offsets) of whole texts, about ``limit`` bytes at a time."""
    row = 0
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        chunk = pc.fill_null(chunk, "") if chunk.null_count else chunk
        wide = pa.types.is_large_string(chunk.type)
        if not len(chunk):
            continue
        offsets = np.frombuffer(chunk.buffers()[1], np.int64 if wide else np.int32)[chunk.offset : chunk.offset + len(chunk) + 1].astype(np.int64)
        raw = chunk.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
        at = 0
        while at < len(chunk):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield row + at, to - at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
            at = to
        row += len(chunk)


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive items; those that would run past the end are left out."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = h[:m].copy()
    for j in range(1, n):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += h[j : j + m]
    return mix(out)


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        v = np.minimum(v[: len(v) - step], v[step:])
        have += step
    return v


def sums_by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of each text's values; ``first`` has one bound more than there are texts."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else None)])
    return total[first[1:]] - total[first[:-1]]


def pack(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def whole_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.ChunkedArray]]:
    """Columns of rows that come in order of the first one, cut so that no value of it is parted."""
    held: list[pa.RecordBatch] = []  # parts of one value that may go on
    for b in batches:
        if not b.num_rows:
            continue
        key = b.column(0).to_numpy()
        # signed order, as Spark sorts
        cut = int(np.searchsorted(key, key[-1]))
        if held and (cut or held[-1].column(0)[-1].as_py() != key[0]):
            yield pa.Table.from_batches([*held, b.slice(0, cut)]).columns
            held = []
        elif cut:
            yield pa.Table.from_batches([b.slice(0, cut)]).columns
        held.append(b.slice(cut))
    if held:
        yield pa.Table.from_batches(held).columns
