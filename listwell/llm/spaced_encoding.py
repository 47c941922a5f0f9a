"""Token ids by a byte-level BPE tokenizer whose pieces are words with the space before them.

A text is cut where the tokenizer always cuts: before the last white space of a run, at the ends of words, and inside plain
words where letters, digits and signs meet. Each distinct unit is encoded once; units without white space of their own are
encoded many at a time, a line each. Words with white space beyond ASCII or with the beginning of a special token make
one unit with all white space around them.
"""

from __future__ import annotations

import json

import numpy as np

from .packing import WordEncoder
from .words import Words, split_words

# What the units are cut by. Letters: ASCII, and two-byte letters (lead bytes of U+00C0-U+017F and
# U+0400-U+047F) but for the two signs among them; white space beyond ASCII by its bytes (in ranges); a special token's
# first bytes.
_LEADS, _NO_LETTERS = (0xC3, 0xC4, 0xC5, 0xD0, 0xD1), ((0xC3, 0x97), (0xC3, 0xB7))
_WIDE_SPACE_2 = ((0xC2, 0x85), (0xC2, 0xA0))
_WIDE_SPACE_3 = ((0xE1, 0x9A, 0x80, 0x80), (0xE2, 0x80, 0x80, 0x8A), (0xE2, 0x80, 0xA8, 0xA9), (0xE2, 0x80, 0xAF, 0xAF), (0xE2, 0x81, 0x9F, 0x9F), (0xE3, 0x80, 0x80, 0x80))
_SPECIAL = b"<|"

_KIND = np.full(256, 3, np.uint8)
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[48:58] = 2
_PLAIN = np.ones(256, bool)
_PLAIN[[ord("'"), *range(32), 127, *range(0xC0, 0x100)]] = False
_PLAIN[list(_LEADS)] = True
_MAYBE_SPACE = np.zeros(256, bool)
_MAYBE_SPACE[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def _holds(marks: np.ndarray, words: Words) -> np.ndarray:
    """Whether each word has a mark."""
    total = np.concatenate([[0], np.cumsum(marks)])
    return total[words.ends] > total[words.starts]


def spaced_units(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    """Units that cover the texts, and whether each must be encoded by itself."""
    words = split_words(data, offsets)
    n = len(data)
    after, third = np.append(data[1:], 0), np.append(data[2:], [0, 0])[:n]
    risky = (data == _SPECIAL[0]) & (after == _SPECIAL[1])
    if _MAYBE_SPACE[data].any():
        for a, b in _WIDE_SPACE_2:
            risky |= (data == a) & (after == b)
        for a, b, low, high in _WIDE_SPACE_3:
            risky |= (data == a) & (after == b) & (third >= low) & (third <= high)
    odd = ~_PLAIN[data] | risky
    for a, b in _NO_LETTERS:
        odd |= (data == a) & (after == b)
    alone, uncut = _holds(risky, words), _holds(odd, words)
    starts, ends = words.starts[~alone], words.ends[~alone]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    begins = cut[starts]
    cut[ends] = True
    led = ~begins & (data[np.maximum(starts - 1, 0)] == 0x20)
    cut[starts[~begins] - 1] = True
    cut[starts[~led]] = True
    # inside plain words: where the kind of character changes
    fine = np.zeros(n + 1, np.int8)
    fine[words.starts[~uncut]] += 1
    fine[words.ends[~uncut]] -= 1
    inside = np.cumsum(fine[:n]) > 0
    kind = _KIND[data]
    change = np.zeros(n, bool)
    change[1:] = (kind[1:] != kind[:-1]) & inside[1:] & inside[:-1]
    begins_word = np.zeros(n + 1, bool)
    begins_word[words.starts] = True
    cut[:n] |= change & ~begins_word[:n]
    cut[n] = False
    at = np.flatnonzero(cut)
    to = np.append(at[1:], n)
    # a unit of white space or with a risky word stands by itself
    word_bytes = np.zeros(n + 1, np.int8)
    word_bytes[starts] += 1
    word_bytes[ends] -= 1
    plain = np.concatenate([[0], np.cumsum(np.cumsum(word_bytes[:n]) > 0)])
    return Words(data, offsets, at, to, np.searchsorted(at, offsets)), plain[to] == plain[at]


class SpacedEncoder(WordEncoder):
    """The ids of a byte-level tokenizer (spaces before words, its usual split pattern, nothing normalised)."""

    #: A word with a space before it is another unit than one without.
    generation = 2

    def __init__(self, path: str):
        super().__init__(path)
        steps = json.loads(self.tokenizer.to_str())
        pre = steps["pre_tokenizer"] or {}
        if steps["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError(f"{path} is no byte-level tokenizer without normalisation and prefix")
        if any(not t["content"].startswith(_SPECIAL.decode()) or t["lstrip"] or t["rstrip"] or t["single_word"] for t in steps["added_tokens"]):
            raise ValueError(f"{path} has added tokens that this encoder can't tell")
        self.line = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]

    def units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
        if not len(data):
            none = np.zeros(0, np.int64)
            return Words(data, offsets, none, none, np.zeros(len(offsets), np.int64)), np.zeros(0, bool)
        return spaced_units(data, offsets)

    def _learn(self, words: list[bytes]) -> None:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]
        self._keep(words, np.array([i for e in ids for i in e], np.uint32), np.array(list(map(len, ids))))

    def _learn_runs(self, runs: list[bytes], at_once: int = 4096) -> None:
        """One unit a line: a line break is a piece of its own, and no unit holds one."""
        for i in range(0, len(runs), at_once):
            part = runs[i : i + at_once]
            ids = np.array(self.tokenizer.encode_batch_fast([b"\n".join(part).decode()], add_special_tokens=False)[0].ids, np.uint32)
            line = ids == self.line
            bounds = np.concatenate([[-1], np.flatnonzero(line), [len(ids)]])
            self._keep(part, ids[~line], np.diff(bounds) - 1)
