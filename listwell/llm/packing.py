"""Best-fit packing of tokenized documents into fixed-length sequences by length patterns.

Documents are tokenized in Arrow batches and only those longer than a sequence are cut. The histogram of piece lengths has
at most ``max_tokens`` bins, whatever the input: patterns of few lengths that fill a sequence are enumerated over it, their
repeat counts fitted by non-negative least squares and rounded, and the rest is fitted anew, at last with a little slack.
What no pattern takes is packed best fit, longest first, into the gaps and new sequences. The plan says for each length
which ranks go to which sequences; ranks come from counts by (length, bucket), so no length is ranked in one task.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .memory import cached, lean
from .storage import written
from .words import Words, same_spans, span_hashes, split_words, text_slices

#: Distinct words of one generation of a worker's cache, which outlives its tasks.
CACHE_WORDS = 200_000
#: Text that is encoded at once; a worker holds some sixty times that for a moment.
ENCODED_BYTES = 1 << 20

# The split pattern of the tokenizer file whose pieces are found below, its special tokens' first bytes, and
# two-byte letters (lead bytes of U+00C0-U+017F and U+0400-U+047F) with the characters among them that are none or that
# change their length in lower case.
_LETTERS_OR_SIGNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPECIAL = b"<|"
_LEADS, _NO_LETTERS = (0xC3, 0xC4, 0xC5, 0xD0, 0xD1), ((0xC3, 0x97), (0xC3, 0xB7), (0xC4, 0xB0))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.full(256, 3, np.uint8)  # 1 letters and bytes of letters, 2 digits, 3 signs
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[48:58] = 2
_PLAIN = np.ones(256, bool)  # bytes that may stand in a word that is cut
_PLAIN[[ord("'"), *range(32), 127, *range(0xC0, 0x100)]] = False
_PLAIN[list(_LEADS)] = True


def letter_runs(words: Words) -> tuple[Words, np.ndarray]:
    """Lower-cased runs of letters, runs of signs and single digits, by word.

    A word stays whole, and as it is, where the tokenizer could see more than that: with an apostrophe, ``<|``, control
    characters, or others than ASCII and common two-byte letters.
    """
    data = words.data
    if not len(data):
        return words
    odd = ~_PLAIN[data]
    after = np.append(data[1:], 0)
    for a, b in (*_NO_LETTERS, tuple(_SPECIAL)):
        odd |= (data == a) & (after == b)
    # a continuation byte counts with its lead; one of a longer character has an odd lead in the same word
    total = np.concatenate([[0], np.cumsum(odd)])
    whole = total[words.ends] > total[words.starts]
    kind = _KIND[data]
    cut = np.ones(len(data), bool)
    cut[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    inside = np.zeros(len(data) + 1, np.int8)
    inside[words.starts] += 1
    inside[words.ends] -= 1
    kept = np.zeros(len(data) + 1, np.int8)
    kept[words.starts[whole]] += 1
    kept[words.ends[whole]] -= 1
    uncut = np.cumsum(kept[:-1]) > 0
    cut &= (np.cumsum(inside[:-1]) > 0) & ~uncut
    cut[words.starts] = True
    starts = np.flatnonzero(cut)
    # a run ends where the next one of its word begins, else where its word ends
    word = np.searchsorted(words.starts, starts, "right") - 1
    ends = words.ends[word]
    same = word[1:] == word[:-1]
    ends[:-1][same] = starts[1:][same]
    return Words(np.where(uncut, data, _LOWER[data]), words.offsets, starts, ends, np.searchsorted(starts, words.offsets)), whole[word]


class WordEncoder:
    """Token ids of whole texts by a tokenizer that drops white space and never joins across it.

    Each distinct word is encoded once by the tokenizer; for a tokenizer that parts letters, digits and signs and lowers
    case, each distinct run of those. Words are found by hash and confirmed by their bytes. The cache has two generations:
    a word that is met again moves to the younger one, so that frequent words stay.
    """

    #: How many times ``CACHE_WORDS`` one generation holds.
    generation = 1

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        steps = json.loads(self.tokenizer.to_str())
        parts = (steps["pre_tokenizer"] or {}).get("pretokenizers", [])
        lowers = {"type": "Lowercase"} in (steps["normalizer"] or {}).get("normalizers", [])
        suffix = steps["model"].get("end_of_word_suffix")
        self.closes = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)  # tokens that end a run
        self.closes[[i for token, i in self.tokenizer.get_vocab().items() if suffix and token.endswith(suffix)]] = True
        self.fine = lowers and bool(suffix) and len(parts) == 2 and parts[0].get("pattern") == {"Regex": _LETTERS_OR_SIGNS} and parts[0]["invert"] and not parts[1].get("use_regex", True)
        self.old: dict[bytes, int] = {}
        self.old_ids, self.old_first = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self._start()

    def _start(self) -> None:
        self.index: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.first = np.zeros(1 << 14, np.int64)  # where each kept word's ids begin, one more at the end

    def _keep(self, words: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> None:
        n = len(self.index)
        used = int(self.first[n])
        while len(self.ids) < used + len(ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[used : used + len(ids)] = ids
        while len(self.first) < n + len(words) + 1:
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
        self.first[n + 1 : n + len(words) + 1] = used + np.cumsum(lengths)
        self.index.update(zip(words, range(n, n + len(words)), strict=True))

    def _learn(self, words: list[bytes]) -> None:
        """Words that are whole: the tokenizer may part them further."""
        enc = self.tokenizer.encode([w.decode() for w in words], is_pretokenized=True, add_special_tokens=False)
        self._keep(words, np.array(enc.ids, np.uint32), np.bincount(np.array(enc.word_ids, np.int64), minlength=len(words)))

    def _learn_runs(self, runs: list[bytes], at_once: int = 4096) -> None:
        """Runs that the tokenizer never parts: as many words of one text."""
        for i in range(0, len(runs), at_once):
            part = runs[i : i + at_once]
            ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids, np.uint32)
            self._keep(part, ids, np.diff(np.flatnonzero(self.closes[ids]), prepend=-1))

    def _slots(self, keys: list[bytes], whole: np.ndarray) -> np.ndarray:
        """Where each key's ids are kept; unknown ones are learned."""
        if len(self.index) > CACHE_WORDS * self.generation:
            self.old, self.old_ids, self.old_first = self.index, self.ids, self.first
            self._start()
        missing = [i for i, k in enumerate(keys) if k not in self.index]
        if missing:
            again = [i for i in missing if keys[i] in self.old]
            if again:
                slot = np.array([self.old[keys[i]] for i in again])
                begin = self.old_first[slot]
                length = self.old_first[slot + 1] - begin
                inner = np.repeat(begin - np.cumsum(length) + length, length) + np.arange(int(length.sum()))
                self._keep([keys[i] for i in again], self.old_ids[inner], length)
            fresh = [i for i in missing if keys[i] not in self.old]
            if one := [keys[i] for i in fresh if whole[i]]:
                self._learn(one)
            if runs := [keys[i] for i in fresh if not whole[i]]:
                self._learn_runs(runs)
        return np.fromiter(map(self.index.__getitem__, keys), np.int64, len(keys))

    def units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
        """What is looked up in the cache, and whether the tokenizer may part it further."""
        words = split_words(data, offsets)
        return letter_runs(words) if self.fine and len(words.starts) else (words, np.ones(len(words.starts), bool))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts back to back, and where each text's ids begin (one more at the end)."""
        words, whole = self.units(data, offsets)
        if not len(words.starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        n = words.ends - words.starts
        key = span_hashes(words.data, words.starts, words.ends)
        code, distinct = pd.factorize(key)
        place = np.empty(len(distinct), np.int64)
        place[code[::-1]] = np.arange(len(code) - 1, -1, -1)
        # equal keys of one length up to 8 bytes are equal bytes by the hash's own making
        one = place[code]
        long = np.flatnonzero(n > 8)
        raw = words.data.tobytes()
        if (n == n[one]).all() and same_spans(words.data, words.starts, words.ends, long, one[long]).all():
            keys = [raw[a:b] for a, b in zip(words.starts[place].tolist(), words.ends[place].tolist(), strict=True)]
        else:
            every = [raw[a:b] for a, b in zip(words.starts.tolist(), words.ends.tolist(), strict=True)]
            known: dict[bytes, int] = {}
            code = np.array([known.setdefault(w, len(known)) for w in every])
            keys = list(known)
            place = np.empty(len(keys), np.int64)
            place[code[::-1]] = np.arange(len(code) - 1, -1, -1)
        slot = self._slots(keys, whole[place])[code]
        begin = self.first[slot]
        length = self.first[slot + 1] - begin
        total = np.concatenate([[0], np.cumsum(length)])
        ids = self.ids[np.repeat(begin - total[:-1], length) + np.arange(total[-1])]
        return ids, total[words.first]


def token_pieces(docs: DataFrame, *, tokenizer: str, max_tokens: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every document: its ids, then ``end_id``, cut only if too long.

    ``tokenizer`` is the path of a tokenizer file, found at the same place on every node.
    """
    schema = "id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = cached(f"words {tokenizer}", lambda: WordEncoder(tokenizer))
        for b in batches:
            for row, rows, data, offsets in text_slices(b.column(1), ENCODED_BYTES):
                ids, first = encoder.encode(data, offsets)
                size = np.diff(first) + 1
                ends = np.cumsum(size)
                out = np.full(int(ends[-1]), end_id, np.uint32)
                inside = np.ones(len(out), bool)
                inside[ends - 1] = False
                out[inside] = ids
                n = -(-size // max_tokens)
                doc = np.repeat(np.arange(rows), n)
                piece = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                start = piece * max_tokens
                length = np.minimum(max_tokens, size[doc] - start)
                at = (ends - size)[doc] + start
                raw = memoryview(out.astype("<u4")).cast("B")
                crc = [zlib.crc32(raw[4 * a : 4 * (a + k)]) for a, k in zip(at.tolist(), length.tolist(), strict=True)]
                columns = [b.column(0).take(pa.array(row + doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(at, len(out)).astype(np.int32)), pa.array(out.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=["id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(lean(run, f"words {tokenizer}"), schema)


Pattern = tuple[int, ...]


def candidate_patterns(have: np.ndarray, size: int, slack: int, per_length: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Patterns that fill ``size`` up to ``slack``, of what ``have`` counts by length: (lengths, copies), three columns each.

    All pairs, all of one length several times with another, and for each length up to ``per_length`` ways to fill up with
    two others; lengths that are left get new ways when the rest is fitted anew.
    """
    present = np.flatnonzero(have)
    present = present[present > 0]
    low = np.zeros(size + 1, np.int64)  # the largest present length of at most that many tokens, zero if there is none
    low[present[present <= size]] = present[present <= size]
    low = np.maximum.accumulate(low)
    lengths, copies = [np.zeros((0, 3), np.int64)], [np.zeros((0, 3), np.int64)]

    def add(keep: np.ndarray, *parts: tuple[np.ndarray, np.ndarray | int]) -> None:
        columns = [(np.broadcast_to(v, keep.shape)[keep], np.broadcast_to(k, keep.shape)[keep]) for v, k in parts]
        columns += [(np.zeros(int(keep.sum()), np.int64),) * 2] * (3 - len(columns))
        lengths.append(np.stack([v for v, _ in columns], axis=1))
        copies.append(np.stack([k for _, k in columns], axis=1))

    for a in present.tolist():
        # a k times, then the largest that fits, if that is another length
        k = np.arange(1, min(size // a, int(have[a])) + 1)
        b = low[size - k * a]
        rest = size - k * a - b
        add((rest <= slack) & (b == 0), (np.full_like(k, a), k))
        add((rest <= slack) & (b > 0) & (b != a) & ((k > 1) | (b < a)), (np.full_like(k, a), k), (b, 1))
        # a, b, c in falling order
        b = present[present < a]
        c = low[np.maximum(size - a - b, 0)]
        c = np.minimum(c, low[b - 1])
        fits = np.flatnonzero((c > 0) & (a + b + c <= size) & (size - a - b - c <= slack))
        if len(fits):
            pick = fits[np.unique(np.linspace(0, len(fits) - 1, per_length).astype(int))]
            add(np.ones(len(pick), bool), (np.full(len(pick), a), 1), (b[pick], 1), (c[pick], 1))
    return np.concatenate(lengths), np.concatenate(copies)


def fit_counts(lengths: np.ndarray, copies: np.ndarray, histogram: np.ndarray, tolerance: float = 1e-2, most: int = 300) -> np.ndarray:
    """Non-negative least squares for (pattern counts) x patterns = histogram, by accelerated projected gradient.

    It ends once no step would change the counts by more than ``tolerance`` of the largest one, or after ``most`` steps.
    """
    bins = len(histogram)
    scale = np.sqrt((copies.astype(float) ** 2).sum(axis=1))
    weight = copies / scale[:, None]
    where = [np.flatnonzero(copies[:, j]) for j in range(3)]

    def forward(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(lengths[at, j], x[at] * weight[at, j], bins) for j, at in enumerate(where))

    def backward(r: np.ndarray) -> np.ndarray:
        return (r[lengths] * weight).sum(axis=1)

    v = np.ones(len(lengths))
    norm = 1.0
    for _ in range(30):
        v = backward(forward(v / np.linalg.norm(v)))
        norm = np.linalg.norm(v)
    x = y = np.zeros(len(lengths))
    t = 1.0
    for _ in range(most):
        new = np.maximum(0, y - backward(forward(y) - histogram) / (1.05 * norm))
        step = np.abs(new - y).max()
        if (new - x) @ (y - new) > 0:
            t = 1.0  # the momentum points uphill: start it anew
        t, was = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        y, x = new + (was - 1) / t * (new - x), new
        if step <= tolerance * x.max():
            break
    return x / scale


def best_fit(histogram: np.ndarray, size: int, begun: dict[Pattern, int] | None = None) -> dict[Pattern, int]:
    """Best fit, longest first, on counts by length: a step places one length into many equal gaps at once.

    ``begun`` sequences come with gaps of their own.
    """
    gaps: list[dict[Pattern, int]] = [defaultdict(int) for _ in range(size + 1)]
    open_ = np.zeros(size + 1, np.int64)
    for pattern, n in (begun or {}).items():
        gaps[size - sum(pattern)][pattern] += n
        open_[size - sum(pattern)] += n
    for length in range(size, 0, -1):
        left = int(histogram[length])
        while left:
            fits = np.flatnonzero(open_[length:])
            if not len(fits):
                # as many to a fresh sequence as it holds
                each = min(size // length, left)
                n = left // each
                gaps[size - each * length][(length,) * each] += n
                open_[size - each * length] += n
                left -= n * each
                continue
            gap = int(fits[0]) + length
            pattern, n = gaps[gap].popitem()
            take = min(n, left)
            if n > take:
                gaps[gap][pattern] = n - take
            open_[gap] -= take
            gaps[gap - length][(*pattern, length)] += take
            open_[gap - length] += take
            left -= take
    out: dict[Pattern, int] = defaultdict(int)
    for g in gaps:
        for p, n in g.items():
            out[p] += n
    return out


def fitted_patterns(histogram: np.ndarray, size: int) -> tuple[dict[Pattern, int], np.ndarray]:
    """(pattern -> number of sequences, what is left of the histogram) by repeated fits.

    A fit's counts are rounded to the nearest whole number, the largest first, and cut to what is left of each length. The
    rest is fitted anew until no pattern is left; patterns without a gap come first, then those with a small one. Where
    all counts of a fit round to zero, as with few documents, patterns are taken once each in the order of their counts.
    """
    left, plan = histogram.astype(np.int64).copy(), defaultdict(int)
    left[0] = 0
    for slack in sorted({0, size // 256}):
        while len((fit := candidate_patterns(left, size, slack))[0]):
            lengths, copies = fit
            x = fit_counts(lengths, copies, left.astype(float))
            order = np.lexsort((-(lengths * copies).sum(axis=1), -x))
            counts = np.floor(x + 0.5).astype(np.int64)
            placed = 0
            for least in (0, 1):
                for i in order.tolist():
                    n = max(int(counts[i]), least)
                    if n < 1:
                        break
                    parts = [(v, k) for v, k in zip(lengths[i].tolist(), copies[i].tolist(), strict=True) if k]
                    n = min(n, *(int(left[v]) // k for v, k in parts))
                    if n > 0:
                        plan[tuple(v for v, k in parts for _ in range(k))] += n
                        placed += n
                        for v, k in parts:
                            left[v] -= n * k
                if placed:
                    break
    return plan, left


def plan_packing(histogram: np.ndarray, size: int) -> dict[Pattern, int]:
    """Pattern -> number of sequences, covering the histogram exactly: fitted patterns, then best fit for the rest."""
    plan, left = fitted_patterns(histogram, size)
    return dict(best_fit(left, size, plan))


def slot_table(plan: dict[Pattern, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted (length, first rank) with the first sequence and the offset of each run of slots."""
    taken: dict[int, int] = defaultdict(int)
    rows, base = [], 0
    for pattern, n in sorted(plan.items(), reverse=True):
        at = 0
        for length in pattern:
            rows.append((length, taken[length], base, at))
            taken[length] += n
            at += length
        base += n
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return table[:, 0], table[:, 1], table[:, 2], table[:, 3]


def pack_pieces(pieces: DataFrame, *, max_tokens: int = 2048) -> DataFrame:
    """``pieces`` (id, piece, length, ...) with ``sequence_id`` and ``offset``; no sequence is longer than ``max_tokens``.

    Repeated rows are packed one by one. ``pieces`` is read three times: pass a written table.
    """
    spark = pieces.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = pieces.withColumn("bucket", F.pmod(F.xxhash64("id", "piece"), F.lit(buckets)).cast("int"))
    counts = written(salted.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")), "packing-counts")
    histogram = np.zeros(max_tokens + 1, np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("n")).collect():  # max_tokens rows at most
        histogram[length] = n
    lengths, first, base, at = slot_table(plan_packing(histogram, max_tokens))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_rank"))
    own = Window.partitionBy("length", "bucket").orderBy("id", "piece")
    ranked = salted.withColumn("rank", F.row_number().over(own) - 1).join(offsets, ["length", "bucket"]).withColumn("rank", (F.col("rank") + F.col("first_rank")).cast("long"))
    ranked = ranked.select(*pieces.columns, "rank")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    # ranks start anew with each length: one sorted key for both
    span = np.int64(histogram.max(initial=0) + 1)
    key = lengths * span + first

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            slot = np.searchsorted(key, length * span + rank, "right") - 1
            columns = [*b.columns[:-1], pa.array(base[slot] + rank - first[slot]), pa.array(at[slot])]
            yield pa.RecordBatch.from_arrays(columns, names=[*b.schema.names[:-1], "sequence_id", "offset"])

    return ranked.mapInArrow(lean(place), schema)


def pack_documents(docs: DataFrame, *, tokenizer: str, max_tokens: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece of each document: ``id_col``, piece, start, length, ids_crc32[, ids], sequence_id, offset.

    A null or empty text is one piece that holds ``end_id`` alone. Null ids are packed like others. An empty table gives an
    empty result; other columns are not looked at.
    """
    pieces = written(token_pieces(docs, tokenizer=tokenizer, max_tokens=max_tokens, end_id=end_id, id_col=id_col, text_col=text_col, with_ids=with_ids), "packing-pieces")
    return pack_pieces(pieces, max_tokens=max_tokens).withColumnRenamed("id", id_col)
