"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints of 64 bits link at ``distance`` or fewer differing bits. Their bits are grouped into parts, correlated bits
together; the parts get thresholds t of -1, 0, 1, ... whose (t + 1) sum to distance + 1, so any linked pair agrees within
the threshold of some part. Dynamic programming picks the thresholds, and the number of parts, of least estimated cost;
the estimates come from bit counts over all fingerprints. A part of threshold t is probed once for each way of masking t
of its bits. Fingerprints that meet in a bucket are verified by their full distance. Buckets hold distinct fingerprints
only and give back a spanning star for each group that they link, never all pairs.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .memory import lean
from .storage import checkpointed
from .words import mix, whole_runs

BITS = 64
#: Relative cost of a row that is shuffled and of a pair that is verified.
ROW_COST, PAIR_COST = 2000.0, 2.0
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_LANE = np.arange(8) * 256


def fingerprint(text: bytes, shingle_words: int, seed: int = 42) -> int:
    """SimHash of one text: a bit is set if it is in over half of the shingles' XXH64; no words give zero."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(joined, seed)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = len(words) - shingle_words + 1
    digest = xxhash.xxh64_digest
    found = np.frombuffer(b"".join([digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[shingle_words - 1 :].tolist(), strict=True)]), np.uint8).reshape(n, 8)
    ones = np.einsum("lb,bk->lk", np.bincount((found + _LANE).ravel(), minlength=2048).reshape(8, 256), _BYTE_BITS).ravel() if n > 400 else np.unpackbits(found, axis=1).sum(axis=0)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def simhash_fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, seed: int = 42) -> DataFrame:
    """(id, fp) for each document; fp holds the bits of the unsigned fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.array([fingerprint(t.as_py() or b"", shingle_words, seed) for t in b.column(1).cast(pa.binary())], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found.view(np.int64))], names=["id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(lean(run), "id long, fp long")


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how often each two bits are set together: 64 x 64 sums, whatever the input's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for b in batches:
            bits = np.unpackbits(b.column(0).to_numpy().astype(">i8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.float64)
            total += bits.T @ bits
            n += len(bits)
        if n:
            yield pa.RecordBatch.from_pydict({"at": np.arange(BITS * BITS + 1), "n": np.append(total.ravel(), n).astype(np.int64)})

    rows = fps.select("fp").mapInArrow(lean(run), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(BITS * BITS + 1)
    for at, n in rows:
        flat[at] = n
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def group_bits(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of about equal size; each grows by the bit most correlated with those it has."""
    p = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    link = np.abs((together / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(link, 0)
    free, out = set(range(BITS)), []
    for i in range(parts):
        size = BITS // parts + (i < BITS % parts)
        left = sorted(free)
        group = [max(left, key=lambda b: (link[b, left].sum(), -b))]
        free.discard(group[0])
        while len(group) < size:
            best = max(sorted(free), key=lambda b: (link[b, group].sum(), -b))
            group.append(best)
            free.discard(best)
        out.append(group)
    return out


def allocate(n: int, together: np.ndarray, distance: int) -> list[tuple[list[int], int]]:
    """Parts and thresholds of least estimated cost: (bits, threshold of 0 or more) for each part that is probed."""
    p = np.diag(together) / max(n, 1)
    same = p**2 + (1 - p) ** 2
    best: tuple[float, list] = (math.inf, [])
    for parts in range(1, distance + 2):
        groups = group_bits(n, together, parts)
        cost = np.full((parts, distance + 2), math.inf)
        for i, g in enumerate(groups):
            for budget in range(distance + 2):
                if budget == 0:
                    cost[i, 0] = 0
                elif len(g) >= budget:
                    masks = math.comb(len(g), budget - 1)
                    agree = float(np.prod(same[g])) / float(np.mean(same[g])) ** (budget - 1)
                    cost[i, budget] = masks * (max(n, 1) * ROW_COST + n * n / 2 * agree * PAIR_COST)
        table = {0: (0.0, [])}
        for i in range(parts):
            table = {
                total: min(((table[a][0] + cost[i, total - a], [*table[a][1], total - a]) for a in table if a <= total), key=lambda x: x[0])
                for total in range(distance + 2)
                if any(a <= total for a in table)
            }
        total, budgets = table[distance + 1]
        if total < best[0]:
            best = (total, [(g, b - 1) for g, b in zip(groups, budgets, strict=True) if b])
    return best[1]


def _masks(plan: list[tuple[list[int], int]]) -> np.ndarray:
    """Bits that must agree, one mask for each probe; bit 0 of a group is the fingerprint's highest."""
    value = lambda bits: sum(1 << (BITS - 1 - b) for b in bits)
    return np.array([value(set(g) - set(drop)) for g, t in plan for drop in itertools.combinations(g, t)], np.uint64)


def _local_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Components of the links a-b as (node, least node), without the least nodes themselves."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


def _grow(fp: np.ndarray, rep: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the groups of one large bucket: each step compares one fingerprint with those not yet reached."""
    left, a, b = np.arange(len(fp)), [], []
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            at = todo.pop()
            near = np.bitwise_count(fp[left] ^ fp[at]) <= distance
            if near.any():
                hit, left = left[near], left[~near]
                todo.extend(hit.tolist())
                a.append(np.full(len(hit), rep[at]))
                b.append(rep[hit])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _verify(key: np.ndarray, rep: np.ndarray, fp: np.ndarray, distance: int, large: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Links within whole buckets, sorted by key."""
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.append(head, len(key)))
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    small = np.repeat(size <= large, size)
    k, r, f = key[small], rep[small], fp[small]
    for step in range(1, int(size[size <= large].max(initial=1))):
        same = np.flatnonzero(k[step:] == k[:-step])
        near = same[np.bitwise_count(f[same] ^ f[same + step]) <= distance]
        a.append(r[near])
        b.append(r[near + step])
    for h, n in zip(head[size > large], size[size > large], strict=True):
        x, y = _grow(fp[h : h + n], rep[h : h + n], distance)
        a.append(x)
        b.append(y)
    return _local_stars(np.concatenate(a), np.concatenate(b))


def near_fingerprint_links(reps: DataFrame, distance: int) -> DataFrame:
    """(src, dst) links that connect the same groups as all pairs of ``reps`` (fp, rep) within the distance."""
    n, together = bit_counts(reps)
    masks = _masks(allocate(n, together, distance))
    salts = np.arange(len(masks), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(1).to_numpy().view(np.uint64)
            for i, mask in enumerate(masks):
                key = mix((fp & mask) + salts[i]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), *b.columns], names=["key", "rep", "fp"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in whole_runs(batches):
            key, rep, fp = (c.to_numpy() for c in columns)
            src, dst = _verify(key, rep, fp.view(np.uint64), distance)
            yield pa.RecordBatch.from_pydict({"src": src, "dst": dst})

    return reps.select("rep", "fp").mapInArrow(lean(probe), "key long, rep long, fp long").repartition("key").sortWithinPartitions("key").mapInArrow(lean(verify), "src long, dst long")


def simhash_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, distance: int = 4, seed: int = 42) -> DataFrame:
    """One row per document: ``id_col``, ``fingerprint`` (16 hex digits), ``component_id`` (least id reachable over links).

    Letters A-Z are lower-cased, a shingle is ``shingle_words`` words joined by a space, shorter texts are one shingle and
    texts without words, null or empty, have fingerprint zero and link like any other. Repeated rows give repeated rows. A
    row with a null id has its own fingerprint and a null component unless a document with an id shares or nears its
    fingerprint. An empty table gives an empty result. Other columns are not looked at.
    """
    fps = checkpointed(simhash_fingerprints(docs, id_col=id_col, text_col=text_col, shingle_words=shingle_words, seed=seed))
    reps = checkpointed(fps.where("id is not null").groupBy("fp").agg(F.min("id").alias("rep")))
    stars = connected_components(near_fingerprint_links(reps, distance))
    groups = reps.join(stars, reps["rep"] == stars["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(groups, "fp", "left").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
