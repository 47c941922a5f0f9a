"""Near-duplicates by similarity: documents whose sets of word shingles have a Jaccard similarity of a threshold or more.

SimHash by the generalised pigeonhole finds the tight groups. At a similarity of 0.8 fingerprints of 64 bits differ in
about ten, more than pigeonhole probes can reach at a bounded cost, so the looser links come from a prefix filter: sets in
one global order (hot shingles last, else by hash) whose similarity reaches the threshold share a shingle of their
prefixes. A bucket of one tight group says nothing new and goes; two bounds that never reject a true pair, on the sizes and
on the parity bits of the sets, thin the others to coarse links. Both kinds of links make coarse components. Their sets
are compared exactly, one with those not yet reached, never all pairs; a component too large for a task is compared in
chunks with its first member, and only members that this does not reach meet all chunks. Equal sets are one node. Shingles
stand for each other by 64-bit hashes of words under a key that is drawn for each run.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .memory import lean, lean_group
from .simhash import _local_stars, near_fingerprint_links
from .storage import checkpointed, discard, written
from .words import drawn_key, gram_hashes, mix, split_words, text_slices, whole_runs

#: Parity bits of a set: four for each shingle, a power of two within these bounds.
FEWEST_BITS, MOST_BITS = 512, 8192
#: Prefix shingles that one task holds, and coarse members that are broadcast to the texts.
SHARD_KEYS, BROADCAST_MEMBERS = 1_000_000, 200_000
#: Hot shingles are looked for in about so many documents; they only order the sets, no pair depends on them.
SAMPLE_DOCS, HOT_DOCS, HOT_SHINGLES = 10_000, 20, 100_000
#: Differing bits of fingerprints within a tight group, and shingles that one comparing task holds of a coarse component.
TIGHT_BITS, CHUNK_SHINGLES = 4, 2_000_000
ENTRY = np.dtype([("key", "<u8"), ("sig", "<i8"), ("tight", "<i8"), ("size", "<i4")])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(column: pa.Array | pa.ChunkedArray, shingle_words: int, key: bytes) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text under the run's key; a shorter text is one shingle, one without words has none."""
    for _, rows, data, offsets in text_slices(column):
        words = split_words(_LOWER[data], offsets)
        h = words.hashes(key)
        grams = gram_hashes(h, shingle_words)
        for i in range(rows):
            a, b = words.first[i], words.first[i + 1]
            if b - a >= shingle_words:
                yield np.unique(grams[a : b - shingle_words + 1])
            else:
                yield mix(gram_hashes(h[a:b], int(b - a)) + np.uint64(b - a)) if b > a else np.zeros(0, np.uint64)


def signature(s: np.ndarray) -> int:
    """One signed 64-bit name of a set; zero for the empty one."""
    return int(mix(s ^ np.uint64(0x51ED270B9F3C6A8D)).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0


def simhash(s: np.ndarray) -> int:
    """Signed 64-bit SimHash of a set: a bit is set if it is in over half of the shingles' hashes."""
    ones = np.unpackbits(mix(s).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(s)).tobytes(), "big", signed=True)


def parity(s: np.ndarray) -> np.ndarray:
    """Bits that tell whether an odd number of shingles falls on each; two sets differ in as many shingles at least as bits."""
    n = min(MOST_BITS, max(FEWEST_BITS, 1 << (4 * len(s) - 1).bit_length()))
    return np.packbits((np.bincount((s & np.uint64(n - 1)).astype(np.int64), minlength=n) & 1).astype(np.uint8)).view(np.uint64)


class Sketches:
    """Sizes and parity bits of sets; bits of different number are compared once the longer ones are folded."""

    def __init__(self, size: np.ndarray, bits: list[np.ndarray], t: Fraction):
        self.size, self.t = size, t
        words = np.array([len(b) for b in bits], np.int64)
        self.level = words
        self.rows: dict[int, np.ndarray] = {}
        longer = None
        for w in sorted({1 << k for k in range((FEWEST_BITS // 64).bit_length() - 1, (MOST_BITS // 64).bit_length())}, reverse=True):
            if longer is None and not (words >= w).any():
                continue
            here = np.zeros((len(bits), w), np.uint64)
            if longer is not None:
                here ^= longer[:, :w] ^ longer[:, w:]
            own = np.flatnonzero(words == w)
            if len(own):
                here[own] = np.stack([bits[i] for i in own])
            self.rows[w] = longer = here

    def near(self, a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
        """Whether the pairs a, b may reach the similarity: never false for one that does."""
        n, d = self.t.numerator, self.t.denominator
        x, y = self.size[a], self.size[b]
        ok = np.minimum(x, y) * d >= np.maximum(x, y) * n
        level = np.minimum(self.level[a], self.level[b])
        for w in np.unique(level[ok]).tolist():
            at = np.flatnonzero(ok & (level == w))
            other = b[at] if isinstance(b, np.ndarray) else b
            apart = np.bitwise_count(self.rows[w][a[at]] ^ self.rows[w][other]).sum(axis=1, dtype=np.int64)
            ok[at] = apart * (d + n) <= (x + y)[at] * (d - n)
        return ok


def _grow(count: int, near: Callable[[np.ndarray, int], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the groups of 0 .. count - 1: each step compares one with those not yet reached."""
    left, a, b = np.arange(count), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(left):
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            at = todo.pop()
            hit = near(left, at)
            if hit.any():
                todo.extend(left[hit].tolist())
                a.append(np.full(int(hit.sum()), at))
                b.append(left[hit])
                left = left[~hit]
    return np.concatenate(a), np.concatenate(b)


def exact_links(sets: list[np.ndarray], t: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Positions of sets, in links that span the same groups as all pairs of similarity ``t`` or more."""
    size = np.array([len(s) for s in sets], np.int64)
    sketches = Sketches(size, [parity(s) for s in sets], t)

    def near(left: np.ndarray, at: int) -> np.ndarray:
        ok = sketches.near(left, at)
        one = sets[at]
        for part in np.array_split(np.flatnonzero(ok), max(1, int(size[left[ok]].sum()) >> 20)):
            if len(part) and len(one):
                many = np.concatenate([sets[i] for i in left[part]])
                found = one[np.minimum(np.searchsorted(one, many), len(one) - 1)] == many
                n = size[left[part]]
                shared = np.add.reduceat(found, np.cumsum(n) - n, dtype=np.int64)
                ok[part] = shared * (t.denominator + t.numerator) >= (n + len(one)) * t.numerator
        return ok

    return _grow(len(sets), near)


def _pieces(b: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    return (b.slice(i, rows) for i in range(0, b.num_rows, rows))


def _heads(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return head, np.diff(np.append(head, len(key)))


def _hot_shingles(docs: DataFrame, shingle_words: int, key: bytes) -> np.ndarray:
    """Shingles found often in a sample; of bounded number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in shingle_sets(b.column(0), shingle_words, key):
                yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64))], names=["key"])

    n = docs.count()
    rows = docs.sample(min(1.0, SAMPLE_DOCS / max(n, 1)), seed=7).select("text").mapInArrow(lean(run), "key long")
    rows = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= HOT_DOCS).orderBy(F.desc("n"), "key").limit(HOT_SHINGLES)
    return np.sort(np.array([r.key for r in rows.collect()], np.int64).view(np.uint64))


def jaccard_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, similarity: float = 0.8) -> DataFrame:
    """(id, text_hash, least_id) for each row of ``docs`` with an id: the least id of its group.

    Groups are the components of all pairs of ``similarity`` or more. Letters A-Z are lower-cased, words are parted by
    white space, a text of fewer than ``shingle_words`` words is one shingle, and all texts without words are one group.
    ``text_hash`` is Spark's xxhash64 of the text and tells rows of one id apart.
    """
    t, run_key = Fraction(str(similarity)), drawn_key()
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    hot = docs.sparkSession.sparkContext.broadcast(_hot_shingles(texts, shingle_words, run_key))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = hot.value
        for b in itertools.chain.from_iterable(_pieces(b) for b in batches):
            sig, size, fp, prefix, bits = [], [], [], [], []
            for s in shingle_sets(b.column(2), shingle_words, run_key):
                late = last[np.minimum(np.searchsorted(last, s), len(last) - 1)] == s if len(last) else np.zeros(len(s), bool)
                keep = len(s) - -(-len(s) * t.numerator // t.denominator) + 1 if len(s) else 0
                sig.append(signature(s))
                size.append(len(s))
                fp.append(simhash(s))
                prefix.append(np.concatenate([s[~late], s[late]])[:keep].tobytes())
                bits.append(parity(s).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sig, pa.int64()), pa.array(size, pa.int64()), pa.array(fp, pa.int64()), pa.array(prefix, pa.binary()), pa.array(bits, pa.binary())], names=["id", "text_hash", "sig", "size", "fp", "prefix", "bits"])

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # entries are dealt to shards by key and packed, one row for each batch and shard
        for b in itertools.chain.from_iterable(_pieces(b, 2048) for b in batches):
            keys = [np.frombuffer(p, np.uint64) for p in b.column(3).to_pylist()]
            n = [len(k) for k in keys]
            entries = np.zeros(sum(n), ENTRY)
            entries["key"] = np.concatenate(keys)
            for i, name in enumerate(("sig", "tight", "size")):
                entries[name] = np.repeat(b.column(i).to_numpy(), n)
            shard = (mix(entries["key"]) % np.uint64(shards)).astype(np.int32)
            order = np.argsort(shard, kind="stable")
            head, _ = _heads(shard[order])
            blobs = [part.tobytes() for part in np.split(entries[order], head[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(shard[order][head]), pa.array(blobs, pa.binary())], names=["shard", "entries"])

    def meet(table: pa.Table) -> pa.Table:
        # a bucket holds sets of one prefix shingle that have a partner of like size and another tight group; it is named
        # by its members, so that equal buckets become one
        entries = np.frombuffer(b"".join(table.column("entries").to_pylist()), ENTRY)
        entries = entries[np.lexsort((entries["size"], entries["key"]))]
        key, size = entries["key"], entries["size"].astype(np.int64)
        near = (key[1:] == key[:-1]) & (size[:-1] * t.denominator >= size[1:] * t.numerator)
        # runs of like size, each next to the one before it
        run = np.concatenate([[0], np.cumsum(~near)])
        head, n = _heads(run)
        tight = entries["tight"]
        several = np.minimum.reduceat(tight, head) < np.maximum.reduceat(tight, head)
        paired = np.repeat(several, n)
        sig = entries["sig"]
        name = np.repeat(np.add.reduceat(mix(sig.view(np.uint64)), head).view(np.int64), n)
        rows = np.unique(np.stack([name[paired], sig[paired]], axis=1), axis=0)
        return pa.table({"bucket": rows[:, 0], "sig": rows[:, 1]})

    def thin(batches: Iterator[pa.RecordBatch], large: int = 64) -> Iterator[pa.RecordBatch]:
        for key, sig, size, packed in whole_runs(batches):
            key, sig = key.to_numpy(), sig.to_numpy()
            sketches = Sketches(size.to_numpy(), [np.frombuffer(p, np.uint64) for p in packed.to_pylist()], t)
            head, n = _heads(key)
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            small = np.flatnonzero(np.repeat(n <= large, n))
            k = key[small]
            for step in range(1, int(n[n <= large].max(initial=1))):
                same = np.flatnonzero(k[step:] == k[:-step])
                x, y = small[same], small[same + step]
                ok = sketches.near(x, y)
                a.append(sig[x[ok]])
                b.append(sig[y[ok]])
            for h, m in zip(head[n > large], n[n > large], strict=True):
                x, y = _grow(int(m), lambda left, at, h=h: sketches.near(h + left, int(h) + at))
                a.append(sig[h + x])
                b.append(sig[h + y])
            src, dst = _local_stars(np.concatenate(a), np.concatenate(b))
            yield pa.RecordBatch.from_pydict({"src": src, "dst": dst})

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, sig, text in whole_runs(batches):
            sig = sig.to_numpy()
            for h, m in zip(*_heads(unit.to_numpy()), strict=True):
                own, first = np.unique(sig[h : h + m], return_index=True)
                x, y = exact_links(list(shingle_sets(text.slice(h, m).take(pa.array(first)), shingle_words, run_key)), t)
                node, exact = _local_stars(own[x], own[y])
                if len(node):
                    yield pa.RecordBatch.from_pydict({"src": node, "dst": exact})

    described = written(texts.select("id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(lean(describe), "id long, text_hash long, sig long, size long, fp long, prefix binary, bits binary"), "similar-described")
    nodes = written(described.where("size > 0").groupBy("sig").agg(F.min_by(F.struct("id", "text_hash", "size", "fp", "prefix", "bits"), F.struct("id", "text_hash")).alias("one")).select("sig", "one.*"), "similar-nodes")
    rows = written(described.select("id", "text_hash", "sig"), "similar-rows")
    discard(described)  # prefixes and bits of equal sets are kept once, with the nodes
    by_print = nodes.groupBy("fp").agg(F.min("sig").alias("rep"))
    stars = connected_components(near_fingerprint_links(checkpointed(by_print), TIGHT_BITS))
    tight = by_print.join(stars, F.col("rep") == F.col("node"), "left").select("fp", F.coalesce("component", "rep").alias("tight"))
    named = checkpointed(nodes.select("sig", "fp").join(tight, "fp").select("sig", "tight"))
    keys = nodes.agg(F.sum(F.octet_length("prefix") / 8)).first()[0] or 0
    shards = int(keys) // SHARD_KEYS + int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = nodes.join(named, "sig").select("sig", "tight", "size", "prefix").mapInArrow(lean(explode), "shard int, entries binary").groupBy("shard").applyInArrow(lean_group(meet), "bucket long, sig long").distinct()
    thinned = met.join(nodes.select("sig", "size", "bits"), "sig").select("bucket", "sig", "size", "bits").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lean(thin), "src long, dst long")
    coarse = connected_components(thinned.unionByName(named.where("sig <> tight").select(F.col("sig").alias("src"), F.col("tight").alias("dst"))))
    members = coarse.select(F.col("node").alias("sig"), F.col("component").alias("coarse")).unionByName(coarse.select(F.col("component").alias("sig"), F.col("component").alias("coarse")).distinct())
    wanted = nodes.join(members, "sig").select("id", "text_hash", "sig", "coarse", "size")
    shares = wanted.groupBy("coarse").agg(F.ceil(F.sum("size") / CHUNK_SHINGLES).cast("int").alias("chunks"))
    placed = wanted.join(shares, "coarse").withColumn("chunk", F.pmod(F.xxhash64("sig"), "chunks").cast("int"))
    placed = checkpointed(placed.drop("size"))
    discard(nodes)
    placed = F.broadcast(placed) if placed.count() <= BROADCAST_MEMBERS else placed
    found = texts.withColumn("text_hash", F.xxhash64("text")).join(placed, ["id", "text_hash"])
    found = written(found.select("coarse", "chunks", "chunk", "sig", "text"), "similar-members")

    def links(rows: DataFrame) -> DataFrame:
        return checkpointed(rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(lean(compare), "src long, dst long"))

    # a coarse component is named by its least member, which goes along with every chunk
    everywhere = F.when(F.col("sig") == F.col("coarse"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array("chunk"))
    near = links(found.withColumn("part", F.explode(everywhere)).select(F.xxhash64("coarse", "part").alias("unit"), "sig", "text"))
    if found.where("chunks > 1").head(1):
        large = found.where("chunks > 1")
        reached = connected_components(near)
        known = large.select("coarse", "chunks", "sig").join(reached, F.col("sig") == F.col("node"), "left").withColumn("group", F.coalesce("component", "sig"))
        main = known.where("sig = coarse").select("coarse", F.col("group").alias("main"))
        strays = known.join(main, "coarse").where("group <> main").select("coarse", "chunks", "sig")
        blocks = F.xxhash64("coarse", F.pmod(F.xxhash64("sig", F.lit(1)), "chunks"))
        met_by = strays.withColumn("block", blocks).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        again = large.select("coarse", F.col("chunk").alias("part"), F.col("sig"), "text")
        units = met_by.select("coarse", "part", "block").distinct()
        first = met_by.join(large.select("sig", "text"), "sig").select(F.xxhash64("block", "part").alias("unit"), "sig", "text")
        second = again.join(units, ["coarse", "part"]).select(F.xxhash64("block", "part").alias("unit"), "sig", "text")
        near = near.unionByName(links(first.unionByName(second)))
    exact = connected_components(near)
    discard(found)
    groups = rows.join(exact, F.col("sig") == F.col("node"), "left").select("id", "text_hash", F.coalesce("component", "sig").alias("group"))
    least = groups.groupBy("group").agg(F.min("id").alias("least_id"))
    return groups.join(least, "group").select("id", "text_hash", "least_id")


def one_of_each_similar(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without those whose group holds a smaller id, columns unchanged. Rows with a null id stay."""
    groups = jaccard_components(docs, id_col=id_col, text_col=text_col, **options)
    extra = groups.where("id > least_id").select(F.col("id").alias("extra_id"), F.col("text_hash").alias("extra_hash")).distinct()
    return docs.join(extra, (docs[id_col].cast("long") == extra["extra_id"]) & (F.xxhash64(docs[text_col].cast("string")) == extra["extra_hash"]), "left_anti")
