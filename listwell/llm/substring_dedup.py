"""Substring deduplication by matching statistics on sharded FM-indexes.

Words covered by a window of ``min_words`` consecutive words go if the same window starts in a document with a smaller
id. Windows are judged on the input, so the first holder of a passage keeps it whole.

How it is spread: documents are dealt once into chunks by a hash of their id; three passes read that one exchange.

1. Each window is named by the least hash of the ``anchor_words``-grams in it (a minimizer). Equal windows have equal
   anchors. A chunk sends each distinct anchor once, with the number of its documents, so an anchor found in a third of
   all documents is one entry for each chunk. Anchors held by a single document cannot be part of a repeat and end here.
2. Stretches of windows under a shared anchor, once for each distinct stretch in a chunk, go to the shard of their anchor;
   under an anchor of very many documents each window goes alone, to the shard of its words. Every shard builds a
   compressed FM-index of its stretches and streams them through it: backward search gives the matching statistic of each
   place up to the threshold, and the least document id among the occurrences of the windows that reach it.
3. The answers go back to their chunks in the order of the stretches and mark the words.

Nothing is capped or sampled. Words stand for each other by 64-bit hashes under a key that is drawn for each run, so no text can
be made to collide and two given words collide with a chance of 2^-64; passages are compared word hash by word hash.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .memory import lean_group, lean_pair
from .words import drawn_key, gram_hashes, mix, pack, sliding_min, split_words, text_slices

_FAR = np.iinfo(np.int64).max
#: Text of a chunk and of a shard, which one task holds, and documents from which an anchor's windows go alone.
CHUNK_BYTES, SHARD_BYTES, HOT_DOCS = 64 << 20, 128 << 20, 4096


def _windows(column, min_words: int, anchor_words: int, key: bytes):
    """For each slice of texts: (first row, words, hashes, start of every valid window, its anchor)."""
    for row, rows, data, offsets in text_slices(column):
        words = split_words(data, offsets)
        h = words.hashes(key)
        anchors = sliding_min(gram_hashes(h, anchor_words), min_words - anchor_words + 1) if len(h) >= min_words else np.zeros(0, np.uint64)
        text = words.text_of
        valid = np.flatnonzero(text[: len(anchors)] == text[min_words - 1 : min_words - 1 + len(anchors)])
        yield row, rows, words, h, text, valid, anchors[valid]


def _ids(table: pa.Table) -> np.ndarray:
    return table.column("id").to_numpy().astype(np.int64, copy=False)


def _chunk_anchors(table: pa.Table, min_words: int, anchor_words: int, shards: int, key: bytes) -> pa.Table:
    """Distinct anchors of one chunk, by shard, with the number of its documents that hold them (to 65,535)."""
    ids, found = _ids(table), []
    for row, _, _, _, text, valid, anchors in _windows(table.column("text"), min_words, anchor_words, key):
        fresh = np.ones(len(valid), bool)
        fresh[1:] = (anchors[1:] != anchors[:-1]) | (text[valid[1:]] != text[valid[:-1]])
        found.append((anchors[fresh], row + text[valid[fresh]]))
    anchor = np.concatenate([a for a, _ in found]) if found else np.zeros(0, np.uint64)
    text = np.concatenate([t for _, t in found]) if found else np.zeros(0, np.int64)
    doc = ids[text]
    order = np.lexsort((doc, anchor))
    anchor, doc = anchor[order], doc[order]
    first, fresh = np.ones(len(anchor), bool), np.ones(len(anchor), bool)
    first[1:] = anchor[1:] != anchor[:-1]
    fresh[1:] = first[1:] | (doc[1:] != doc[:-1])
    at = np.flatnonzero(first)
    docs = np.minimum(np.add.reduceat(fresh, at, dtype=np.int64), 65_535).astype(np.uint16) if len(at) else np.zeros(0, np.uint16)
    anchor = anchor[at]
    shard = (anchor % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.arange(shards + 1))
    full = np.flatnonzero(np.diff(cuts))
    pick = [order[cuts[s] : cuts[s + 1]] for s in full]
    chunk = table.column("chunk")[0].as_py()
    return pa.table({
        "shard": pa.array(full, pa.int32()), "chunk": pa.array([chunk] * len(full), pa.int32()),
        "anchors": pa.array([pack(anchor[p]) for p in pick], pa.binary()), "docs": pa.array([pack(docs[p]) for p in pick], pa.binary()),
    })


def _shared_anchors(table: pa.Table) -> pa.Table:
    """Of one shard's anchors, those in two documents or more, back to each chunk that sent them, with marks for hot ones."""
    sent = [np.frombuffer(b, np.uint64) for b in table.column("anchors").to_pylist()]
    docs = np.concatenate([np.frombuffer(b, np.uint16) for b in table.column("docs").to_pylist()])
    _, back = np.unique(np.concatenate(sent), return_inverse=True)
    count = np.bincount(back, docs).astype(np.int64)[back]
    cuts = np.cumsum([0, *map(len, sent)])
    parts = [(a[n > 1], n[n > 1] > HOT_DOCS) for a, n in ((a, count[cuts[i] : cuts[i + 1]]) for i, a in enumerate(sent))]
    full = [i for i, (a, _) in enumerate(parts) if len(a)]
    chunk = table.column("chunk").to_numpy()
    return pa.table({
        "chunk": pa.array(chunk[full], pa.int32()), "shard": pa.array([table.column("shard")[0].as_py()] * len(full), pa.int32()),
        "blob": pa.array([pack(parts[i][0]) for i in full], pa.binary()), "hot": pa.array([pack(parts[i][1]) for i in full], pa.binary()),
    })


class _Stretches:
    """Distinct stretches of one chunk under shared anchors, ordered by shard; the same on every call."""

    def __init__(self, table: pa.Table, shared: np.ndarray, hot: np.ndarray, min_words: int, anchor_words: int, shards: int, key: bytes):
        ids, parts = _ids(table), []
        for row, _, words, h, text, valid, anchors in _windows(table.column("text"), min_words, anchor_words, key):
            at = np.searchsorted(shared, anchors)
            hit = np.flatnonzero(shared[np.minimum(at, len(shared) - 1)] == anchors) if len(shared) else np.zeros(0, np.int64)
            start, anchor, alone = valid[hit], anchors[hit], hot[at[hit]]
            new = alone.copy()
            new[:1] = True
            new[1:] |= (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1) | (text[start[1:]] != text[start[:-1]])
            head = np.flatnonzero(new)
            n = np.diff(np.append(head, len(hit)))  # windows in each stretch
            begin, length = start[head], n + min_words - 1
            inner = np.repeat(begin - np.cumsum(length) + length, length) + np.arange(int(length.sum()))
            # position in the text's own words, and the text's row in the chunk
            parts.append((anchor[head], n, begin - words.first[text[begin]], row + text[begin], h[inner], alone[head]))
        cat = lambda i, kind: np.concatenate([p[i] for p in parts]).astype(kind, copy=False) if parts else np.zeros(0, kind)
        anchor, self.n, self.begin, self.row, word, alone = cat(0, np.uint64), cat(1, np.int64), cat(2, np.int64), cat(3, np.int64), cat(4, np.uint64), cat(5, bool)
        length = self.n + min_words - 1
        self.doc = ids[self.row]
        cuts = np.concatenate([[0], np.cumsum(length)])
        content = _content_key(word, cuts, length)
        shard = (np.where(alone, content, anchor) % np.uint64(shards)).astype(np.int64)
        # one of each distinct content, in the order of (shard, key)
        order = np.lexsort((self.doc, content, shard))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (shard[order][1:] != shard[order][:-1]) | _content_changes(content, word, cuts, length, order)
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(fresh) - 1
        one = order[fresh]
        self.shard, self.windows, self.least = shard[one], self.n[one], self.doc[one]
        self.length = length[one]
        inner = np.repeat(cuts[one] - np.cumsum(self.length) + self.length, self.length) + np.arange(int(self.length.sum()))
        self.words = word[inner]


def _content_key(word: np.ndarray, cuts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hash of each stretch's word sequence."""
    if not len(length):
        return np.zeros(0, np.uint64)
    place = np.arange(len(word)) - np.repeat(cuts[:-1], length)
    return mix(np.add.reduceat(mix(word + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), cuts[:-1]) + length.astype(np.uint64))


def _content_changes(key: np.ndarray, word: np.ndarray, cuts: np.ndarray, length: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Whether each stretch, in ``order``, differs from the one before it: by its key, or else by its words."""
    a, b = order[:-1], order[1:]
    changes = key[a] != key[b]
    same = np.flatnonzero(~changes)
    differ = length[a[same]] != length[b[same]]
    changes[same[differ]] = True
    same = same[~differ]
    n = length[a[same]]
    inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    unequal = word[np.repeat(cuts[a[same]], n) + inner] != word[np.repeat(cuts[b[same]], n) + inner]
    if unequal.any():
        changes[np.repeat(same, n)[unequal]] = True
    return changes


def _shared_of(extra: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Shared anchors of a chunk in order, and marks for hot ones."""
    anchors = [(np.frombuffer(b, np.uint64), np.frombuffer(h, bool)) for b, h, d in zip(*(extra.column(c).to_pylist() for c in ("blob", "hot", "answer")), strict=True) if not d]
    anchor = np.concatenate([np.zeros(0, np.uint64), *(a for a, _ in anchors)])
    order = np.argsort(anchor)
    return anchor[order], np.concatenate([np.zeros(0, bool), *(h for _, h in anchors)])[order]


_STRETCH_SCHEMA = "shard int, chunk int, words binary, ids binary, lengths binary, least binary"


def _chunk_stretches(table: pa.Table, extra: pa.Table, min_words: int, anchor_words: int, shards: int, key: bytes) -> pa.Table:
    rows = {k: [] for k in ("shard", "chunk", "words", "ids", "lengths", "least")}
    if table.num_rows and extra.num_rows:
        s = _Stretches(table, *_shared_of(extra), min_words, anchor_words, shards, key)
        cuts, ends = np.searchsorted(s.shard, np.arange(shards + 1)), np.concatenate([[0], np.cumsum(s.length)])
        for shard in np.flatnonzero(np.diff(cuts)):
            a, b = cuts[shard], cuts[shard + 1]
            values, ids = np.unique(s.words[ends[a] : ends[b]], return_inverse=True)
            rows["shard"].append(int(shard))
            rows["chunk"].append(table.column("chunk")[0].as_py())
            rows["words"].append(pack(values))
            rows["ids"].append(pack(ids.astype(np.uint16 if len(values) <= 1 << 16 else np.uint32)))
            rows["lengths"].append(pack(s.length[a:b].astype(np.uint32)))
            rows["least"].append(pack(s.least[a:b]))
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
    return pa.table({k: pa.array(v, t) for (k, v), t in zip(rows.items(), kinds, strict=True)})


def _search_shard(table: pa.Table, min_words: int) -> pa.Table:
    """Build the shard's FM-index, stream its stretches through it, answer each chunk in its own order."""
    from .fm_index import FMIndex

    words = [np.frombuffer(b, np.uint64) for b in table.column("words").to_pylist()]
    values, back = np.unique(np.concatenate(words), return_inverse=True)
    at, ids = 0, []
    for w, b in zip(words, table.column("ids").to_pylist(), strict=True):
        ids.append(back[at : at + len(w)][np.frombuffer(b, np.uint16 if len(w) <= 1 << 16 else np.uint32)])
        at += len(w)
    ids = np.concatenate(ids) + 1
    sent = [np.frombuffer(b, np.uint32).astype(np.int64) for b in table.column("lengths").to_pylist()]
    length, least = np.concatenate(sent), np.concatenate([np.frombuffer(b, np.int64) for b in table.column("least").to_pylist()])
    cuts = np.concatenate([[0], np.cumsum(length)])
    key = _content_key(values[ids - 1], cuts, length)
    order = np.lexsort((least, key))
    fresh = np.ones(len(order), bool)
    fresh[1:] = _content_changes(key, ids, cuts, length, order)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(fresh) - 1
    one = order[fresh]
    n = length[one]
    # distinct stretches back to back, each closed by id 0
    begin = np.cumsum(n + 1) - n - 1
    text = np.zeros(int((n + 1).sum()), np.int64)
    inside = np.ones(len(text), bool)
    inside[begin + n] = False
    text[inside] = ids[np.repeat(cuts[one] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]
    per = n - min_words + 1
    starts = np.repeat(begin - np.cumsum(per) + per, per) + np.arange(int(per.sum()))
    index = FMIndex(text, len(values) + 1, min_words, np.repeat(np.arange(len(n)), n + 1))
    # a window found once is that of its own stretch
    best = np.minimum(index.window_minimum(text, starts, min_words, least[one]), np.repeat(least[one], per))
    edge = np.concatenate([[0], np.cumsum(per)])
    blobs, at = [], 0
    for lengths in sent:
        w = which[at : at + len(lengths)]
        p = per[w]
        blobs.append(pack(best[np.repeat(edge[w] - np.cumsum(p) + p, p) + np.arange(int(p.sum()))]))
        at += len(lengths)
    return pa.table({"chunk": table.column("chunk").cast(pa.int32()), "shard": table.column("shard").cast(pa.int32()), "blob": pa.array(blobs, pa.binary()), "hot": pa.nulls(len(blobs), pa.binary())})


_RESULT_SCHEMA = "id long, n_words long, n_removed long, kept_text string, removed array<struct<start:int,end:int>>, kept_sha256 string"


def _apply(table: pa.Table, extra: pa.Table, min_words: int, anchor_words: int, shards: int, key: bytes, with_text: bool) -> pa.Table:
    """Mark the covered words of one chunk's documents and render what is left."""
    kinds = {"id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept_text": pa.string(), "removed": pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), "kept_sha256": pa.string()}
    if not table.num_rows:
        return pa.table({k: pa.array([], t) for k, t in kinds.items()} | {"rest": pa.array([], table.schema.field("rest").type)})
    ids, covers = _ids(table), {}
    if extra.num_rows:
        s = _Stretches(table, *_shared_of(extra), min_words, anchor_words, shards, key)
        answers = sorted((sh, b) for sh, b, d in zip(extra.column("shard").to_pylist(), extra.column("blob").to_pylist(), extra.column("answer").to_pylist(), strict=True) if d)
        best = np.concatenate([np.frombuffer(b, np.int64) for _, b in answers]) if answers else np.zeros(0, np.int64)
        edge = np.concatenate([[0], np.cumsum(s.windows)])
        n, w = s.n, s.which
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        gone = best[np.repeat(edge[w], n) + inner] < np.repeat(s.doc, n)
        row, start = np.repeat(s.row, n)[gone], (np.repeat(s.begin, n) + inner)[gone]
        order = np.argsort(row, kind="stable")
        row, start = row[order], start[order]
        at = np.flatnonzero(np.diff(row, prepend=-1))
        covers = {int(row[a]): start[a:b] for a, b in itertools.pairwise(np.append(at, len(row)))}
    out = {k: [] for k in kinds}
    for i, text in enumerate(table.column("text").cast(pa.binary()).to_pylist() if table.num_rows else []):
        words = (text or b"").split()  # bytes.split() parts at exactly the six separators
        n, removed, spans = len(words), 0, []
        if i in covers:
            edges = np.zeros(n + 1, np.int64)
            np.add.at(edges, covers[i], 1)
            np.add.at(edges, covers[i] + min_words, -1)
            gone = np.cumsum(edges[:-1]) > 0
            removed = int(gone.sum())
            turn = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
            spans = [{"start": int(a), "end": int(b)} for a, b in zip(turn[::2], turn[1::2], strict=True)]
            words = [words[j] for j in np.flatnonzero(~gone)]
        kept = b" ".join(words)
        shown = None if not with_text else kept.decode() if removed else text and text.decode()
        for k, v in zip(kinds, (int(ids[i]), n, removed, shown, spans, hashlib.sha256(kept).hexdigest()), strict=True):
            out[k].append(v)
    return pa.table({k: pa.array(v, kinds[k]) for k, v in out.items()} | {"rest": table.column("rest")})


def substring_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = 13, anchor_words: int = 4, chunks: int | None = None, shards: int | None = None, with_text: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``id_col``, ``n_words``, ``n_removed``, ``kept_text`` (the text itself where nothing goes, else the
    kept words joined by one space), ``removed`` (word spans), ``kept_sha256`` (of the kept words joined by one space), and
    ``rest``: a struct of the ``carry`` columns.

    ``chunks`` and ``shards``, each held by one task, are by default as many as their bytes ask for, at least the session's
    shuffle partitions. Null and empty texts have no words. Rows with a null id are
    compared with nothing and keep all their words. Rows that repeat an id count as one document that occurs twice:
    they take nothing from each other. ``with_text=False`` leaves ``kept_text`` null. An empty table gives an empty result; columns other than id and text are
    not looked at, whatever their names.
    """
    if not 1 <= anchor_words <= min_words:
        raise ValueError("anchor_words must be from 1 to min_words")
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0 if not (chunks and shards) else 0
    n, m = chunks or max(least, -(-int(held) // CHUNK_BYTES)), shards or max(least, -(-int(held) // SHARD_BYTES))
    args = (min_words, anchor_words, m, drawn_key())
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.struct(*(F.col(f"`{c}`") for c in carry) if carry else [F.lit(0).alias("none")]).alias("rest"))
    dealt = rows.where("id is not null").withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")).repartition(n, "chunk")
    anchors = dealt.groupBy("chunk").applyInArrow(lean_group(lambda t: _chunk_anchors(t, *args)), "shard int, chunk int, anchors binary, docs binary")
    shared = anchors.groupBy("shard").applyInArrow(lean_group(_shared_anchors), "chunk int, shard int, blob binary, hot binary").withColumn("answer", F.lit(False))
    stretches = dealt.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(lean_pair(lambda t, e: _chunk_stretches(t, e, *args)), _STRETCH_SCHEMA)
    answers = stretches.groupBy("shard").applyInArrow(lean_group(lambda t: _search_shard(t, min_words)), "chunk int, shard int, blob binary, hot binary").withColumn("answer", F.lit(True))
    schema = StructType([*StructType.fromDDL(_RESULT_SCHEMA), rows.schema["rest"]])
    out = dealt.groupBy("chunk").cogroup(shared.unionByName(answers).groupBy("chunk")).applyInArrow(lean_pair(lambda t, e: _apply(t, e, *args, with_text)), schema)
    alone = rows.where("id is null").mapInArrow(lambda it: _unmatched(it, *args, with_text), schema)
    return out.unionByName(alone).withColumnRenamed("id", id_col)


def _unmatched(batches: Iterator[pa.RecordBatch], *args) -> Iterator[pa.RecordBatch]:
    """Rows with a null id, which nothing is compared with."""
    for b in batches:
        if b.num_rows:
            zero = pa.table([pa.array(np.zeros(b.num_rows, np.int64)), b.column(1), b.column(2)], names=["id", "text", "rest"])
            yield from _apply(zero, pa.table({"none": []}), *args).set_column(0, "id", pa.nulls(b.num_rows, pa.int64())).to_batches()


def without_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", **options) -> DataFrame:
    """``docs`` with repeated passages cut from the texts, columns in their order; ``length_col`` follows the new text.

    Documents that lose all their words go; those that had none stay.
    """
    carry = tuple(c for c in docs.columns if c not in (id_col, text_col))
    cut = substring_dedup(docs, id_col=id_col, text_col=text_col, carry=carry, **options).where("n_removed < n_words OR n_words = 0")
    length = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col(f"rest.`{length_col}`")) if length_col in carry else None
    value = {id_col: F.col(id_col), text_col: F.col("kept_text"), length_col: length}
    return cut.select(*((value[c] if value.get(c) is not None else F.col(f"rest.`{c}`")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns))
