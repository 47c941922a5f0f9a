"""Exact ranked search for items among all documents, scoring each class of equal bags once.

What a score needs of a document is its counts of the items' terms and m, which follows from its length. Documents are cut
down to the items' vocabulary; those with the same counts and the same m are one class, found by hash and verified by
their bytes in the grouping itself. Classes are scored, not documents; the best classes of an item are then expanded into
their members by ascending id. A class is never held whole: only its k least ids can be asked for.

Items come in blocks of bounded size, whose vocabulary and postings travel to the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .memory import lean
from .storage import written
from .words import drawn_key, keyed_hashes, same_spans, split_words, text_slices

#: Distinct terms of all items of a block, and their bytes; an item is never parted.
BLOCK_TERMS, BLOCK_BYTES = 100_000, 4 << 20
#: Scores of one block of classes by items that are held at once.
SCORES_AT_ONCE = 4 << 20
#: Terms in Java's and RE2's syntax: all but ASCII characters that are no letters or digits.
TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_APART = np.zeros(256, bool)
_APART[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
#: Scores are whole numbers below this, so that doubles hold them.
_EXACT = 1 << 53


def item_terms(text: Column) -> Column:
    """The distinct terms of a text; none of a null one."""
    return F.array_distinct(F.regexp_extract_all(F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER), F.lit(TERMS), F.lit(0)))


@dataclass(frozen=True)
class Items:
    """A block of items: sorted hashes of its vocabulary with the terms' bytes, and the items that hold each term."""

    ids: list[int | None]
    key: bytes
    hashes: np.ndarray
    data: np.ndarray
    bounds: np.ndarray
    first: np.ndarray  # where each term's items begin in ``holders``, one more at the end
    holders: np.ndarray

    @staticmethod
    def of(rows: list[tuple[int | None, list[str]]]) -> Items:
        terms = sorted({t for _, ts in rows for t in ts})
        number = {t: i for i, t in enumerate(terms)}
        pairs = np.array(sorted((number[t], i) for i, (_, ts) in enumerate(rows) for t in ts), np.int64).reshape(-1, 2)
        raw = [t.encode() for t in terms]
        data, bounds = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
        while True:
            # a key under which no two terms collide, so that a term has one place to be looked for
            key = drawn_key()
            hashes = keyed_hashes(data, bounds[:-1], bounds[1:], key)
            if len(np.unique(hashes)) == len(terms):
                break
        order = np.argsort(hashes)
        place = np.empty(len(terms), np.int64)
        place[order] = np.arange(len(terms))
        spans = [raw[i] for i in order.tolist()]
        pairs = pairs[np.lexsort((pairs[:, 1], place[pairs[:, 0]]))]
        first = np.searchsorted(place[pairs[:, 0]], np.arange(len(terms) + 1))
        return Items([i for i, _ in rows], key, hashes[order], np.frombuffer(b"".join(spans), np.uint8), np.cumsum([0, *map(len, spans)]), first, pairs[:, 1].astype(np.int32))

    def terms_of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of the vocabulary's term that each span is, -1 for none: by hash, then byte by byte."""
        h = keyed_hashes(data, starts, ends, self.key)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == h)
        both = np.concatenate([data, self.data])
        a, b = np.concatenate([starts[hit], self.bounds[:-1] + len(data)]), np.concatenate([ends[hit], self.bounds[1:] + len(data)])
        same = same_spans(both, a, b, np.arange(len(hit)), at[hit] + len(hit))
        out = np.full(len(starts), -1, np.int64)
        out[hit[same]] = at[hit[same]]
        return out


def item_blocks(items: DataFrame, *, id_col: str, text_col: str) -> Iterator[Items]:
    """The items that have terms, block by block; rows of one id are one item."""
    one = items.select(F.col(id_col).cast("long").alias("id"), F.explode(item_terms(F.col(text_col))).alias("term")).distinct()
    one = one.groupBy("id").agg(F.collect_list("term").alias("terms"))  # the terms of one item
    kept = written(one.withColumn("bytes", F.aggregate("terms", F.lit(0), lambda n, t: n + F.octet_length(t))), "search-items")
    terms, size = kept.agg(F.sum(F.size("terms")), F.sum("bytes")).first()
    if not terms:
        return
    n = max(math.ceil(terms / BLOCK_TERMS), math.ceil(size / BLOCK_BYTES))
    for block in range(n):
        rows = kept.where(F.pmod(F.xxhash64("id"), F.lit(n)) == block).select("id", "terms").collect()  # about BLOCK_TERMS, BLOCK_BYTES
        if rows:
            yield Items.of([(r.id, r.terms) for r in rows])


def document_bags(docs: DataFrame, items: Items, *, id_col: str, text_col: str) -> DataFrame:
    """(id, n, bag) of each document with terms: how many it has, and (term, count) of those of the items by term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = len(items.hashes)
        for b in batches:
            for row, rows, data, offsets in text_slices(b.column(1)):
                words = split_words(_FOLD[data], offsets, _APART)
                term = items.terms_of(words.data, words.starts, words.ends)
                known = term >= 0
                pair, count = np.unique(words.text_of[known] * vocabulary + term[known], return_counts=True)
                bag = np.stack([pair % vocabulary, count], axis=1).astype("<i4")
                ends = np.concatenate([[0], np.searchsorted(pair, (np.arange(rows) + 1) * vocabulary)]).astype(np.int32) * 8
                kept = pa.array(words.counts > 0)
                bags = pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(bag.tobytes())])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(row, rows), pa.array(words.counts), bags], names=["id", "n", "bag"]).filter(kept)

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(lean(run), "id long, n long, bag binary")


def _entries(bags: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, count) of all bags of a column."""
    size = np.diff(np.frombuffer(bags.buffers()[1], np.int32)[bags.offset : bags.offset + len(bags) + 1]) // 8
    begin = int(np.frombuffer(bags.buffers()[1], np.int32)[bags.offset]) if len(bags) else 0
    flat = np.frombuffer(bags.buffers()[2], "<i4", int(size.sum()) * 2, begin).reshape(-1, 2) if size.sum() else np.zeros((0, 2), np.int32)
    return np.repeat(np.arange(len(bags)), size), flat[:, 0].astype(np.int64), flat[:, 1].astype(np.int64)


def corpus_counts(bags: DataFrame, vocabulary: int) -> tuple[int, int, np.ndarray]:
    """(documents with terms, all their terms, documents by vocabulary term)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary + 2, np.int64)
        for b in batches:
            total[:2] += b.num_rows, b.column(0).to_numpy().sum()
            total[2:] += np.bincount(_entries(b.column(1))[1], minlength=vocabulary)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    out = np.zeros(vocabulary + 2, np.int64)
    for at, n in bags.select("n", "bag").mapInArrow(lean(run), "at long, n long").groupBy("at").agg(F.sum("n")).collect():  # vocabulary of a block
        out[at] = n
    return int(out[0]), int(out[1]), out[2:]


def bag_classes(bags: DataFrame, documents: int, terms: int, k: int) -> DataFrame:
    """(bag, m, members): classes of documents with equal bags and m, with their k least ids in order, nulls last.

    The k least ids are picked before the shuffle and after it, so no task holds all members of a class.
    """
    some = bags.where(F.octet_length("bag") > 0).withColumn("m", F.expr(f"10 + (90 * n * {documents}L) div {terms}L"))
    order = Window.partitionBy("hash", "m", "bag").orderBy(F.col("id").asc_nulls_last())
    least = some.select(F.xxhash64("bag", "m").alias("hash"), "m", "bag", "id").withColumn("at", F.row_number().over(order)).where(F.col("at") <= k)
    member = F.struct(F.col("id").isNull().alias("none"), "id")
    return least.groupBy("hash", "m", "bag").agg(F.sort_array(F.collect_list(member)).alias("members")).select("bag", "m", "members")  # k at most


def class_scores(classes: DataFrame, items: Items, weights: np.ndarray, k: int) -> DataFrame:
    """(item, score, members): for each task and item its k best classes, equal scores by the least member."""
    n = len(items.ids)
    wide = int(weights.sum()) * 10**6 >= _EXACT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = pd.DataFrame({"item": np.zeros(0, np.int64), "score": np.zeros(0, np.int64), "none": np.zeros(0, bool), "id": np.zeros(0, np.int64), "at": np.zeros(0, np.int64)})
        members = pa.array([], pa.list_(pa.struct([("none", pa.bool_()), ("id", pa.int64())])))
        bar = np.ones(n, np.int64)  # only scores above zero count
        for batch in batches:
            for a in range(0, batch.num_rows, max(1, SCORES_AT_ONCE // n)):
                b = batch.slice(a, max(1, SCORES_AT_ONCE // n))
                row, term, tf = _entries(b.column(0))
                m = b.column(1).to_numpy()[row]
                part = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
                held = items.first[term + 1] - items.first[term]
                at = np.repeat(items.first[term] - np.cumsum(held) + held, held) + np.arange(int(held.sum()))
                cell, part = np.repeat(row, held) * n + items.holders[at], np.repeat(part, held)
                if wide:
                    score = (np.bincount(cell, part >> 20, b.num_rows * n).astype(np.int64) << 20) + np.bincount(cell, part & 0xFFFFF, b.num_rows * n).astype(np.int64)
                else:
                    score = np.bincount(cell, part, b.num_rows * n).astype(np.int64)
                score = score.reshape(b.num_rows, n)
                if b.num_rows > k:
                    bar = np.maximum(bar, np.partition(score, b.num_rows - k, axis=0)[b.num_rows - k])
                r, i = np.nonzero(score >= bar)
                if not len(r):
                    continue
                ids = b.column(2)
                least = ids.flatten().take(pa.array(ids.value_lengths().to_numpy().cumsum() - ids.value_lengths().to_numpy()))
                new = pd.DataFrame({"item": i, "score": score[r, i], "none": least.field(0).to_numpy(zero_copy_only=False)[r], "id": least.field(1).fill_null(0).to_numpy()[r], "at": len(members) + r})
                best = pd.concat([best, new]).sort_values(["item", "score", "none", "id"], ascending=[True, False, True, True], kind="stable")
                best = best[best.groupby("item").cumcount() < k]
                full = best[best.groupby("item").cumcount() == k - 1]
                bar[full["item"]] = np.maximum(bar[full["item"]], full["score"])
                used, best["at"] = np.unique(best["at"], return_inverse=True)
                members = pa.concat_arrays([members, ids.cast(members.type)]).take(pa.array(used))
        if len(best):
            yield pa.RecordBatch.from_arrays([pa.array(best["item"].astype(np.int32)), pa.array(best["score"]), members.take(pa.array(best["at"]))], names=["item", "score", "members"])

    return classes.select("bag", "m", "members").mapInArrow(lean(run), "item int, score long, members array<struct<none: boolean, id: long>>")


def term_weights(documents: int, frequency: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(f) + 1))) for f in frequency], np.int64)


def ranked_search(docs: DataFrame, items: DataFrame, *, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(``item_col``, rank, ``id_col``, score): the k best documents of each item with a score above 0, all if fewer.

    Equal scores go by ascending id, null ids last. Null texts have no terms; documents without terms count for nothing,
    items without terms or without a hit have no rows. Item rows of one id, null included, are one item with all their
    terms. Repeated document rows are documents of their own. Empty tables give an empty result; other columns are not
    looked at. Texts are taken whole, one at a time where they are long.
    """
    out = docs.sparkSession.createDataFrame([], f"`{item_col}` long, rank int, `{id_col}` long, score long")
    for block in item_blocks(items, id_col=item_col, text_col=item_text_col):
        bags = written(document_bags(docs, block, id_col=id_col, text_col=text_col), "search-bags")
        documents, terms, frequency = corpus_counts(bags, len(block.hashes))
        if not documents:
            break
        scored = class_scores(bag_classes(bags, documents, terms, k), block, term_weights(documents, frequency), k)
        first = F.col("members")[0]
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), first["none"], first["id"])
        found = scored.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k).select("item", "score", F.explode("members").alias("doc"))
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc.none"), F.col("doc.id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = F.array(*[F.lit(i).cast("long") for i in block.ids]) if len(block.ids) <= 1000 else None
        if names is None:
            spark = docs.sparkSession
            table = spark.createDataFrame(list(enumerate(block.ids)), "item int, name long")
            ranked = ranked.join(table, "item")
        else:
            ranked = ranked.withColumn("name", names[F.col("item")])
        out = out.unionByName(ranked.select(F.col("name").alias(item_col), "rank", F.col("doc.id").alias(id_col), "score"))
    return out


def search_sql(k: int = 10) -> str:
    """DuckDB SQL of the same rows, for tables ``documents`` and ``benchmark``."""
    terms = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{TERMS}')"
    return rf"""
WITH d AS (SELECT doc_id, {terms} AS w FROM documents),
q AS (SELECT DISTINCT item_id, unnest({terms}) AS term FROM benchmark),
c AS (SELECT count(*) AS docs, sum(len(w)) AS words FROM d WHERE len(w) > 0),
t AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
f AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM t, c GROUP BY term),
p AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + ((90 * n::HUGEINT * docs) // words)::BIGINT))) AS part FROM t JOIN f USING (term), c),
s AS (SELECT item_id, doc_id, sum(part)::BIGINT AS score FROM q JOIN p USING (term) GROUP BY item_id, doc_id HAVING sum(part) > 0)
SELECT item_id, rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s) WHERE rank <= {k}"""
