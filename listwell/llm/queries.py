"""Registered queries of this subpackage and the SQL that checks them.

Each ``opN_`` query is a thin layer: it reads whole tables, calls its operator and derives the columns of its contract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bag_search import ranked_search, search_sql
from .chat import rotate_perspectives, rotation_sql
from .mixing import WORDS, mixing_sql, with_copies
from .packing import pack_documents
from .quality import fit_quality_model, quality_report
from .simhash import simhash_components
from .storage import scratch_path, written
from .substring_dedup import substring_dedup
from .tier_packing import pack_tiers
from .token_rollup import TokenRollup, image, nothing, with_token_counts
from .topk import exact_top_k
from .toxicity import fit_toxicity_model, toxicity_scores
from .warc import archived_pages
from .whitening import whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rotate_perspectives(_table(spark, sf_dir, "conversations"))
    mask = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return out.select("conv_id", "speaker", "n_turns", "text", mask.alias("mask"), "n_trained")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(_table(spark, sf_dir, "documents"), min_words=13, with_text=False)
    spans = F.array_join(F.transform("removed", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256", spans.alias("spans"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity_scores(docs, fit_toxicity_model(docs, _table(spark, sf_dir, "labels")))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_components(_table(spark, sf_dir, "documents"), shingle_words=4, distance=4, seed=42)
    return out.select("doc_id", "fingerprint", "component_id")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = with_copies(_table(spark, sf_dir, "documents"), weights=(1, 2, 3), max_repeat=3)
    return out.select("doc.doc_id", "mix.size", "mix.source_size", "mix.target", (F.col("mix.size") * F.col("mix.copies")).alias("taken"))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return exact_top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10, scale=1024).select("query_id", "rank", "vec_id", "score")


def op7_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens by two tokenizer versions, counted once: all documents come in by the first; those under 50 of its tokens are
    deleted; those of 1,000 or more are counted anew with a closing token; the second version comes in. Two batches are
    replayed and change nothing, and the first ones are folded into kept totals."""
    import public_tokenizers as P

    versions = {name: P.path(file) for name, file in (("word_bpe_49k", "word_bpe_49k.json"), ("byte_bpe_50k", "byte_bpe_50k.tiktoken"))}
    docs = written(with_token_counts(_table(spark, sf_dir, "documents"), versions, pattern=P.PATTERN), "token-counts")
    first, second = (F.col("tokens")[name] for name in versions)
    v1, v2 = image(tokenizer="word_bpe_49k", tokens=first), image(tokenizer="byte_bpe_50k", tokens=second)
    rollup = TokenRollup(spark, scratch_path(spark, "rollup"), fold_every=3)
    load = docs.select(nothing().alias("before"), v1.alias("after"))
    short = docs.where(first < 50).select(v1.alias("before"), nothing().alias("after"))
    recount = docs.where(first >= 1000).select(v1.alias("before"), image(tokenizer="word_bpe_49k", tokens=first + 1).alias("after"))
    other = docs.select(nothing().alias("before"), v2.alias("after"))
    for batch, changes in (("load", load), ("short", short), ("recount", recount), ("short", short), ("second", other), ("load", load)):
        rollup.commit(batch, changes)
    return rollup.totals()


_REPEATS_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w FROM documents),
t AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i, len(w) AS n FROM d),
s AS (SELECT *, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS run FROM t),
f AS (SELECT run, min(doc_id) AS first FROM s WHERE i + 13 <= n GROUP BY run),
h AS (SELECT s.doc_id, i, word, coalesce(i + 13 <= n AND first < s.doc_id, false) AS hit FROM s LEFT JOIN f ON s.run = f.run),
c AS (SELECT *, max(hit) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM h),
k AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM c GROUP BY doc_id),
g AS (SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS island FROM c WHERE gone),
r AS (SELECT doc_id, min(i) AS a, max(i) + 1 AS b FROM g GROUP BY doc_id, island),
p AS (SELECT doc_id, string_agg(a || '-' || b, ',' ORDER BY a) AS spans FROM r GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN p USING (doc_id)"""

#: Base 32 of a hexadecimal SHA-1: five hexadecimal digits make four letters.
_WARC_SQL = r"""
WITH p AS (SELECT page_id, coalesce(url, '') AS u, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
b AS (SELECT page_id, u, strlen(h)::BIGINT AS payload_bytes, max(page_id) OVER (PARTITION BY x) AS last,
             list_aggregate(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(x, (k // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (k % 4))) & 31) + 1)::BIGINT, 1)), 'string_agg', '') AS payload_digest FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN last = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN last <> page_id THEN last END AS refers_to, true AS digest_ok, regexp_replace(u, '[\r\n]', '', 'g') AS request_uri, 3::BIGINT AS n_records FROM b"""

_TOP_K_SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, e.vec_id, list_sum(list_transform(list_zip(q.v, e.v), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM e AS q JOIN e ON q.vec_id <> e.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s) WHERE rank <= 10"""


def op8_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = archived_pages(_table(spark, sf_dir, "pages"), min_bytes=0)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok", "request_uri", "n_records")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality_report(docs, fit_quality_model(docs, _table(spark, sf_dir, "labels")))


def op10_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer=public_tokenizers.path("word_bpe_49k.json"), max_tokens=2048)


def op11_tier_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_tiers(_table(spark, sf_dir, "documents"), tokenizer=public_tokenizers.path("byte_bpe_50k.json"))


def op12_bag_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whiten(_table(spark, sf_dir, "embeddings"), components=32, scale=64, offset=1_000_000)
    return out.withColumn("deviation", F.col("deviation").cast("long"))


QUERIES = {
    "op1_perspective_rotation": op1_perspective_rotation,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_source_mixing": op5_source_mixing,
    "op6_exact_top_k": op6_exact_top_k,
    "op7_token_rollup": op7_token_rollup,
    "op8_warc_transactions": op8_warc_transactions,
    "op9_quality_rules": op9_quality_rules,
    "op10_pattern_packing": op10_pattern_packing,
    "op11_tier_packing": op11_tier_packing,
    "op12_bag_search": op12_bag_search,
    "op13_embedding_whitening": op13_embedding_whitening,
}
ORACLES: dict[str, str] = {
    "op1_perspective_rotation": rotation_sql(),
    "op2_substring_dedup": _REPEATS_SQL,
    "op5_source_mixing": mixing_sql(),
    "op6_exact_top_k": _TOP_K_SQL,
    "op8_warc_transactions": _WARC_SQL,
    "op12_bag_search": search_sql(),
}
