"""Training-corpus pipeline: quality rules, near-duplicates, repeated passages, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``, those
that ``docs`` has beyond them included. Every stage gives an empty result for an empty table and takes repeated rows one by
one; nulls in other columns than id, text and source pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from listwell.llm.jaccard import one_of_each_similar
from listwell.llm.mixing import mix_sources
from listwell.llm.packing import pack_documents
from listwell.llm.quality import fit_quality_model, good_documents
from listwell.llm.storage import written
from listwell.llm.substring_dedup import without_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules; the classifier learns from the labelled rows of the whole corpus.

    A null or empty text has no words and goes; a null id is judged like any other.
    """
    model = fit_quality_model(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return good_documents(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of copies: five-word shingles, similarity of 0.8 or more.

    Texts without words, null ones too, are one group. Rows with a null id stay; of equal rows of one id all stay or go.
    """
    return one_of_each_similar(docs, shingle_words=5, similarity=0.8)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without windows of 13 words that an earlier document holds.

    Documents that lose all their words go. Rows with a null id and null texts stay as they are.
    """
    return without_repeats(docs, min_words=13)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as their source's rate takes them; the null source is one of its own, a null text has size zero."""
    return mix_sources(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of each row of ``docs``, with its place in a sequence; a null text is its end token alone."""
    return pack_documents(docs, tokenizer=public_tokenizers.path("word_bpe_49k.json"), max_tokens=2048)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL cannot express the classifier, the fingerprints or the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage returns is written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
