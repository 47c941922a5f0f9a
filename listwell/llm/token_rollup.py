"""Token counts as delta-maintained rollups by source, language and tokenizer version.

A batch is a table of changes with the counts before and after: an insert has only an after, a delete only a before, a
revision both. A batch is summed into signed deltas (+ after, - before) and written to its own partition; a row in the
commit table makes it count. A batch that is committed is never applied again, and one that broke off between the two
writes is redone over its own partition. Totals are kept: every few batches the committed deltas are folded into a new
version of the totals, which names the batches that it holds and appears whole; a read adds only the deltas since then.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.schemas import simple_schema
from ..operators.tables import VersionedTable
from .packing import WordEncoder
from .words import text_slices

KEYS = ("source", "lang", "tokenizer")
_DELTA = "source string, lang string, tokenizer string, n_docs long, n_tokens long, batch_id string"


def image(source: str = "source", lang: str = "lang", *, tokenizer: str, tokens: Column) -> Column:
    """The before or after of a change."""
    return F.struct(F.col(source).cast("string").alias("source"), F.col(lang).cast("string").alias("lang"), F.lit(tokenizer).alias("tokenizer"), F.coalesce(tokens, F.lit(0)).cast("long").alias("tokens"))


def nothing() -> Column:
    """The before of an insert and the after of a delete."""
    return F.lit(None).cast("struct<source:string,lang:string,tokenizer:string,tokens:bigint>")


def signed_deltas(changes: DataFrame) -> DataFrame:
    """Sums of ``changes`` (before, after) by key. Null sources and languages are keys of their own."""
    signs = F.array(F.struct(F.col("after").alias("i"), F.lit(1).alias("sign")), F.struct(F.col("before").alias("i"), F.lit(-1).alias("sign")))
    rows = changes.select(F.explode(signs).alias("s")).where("s.i is not null")
    return rows.groupBy(*(F.col(f"s.i.{k}").alias(k) for k in KEYS)).agg(F.sum("s.sign").cast("long").alias("n_docs"), F.sum(F.col("s.sign") * F.col("s.i.tokens")).cast("long").alias("n_tokens"))


_counters: dict[tuple, object] = {}


def _counter(path: str, pattern: str | None):
    """Function from a column of texts to their token counts; kept for the worker's life."""
    if (path, pattern) not in _counters:
        if path.endswith(".tiktoken"):
            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
            plain = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            _counters[path, pattern] = lambda texts: np.array([len(plain.encode_ordinary(t.as_py() or "")) for t in texts], np.int64)
        else:
            encoder = WordEncoder(path)
            _counters[path, pattern] = lambda texts: np.concatenate([np.zeros(0, np.int64), *(np.diff(encoder.encode(data, offsets)[1]) for _, _, data, offsets in text_slices(texts))])
    return _counters[path, pattern]


def with_token_counts(docs: DataFrame, tokenizers: Mapping[str, str], *, pattern: str | None = None, columns: tuple[str, ...] = ("doc_id", "source", "lang"), text_col: str = "text") -> DataFrame:
    """``columns`` of every document and ``tokens``: a map from tokenizer version to the number of tokens of the whole text.

    A version is the path of its file, at the same place on every node: a ``.tiktoken`` rank file, whose texts are parted by
    ``pattern``, or a tokenizer file that drops white space and never joins across it. A null text has no tokens.
    """
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"))
    versions = list(tokenizers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts = [_counter(tokenizers[v], pattern)(b.column(0)) for v in versions]
            per_row = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * len(versions)), pa.array(np.stack(counts, axis=1).ravel()))
            yield pa.RecordBatch.from_arrays([b.column(1), per_row], names=["row", "n"])

    counted = rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, n array<bigint>")
    return counted.select("row.*", F.map_from_arrays(F.array(*map(F.lit, versions)), "n").alias("tokens"))


class TokenRollup:
    """The rollup kept under ``path``, a folder that all executors share.

    Batch ids are texts that are not empty, else it is an error. Null sources, languages and counts are allowed (a null count
    is zero); an empty batch is committed like any other. Rows that repeat count as often as they stand there.
    """

    def __init__(self, spark: SparkSession, path: str, *, fold_every: int = 16):
        self.spark, self.path, self.fold_every = spark, path.rstrip("/"), fold_every
        self._kept = VersionedTable(spark, f"{self.path}/totals", simple_schema("folded_batch string, source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"))
        if not self._there("commits"):
            # an empty append makes the tables exist
            spark.createDataFrame([], _DELTA).write.mode("append").partitionBy("batch_id").parquet(f"{self.path}/deltas")
            spark.createDataFrame([], "batch_id string").write.mode("append").parquet(f"{self.path}/commits")

    def _there(self, name: str) -> bool:
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(target)

    def committed(self) -> DataFrame:
        return self.spark.read.schema("batch_id string").parquet(f"{self.path}/commits").distinct()

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Apply a batch once; False if it had been committed before and nothing was done."""
        if not batch_id:
            raise ValueError("a batch needs an id")
        if self.committed().where(F.col("batch_id") == batch_id).head(1):
            return False
        self.stage(batch_id, changes)
        self.spark.createDataFrame([(batch_id,)], "batch_id string").coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        if self._open().count() >= self.fold_every:
            self.fold()
        return True

    def stage(self, batch_id: str, changes: DataFrame) -> None:
        """Write a batch's deltas over what an attempt that broke off may have left."""
        deltas = signed_deltas(changes).withColumn("batch_id", F.lit(batch_id))
        deltas.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{self.path}/deltas")

    def _open(self) -> DataFrame:
        """Committed batches that the kept totals don't hold."""
        folded = self._kept.read().where("folded_batch IS NOT NULL").select(F.col("folded_batch").alias("batch_id"))
        return self.committed().join(folded, "batch_id", "left_anti")

    def fold(self) -> None:
        """Keep the totals of all committed batches as a new version, together with the ids of those batches."""
        batches = self.committed().select(F.col("batch_id").alias("folded_batch"))
        self._kept.publish(self.totals().withColumn("folded_batch", F.lit(None).cast("string")).unionByName(batches, allowMissingColumns=True))

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) over committed batches; keys whose documents have all gone stay, with zeros."""
        deltas = self.spark.read.schema(_DELTA).parquet(f"{self.path}/deltas").join(self._open(), "batch_id", "left_semi").drop("batch_id")
        kept = self._kept.read().where("folded_batch IS NULL").drop("folded_batch")
        return kept.unionByName(deltas).groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
