"""Lookups in a dictionary that is a table: broadcast behind a check of its size, else joined by shuffle; misses are rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.primitives import trimmed
from .rows import REASON

#: Bytes of keys and values up to which a dictionary is sent to every executor.
BROADCAST_BYTES = 32 << 20


def dictionary_key(value: Column) -> Column:
    """Keys meet without regard to case and surrounding white space."""
    return F.lower(trimmed(value.cast("string")))


def dictionary(entries: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) with one row for each key, the least value where there are several; null keys are none."""
    pairs = entries.select(dictionary_key(F.col(f"`{key}`")).alias("key"), F.col(f"`{value}`").alias("value"))
    return pairs.where("key IS NOT NULL").groupBy("key").agg(F.min("value").alias("value"))


def looked_up(rows: DataFrame, column: str, entries: DataFrame, *, name: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``rows`` with ``name``, the entry of each row's key, and ``_reason`` for a key that has none; a null key has neither.

    ``entries`` comes from ``dictionary``. A reason that a row has already stays. Beyond ``broadcast_bytes`` the join is a
    shuffle by key, in which Spark splits keys that very many rows share; rows with a null key are spread by themselves.
    """
    size = entries.agg(F.sum(F.octet_length("key") + F.coalesce(F.octet_length(F.col("value").cast("string")), F.lit(0)) + 16)).first()[0] or 0
    table = entries.select(F.col("key").alias("_key"), F.col("value").alias("_value"), F.lit(True).alias("_found"))
    wanted = rows.withColumn("_wanted", dictionary_key(F.col(f"`{column}`")))
    joined = wanted.join(F.broadcast(table) if size <= broadcast_bytes else table.hint("merge"), F.col("_wanted") == F.col("_key"), "left")
    missed = F.when(F.col("_wanted").isNotNull() & F.col("_found").isNull(), F.lit(f"{name}: not in dictionary"))
    reason = F.coalesce(F.col(REASON), missed) if REASON in rows.columns else missed
    return joined.select(*(F.col(f"`{c}`") for c in rows.columns if c not in (REASON, name)), F.col("_value").alias(name), reason.alias(REASON))
