"""Row-level operators: reject split, latest row per key, latest-wins upsert, and pending work by anti join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REASON = "_reason"


def first_reason(rules: Sequence[tuple[Column, str | Column]]) -> Column:
    """The text of the first rule that a row breaks, null for a valid row. A rule that is null counts as kept."""
    texts = [F.when(F.coalesce(broken, F.lit(False)), F.lit(text) if isinstance(text, str) else text) for broken, text in rules]
    return F.coalesce(*texts, F.lit(None).cast("string"))


def split_rejects(df: DataFrame, rules: Sequence[tuple[Column, str | Column]]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with ``_reason``): every row is in exactly one of them."""
    judged = df.withColumn(REASON, first_reason(rules))
    return judged.where(F.col(REASON).isNull()).drop(REASON), judged.where(F.col(REASON).isNotNull())


def oversize(columns: Sequence[str], limit: int = 200_000) -> Column:
    """Whether any cell has more bytes than ``limit``."""
    return F.greatest(*(F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in columns), F.lit(0)) > limit


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: Column | str, *ties: Column | str) -> DataFrame:
    """One row for each key: the newest, ties by ``ties`` ascending. Keys are spread by their hash and nothing is sorted globally."""
    order = Window.partitionBy(*keys).orderBy((F.col(newest) if isinstance(newest, str) else newest).desc_nulls_last(), *ties)
    return df.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def latest_wins(target: DataFrame, updates: DataFrame, keys: Sequence[str], newest: str, *ties: str) -> DataFrame:
    """The target after an upsert: a newer update replaces its row, an equal or older one doesn't, a new key is added.

    ``_change`` says inserted, updated or unchanged. A key's updates count once, by their own latest.
    """
    fresh = latest_per_key(updates, keys, newest, *ties).select(*target.columns)
    both = target.withColumn("_side", F.lit(0)).unionByName(fresh.withColumn("_side", F.lit(1)))
    key = Window.partitionBy(*keys)
    won = both.withColumn("_had", F.min("_side").over(key)).withColumn("_n", F.row_number().over(key.orderBy(F.col(newest).desc_nulls_last(), "_side"))).where("_n = 1")
    change = F.when(F.col("_had") == 1, "inserted").when(F.col("_side") == 1, "updated").otherwise("unchanged")
    return won.withColumn("_change", change).drop("_side", "_had", "_n")


def pending(units: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Units of work without an entry in ``done``; one anti join for all."""
    return units.join(done.select(*keys).distinct(), list(keys), "left_anti")
