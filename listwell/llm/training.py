"""Bounded labelled samples for the classifiers of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, *, label_col: str, per_class: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, label 0 or 1, id) of at most ``per_class`` labelled documents of each class, the same on every run.

    The documents of least hash are taken. Null ids and labels take no part; where an id has several labels the largest
    counts. A repeated document row may repeat in the sample.
    """
    known = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(label_col).cast("int").alias("label")).where("id is not null")
    order = (F.xxhash64("id"), F.col("id"))
    chosen = known.where("label = 0").orderBy(*order).limit(per_class).unionByName(known.where("label = 1").orderBy(*order).limit(per_class))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # 2 * per_class ids at most
    return rows.join(F.broadcast(chosen), "id").select("text", "label", "id")
