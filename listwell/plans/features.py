"""The row-level feature table: fixed columns from a pinned version, the target an untouched null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .marts import price_per_area

# The columns of the feature table, in their order.
FEATURES = (
    "id", "source", "external_id", "price_rub", "area_m2", "price_per_m2", "rooms", "floor", "floors_total", "metro_minutes", "floor_ratio", "district", "style", "renovation_style",
    "has_renovation", "has_furniture", "listed_at", "photo_urls", "ceiling_height_m", "wall_material", "year_built", "is_loft", "_silver_snapshot_id", "_source_transform_run_id", "_gold_run_id", "_computed_at",
)
TARGET = "is_loft"


def floor_ratio(floor: str = "floor", total: str = "floors_total") -> Column:
    """Null where the number of floors is null or zero."""
    return F.col(floor).cast("double") / F.nullif(F.col(total).cast("double"), F.lit(0.0))


def feature_table(silver: DataFrame, *, snapshot: str, run_id: str, now: Column) -> DataFrame:
    made = {
        "price_per_m2": price_per_area(),
        "floor_ratio": floor_ratio(),
        TARGET: F.lit(None).cast("boolean"),  # never derived from other columns
        "_silver_snapshot_id": F.lit(snapshot),
        "_source_transform_run_id": F.col("_transform_run_id"),
        "_gold_run_id": F.lit(run_id),
        "_computed_at": now,
    }
    return silver.select(*(made.get(c, F.col(c)).alias(c) for c in FEATURES))
