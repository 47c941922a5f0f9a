"""The three aggregate marts and the row-level feature table, as DataFrame plans.

Every column is listed by name, so a new upstream column cannot leak in. Averages divide an exact decimal sum by the count
and round once; the price of a square metre is rounded to cents for each row before it is averaged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.primitives import text_key

MONEY, AREA = "decimal(12,2)", "decimal(8,2)"


def exact_mean(value: Column, kind: str) -> Column:
    """Mean of a decimal column without the double rounding of ``avg``; null for no values."""
    return (F.sum(value) / F.nullif(F.count(value), F.lit(0))).cast(kind)


#: A quantile sketch is off by no more than 1 / ACCURACY of a group's rows, whatever its values are.
ACCURACY = 10_000
#: Pivots of a first narrowing, on both sides of the middle, and of further ones: shares of the rows in question.
FIRST_PIVOTS, MORE_PIVOTS = (0.5 - 2 / ACCURACY, 0.5 + 2 / ACCURACY), tuple(i / 32 for i in range(1, 32))
#: Distinct values of a group that one task ranks; groups beyond it are narrowed again. Groups whose bounds are broadcast.
MOST_RANKED, BROADCAST_GROUPS = 1_000_000, 100_000


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left`` with the other columns of ``right``; nulls of ``keys`` meet each other."""
    renamed = right.select(*(F.col(k).alias(f"_right_{k}") for k in keys), *(c for c in right.columns if c not in keys))
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    return left.join(renamed, condition, how).drop(*(f"_right_{k}" for k in keys))


def _sketched(rows: DataFrame, keys: list[str], pivots: tuple[float, ...]) -> DataFrame:
    """(keys, held, least, most, pivots) of each group's ``cents``."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("held"), F.min("cents").alias("least"), F.max("cents").alias("most"), F.percentile_approx("cents", list(pivots), ACCURACY).alias("pivots"))


def _between(sketched: DataFrame, pivots: tuple[float, ...]) -> DataFrame:
    """``sketched`` (with ``before``, the rows below those held, and ``total``) with bounds that hold both middle values."""
    low, high = ((F.floor((F.col("total") + k) / 2) - F.col("before")) / F.col("held") for k in (1, 2))
    margin = F.lit(1 / ACCURACY)
    under, over = F.lit(None), F.lit(None)
    for i, share in enumerate(pivots):
        # the last pivot that is surely below, the first that is surely above
        under = F.when(F.lit(share) + margin <= low, F.col("pivots")[i]).otherwise(under)
    for i, share in reversed(list(enumerate(pivots))):
        over = F.when(F.lit(share) - margin >= high, F.col("pivots")[i]).otherwise(over)
    return sketched.withColumn("low", F.coalesce(under, "least")).withColumn("high", F.coalesce(over, "most"))


def _held(rows: DataFrame, bounds: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, cents, n) of values between each group's bounds; those below are counted under a null."""
    inside = _joined(rows, bounds.select(*keys, "low", "high"), keys).where("cents <= high")
    return inside.groupBy(*keys, F.when(F.col("cents") >= F.col("low"), F.col("cents")).alias("cents")).agg(F.count(F.lit(1)).alias("n"))


def middle_values(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, cents, n, total): the values of each group around its middle, and how many lie below, under a null.

    A sketch's pivots bound the middle for certain, as its error is bounded; what lies between is at most four times that
    error, or the few values that repeat so often. Groups of so many rows that this is still too much for a task are
    narrowed again by counted pivots. So the values' scale and outliers make no difference.
    """
    sketched = _sketched(rows, keys, FIRST_PIVOTS).withColumn("total", F.col("held")).withColumn("before", F.lit(0).cast("long"))
    bounds = _between(sketched, FIRST_PIVOTS).select(*keys, "total", "low", "high")
    known = bounds.limit(BROADCAST_GROUPS + 1).collect()
    small = len(known) <= BROADCAST_GROUPS
    if small:  # at most BROADCAST_GROUPS rows
        bounds = F.broadcast(rows.sparkSession.createDataFrame(known, bounds.schema))
    most = max((r["total"] for r in known), default=0) if small else bounds.agg(F.max("total")).first()[0]
    share = 4 / ACCURACY
    while most * share > MOST_RANKED:
        held = _held(rows, bounds, keys)
        below = held.where("cents IS NULL").select(*keys, F.col("n").alias("before"))
        inside = _joined(rows, bounds.select(*keys, "low", "high"), keys).where("cents BETWEEN low AND high")
        again = _joined(_joined(_sketched(inside, keys, MORE_PIVOTS), bounds.select(*keys, "total"), keys), below, keys, "left").withColumn("before", F.coalesce("before", F.lit(0)))
        bounds = _between(again, MORE_PIVOTS).select(*keys, "total", "low", "high")
        if small:
            bounds = F.broadcast(rows.sparkSession.createDataFrame(bounds.collect(), bounds.schema))
        # a range between pivots and the sketch's error on both sides
        share *= 1 / 16 + 4 / ACCURACY
    return _joined(_held(rows, bounds, keys), bounds.select(*keys, "total"), keys)


def exact_medians(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """(keys, ``name``): the mean of the two middle values of each group, halves up; nulls are ignored, as are groups of nulls.

    Values are whole cents. Only those around the middle are ordered, see ``middle_values``.
    """
    cents = (F.col(value).cast(MONEY) * 100).cast("bigint").alias("cents")
    held = middle_values(rows.where(F.col(value).isNotNull()).select(*keys, cents), keys)
    upto = F.sum("n").over(Window.partitionBy(*keys).orderBy(F.col("cents").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    ranked = held.withColumn("upto", upto).where("cents IS NOT NULL")
    pick = lambda rank: F.min(F.when(F.col("upto") >= rank, F.col("cents")))
    median = ((pick(F.floor((F.col("total") + 1) / 2)) + pick(F.floor((F.col("total") + 2) / 2))).cast("decimal(20,0)") / 200).cast(MONEY)
    return ranked.groupBy(*keys).agg(median.alias(name))


def _with_medians(summary: DataFrame, rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``summary`` with the median price of each group, columns in the order given."""
    return _joined(summary, exact_medians(rows, keys, "p", "median_price_rub"), keys, "left").select(*columns)


def price_per_area(price: str = "price_rub", area: str = "area_m2") -> Column:
    return (F.col(price) / F.nullif(F.col(area), F.lit(0))).cast(MONEY)


def price_area_mart(silver: DataFrame, group: str = "district", price: str = "price_rub", area: str = "area_m2") -> DataFrame:
    """Listings, prices and areas by district; a null district is 'unknown'."""
    rows = silver.select(F.coalesce(F.col(group), F.lit("unknown")).alias(group), F.col(price).cast(MONEY).alias("p"), F.col(area).cast(AREA).alias("a"))
    summary = rows.groupBy(group).agg(
        F.count(F.lit(1)).alias("listing_count"),
        exact_mean(F.col("p"), MONEY).alias("avg_price_rub"),
        F.min("p").cast(MONEY).alias("min_price_rub"),
        F.max("p").cast(MONEY).alias("max_price_rub"),
        exact_mean(price_per_area("p", "a"), MONEY).alias("avg_price_per_m2"),
        exact_mean(F.col("a"), AREA).alias("avg_area_m2"),
    )
    return _with_medians(summary, rows, [group], [group, "listing_count", "avg_price_rub", "median_price_rub", "min_price_rub", "max_price_rub", "avg_price_per_m2", "avg_area_m2"])


def style_mart(silver: DataFrame, small_sample: int = 3) -> DataFrame:
    """Listings by normalised style, renovation, and two booleans that may be null; groups under ``small_sample`` are marked."""
    rows = silver.select(
        text_key(F.col("style")).alias("style_norm"), text_key(F.col("renovation_style")).alias("renovation_style_norm"), "has_renovation", "has_furniture", F.col("price_rub").cast(MONEY).alias("p"), F.col("area_m2").cast(AREA).alias("a")
    )
    keys = ["style_norm", "renovation_style_norm", "has_renovation", "has_furniture"]
    summary = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("listing_count"), exact_mean(F.col("p"), MONEY).alias("avg_price_rub"), exact_mean(F.col("a"), AREA).alias("avg_area_m2"))
    grouped = _with_medians(summary, rows, keys, [*keys, "listing_count", "avg_price_rub", "median_price_rub", "avg_area_m2"])
    return grouped.withColumn("is_small_sample", F.col("listing_count") < small_sample)


def daily_counts(rows: DataFrame, moment: str) -> DataFrame:
    return rows.groupBy(F.to_date(moment).alias("load_date")).agg(F.count(F.lit(1)).alias("n"))


def calendar(days: DataFrame) -> DataFrame:
    """Every day from the first to the last; no rows for none."""
    bounds = days.agg(F.min("load_date").alias("first"), F.max("load_date").alias("last"))
    return bounds.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("load_date"))


def dynamics_mart(silver: DataFrame, moment: str = "_ingested_at") -> DataFrame:
    """Listings added for each day without gaps, and their running total. The window holds one row a day."""
    daily = daily_counts(silver.where(F.col(moment).isNotNull()), moment)
    filled = calendar(daily).join(daily, "load_date", "left").select("load_date", F.coalesce("n", F.lit(0)).alias("listings_added"))
    running = F.sum("listings_added").over(Window.orderBy("load_date").rowsBetween(Window.unboundedPreceding, 0))
    return filled.withColumn("listings_added_cumulative", running)


MARTS = {"mart_price_area_by_district": price_area_mart, "mart_style_renovation_furniture": style_mart, "mart_listing_dynamics": dynamics_mart}
