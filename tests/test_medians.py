import random
import statistics
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from listwell.plans import marts
from listwell.plans.marts import exact_medians, middle_values


def test_one_outlier_leaves_the_ranked_range_small(spark):
    n = 1_000_000
    rows = spark.range(n).select(F.lit("a").alias("g"), F.when(F.col("id") == 5, 1e10 - 1).otherwise(F.pmod(F.xxhash64("id"), F.lit(50_000_000)) / 100 + 1000).cast("decimal(12,2)").alias("p"))
    cents = rows.select("g", (F.col("p") * 100).cast("long").alias("cents"))
    held = middle_values(cents, ["g"]).where("cents IS NOT NULL")
    assert held.count() <= 5 * n / marts.ACCURACY
    want = cents.selectExpr("percentile(cents, 0.5) AS m").first().m
    assert exact_medians(rows, ["g"], "p", "m").first().m == (Decimal(want) / 100).quantize(Decimal("0.01"), ROUND_HALF_UP)


@pytest.mark.parametrize(("most", "groups"), [(1_000_000, 100_000), (1_000_000, 1), (3, 100_000), (3, 1)])
def test_medians_of_any_shape(spark, monkeypatch, most, groups):
    """One pass, groups too many to broadcast, and further narrowing give the same."""
    monkeypatch.setattr(marts, "MOST_RANKED", most)
    monkeypatch.setattr(marts, "BROADCAST_GROUPS", groups)
    rng = random.Random(most)
    data = {None: [1.5], "one": [2.25, 2.25, 2.26], "two": [1.0, 4.0], "same": [7.0] * 501, "many": [rng.choice([0.01, 5.0, 1e9]) for _ in range(400)], "wide": [round(10 ** rng.uniform(-2, 9), 2) for _ in range(12_001)], "even": [float(i) for i in range(20_000)]}
    rows = [(g, v) for g, vs in data.items() for v in vs] + [("nulls", None), ("one", None)]
    rng.shuffle(rows)
    got = {r.g: r.m for r in exact_medians(spark.createDataFrame(rows, "g string, p double"), ["g"], "p", "m").collect()}
    half = lambda v: Decimal(v).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert got == {g: half(statistics.median([half(str(v)) for v in vs])) for g, vs in data.items()}
