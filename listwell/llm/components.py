"""Connected components by alternating large-star and small-star rounds on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import checkpointed

#: Edges of a node from which it is split, and hubs that are broadcast at most.
HUB, BROADCAST_HUBS = 20_000, 100_000


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _with_least(edges: DataFrame, n: int) -> DataFrame:
    """``edges`` (u, v) with ``m``, the least v of each u.

    A node of more than ``HUB`` edges is met in as many parts as its number asks for; there are at most ``n`` / HUB of them.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    if n <= HUB:
        return edges.join(least.select("u", "m"), "u")
    parts = F.ceil(F.col("n") / HUB).cast("int")
    hubs = least.where(F.col("n") > HUB).select(F.col("u").alias("hub"), parts.alias("parts"))
    hubs = F.broadcast(hubs) if n // HUB <= BROADCAST_HUBS else hubs
    dealt = edges.join(hubs, F.col("u") == F.col("hub"), "left").select("u", "v", F.coalesce(F.pmod(F.xxhash64("v"), "parts"), F.lit(0)).cast("int").alias("part"))
    return dealt.join(least.select("u", "m", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part")), ["u", "part"]).drop("part")


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of an edge that isn't the least of its component; component is that least id.

    Each round needs one aggregation with a map-side minimum and one join, in which hubs are split. Rounds grow with the logarithm of the longest chain. Lineage is cut each round by a reliable checkpoint.
    """
    pairs = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).where("u > v").distinct()
    pairs = checkpointed(pairs)
    state = _state(pairs)
    for _ in range(max_rounds):
        if not state[0]:
            break
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, 2 * state[0]).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u > v").distinct()
        # each u keeps its least neighbour; its other neighbours are handed to that one
        low = _with_least(large, 2 * state[0])
        small = low.select(F.when(F.col("v") > F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v")).distinct()
        pairs = checkpointed(small)
        state, before = _state(pairs), state
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
