"""Mixing sources to target weights by repetition rates.

Sizes are summed by source, targets follow the weights up to a cap on repetition, and a source's rate is its target over
its size. Each document is emitted floor(rate) times, plus once more with a probability equal to the fraction of the rate.
A draw seeded by a hash of the id decides. Large documents of a source are drawn one after the other, from the largest
down, and what one misses the target by the probability of the next ones makes up for: over all draws each has the
fraction for its probability (but where a single document outweighs what others could make up for), and a source ends near
its target even if it is small or uneven. All of it is built-in DataFrame work; the draws are the same on every run and in
any other engine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import checkpointed

WORDS = r"[^\x20\x09-\x0D]+"
#: The table of rates is broadcast up to this many bytes and joined by shuffle beyond.
BROADCAST_BYTES = 4 << 20
#: Documents that hold at least one part in so many of their source are drawn one after the other: no more than so many.
LARGE = 2_000


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORDS)), F.lit(0)).cast("long")


def _with_sums_before(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with the sums over all rows that come earlier in ``order``, by ranges: no task orders all rows."""
    placed = checkpointed(df.repartitionByRange(*order).select("*", F.spark_partition_id().alias("_range"), *(c.alias(f"_{n}") for n, c in sums.items())))
    # one row for each range
    totals = placed.groupBy("_range").agg(*(F.sum(f"_{n}").alias(f"_all_{n}") for n in sums))
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_range", *(F.coalesce(F.sum(f"_all_{n}").over(ahead), F.lit(0)).alias(f"_ahead_{n}") for n in sums))
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = placed.join(F.broadcast(totals), "_range")
    return joined.select(*df.columns, *((F.col(f"_ahead_{n}") + F.coalesce(F.sum(f"_{n}").over(within), F.lit(0))).alias(n) for n in sums))


def source_rates(sizes: DataFrame, *, weights: Sequence[int] = (1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """(source, source_size, weight, target, rate) for rows of (source, size).

    Sources in order of code point, null last, take the weights in turn. Together the targets make up the sum of all sizes;
    a target stops at ``max_repeat`` times its source's size and the excess goes to the others by weight, until none is
    above. That is the level at which sum(min(cap, level * weight)) meets the total, found from sums in the order of cap
    over weight; the order is cut into ranges, so sources may be many. A source without words has target 0 and rate 1.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    name = F.col("source").asc_nulls_last()
    ranked = _with_sums_before(by, [name], {"n": F.lit(1)})
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("n") % len(weights) + 1).cast("int")).cast("long")
    capped = ranked.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * max_repeat).alias("cap"))
    before = _with_sums_before(capped, [F.col("cap") / F.col("weight"), name], {"cap_before": F.col("cap"), "weight_before": F.col("weight")})
    level = (F.col("total") - F.col("cap_before")).cast("double") / (F.col("all_weight") - F.col("weight_before")).cast("double")
    whole = capped.agg(F.sum("source_size").alias("total"), F.sum("weight").alias("all_weight"))
    leveled = before.crossJoin(F.broadcast(whole)).withColumn("level", level)  # one row
    full = F.col("level") * F.col("weight") > F.col("cap")
    rest = leveled.agg(F.max(F.when(~full, F.col("level"))).alias("rest"))
    target = F.when(full, F.col("cap").cast("double")).otherwise(F.col("rest") * F.col("weight"))
    rated = leveled.crossJoin(F.broadcast(rest)).select("source", "source_size", "weight", target.alias("target"))  # one row
    return rated.withColumn("rate", F.when(F.col("source_size") == 0, F.lit(1.0)).otherwise(F.col("target") / F.col("source_size")))


def draw(key: Column, seed: int) -> Column:
    """A number in [0, 1) from 52 bits of the MD5 of seed and key."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 13), 16, 10).cast("double") / float(1 << 52)


def _broadcast_if_small(df: DataFrame, text: str) -> DataFrame:
    """A hint for a table whose measured size, ``text`` and 64 bytes a row, is below the bound."""
    held = df.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 64)).first()[0] or 0
    return F.broadcast(df) if held <= BROADCAST_BYTES else df


def with_copies(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: Sequence[int] = (1, 2, 3), max_repeat: int = 3, seed: int = 7) -> DataFrame:
    """Each row of ``docs`` as a struct ``doc``, with a struct ``mix``: size, source_size, target, rate, copies.

    Rows that share source, id and size share their draw.
    """
    size, key = word_count(text_col), F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    sizes = checkpointed(docs.select(F.col(source_col).cast("string").alias("source"), key.alias("key"), size.alias("size")))
    rates = _broadcast_if_small(checkpointed(source_rates(sizes, weights=weights, max_repeat=max_repeat)).select(F.struct("*").alias("r")), "r.source")
    of_source = lambda df, r: df.join(r, df["source"].eqNullSafe(F.col("r.source")))
    whole = F.floor("r.rate")
    part = F.col("r.rate") - whole
    large = (F.col("size") > 0) & (F.col("size") * LARGE >= F.col("r.source_size")) & (part > 0)
    # at most LARGE rows for each source
    rows = of_source(sizes, rates).where(large).groupBy("source", "key", "size", "r").agg(F.count(F.lit(1)).alias("times"))
    falling = F.struct((-F.col("size")).alias("order"), draw(F.col("key"), seed).alias("u"), "key", (F.col("size") * F.col("times")).alias("words"))
    lists = rows.groupBy("source", "r").agg(F.sort_array(F.collect_list(falling)).alias("rows"))
    due = part * F.col("r.source_size")

    def step(done: Column, row: Column) -> Column:
        hit = (row["u"] < (due - done["taken"]) / (F.col("r.source_size") - done["seen"])).cast("long")
        return F.struct((done["taken"] + hit * row["words"]).alias("taken"), (done["seen"] + row["words"]).alias("seen"), F.array_append(done["hits"], hit).alias("hits"))

    none = F.struct(F.lit(0).cast("long").alias("taken"), F.lit(0).cast("long").alias("seen"), F.array().cast("array<bigint>").alias("hits"))
    drawn = checkpointed(lists.select("source", "rows", F.aggregate("rows", none, step).alias("done")))
    together = drawn.select("source", F.explode(F.arrays_zip("rows", F.col("done.hits").alias("hits"))).alias("x"))
    together = _broadcast_if_small(together.select(F.struct("source", F.col("x.rows.key").alias("key"), (-F.col("x.rows.order")).alias("size")).alias("at"), F.col("x.hits").alias("extra")), "at.key")
    # what is left to the other documents of a source
    ends = drawn.select(F.col("source").alias("s"), "done.taken", "done.seen")
    ends = F.broadcast(ends) if rates.count() * 64 <= BROADCAST_BYTES else ends
    left = (due - F.coalesce("taken", F.lit(0))) / F.nullif(F.col("r.source_size") - F.coalesce("seen", F.lit(0)), F.lit(0))
    rates = _broadcast_if_small(checkpointed(rates.join(ends, F.col("r.source").eqNullSafe(F.col("s")), "left").select("r", F.coalesce(left, F.lit(0.0)).alias("p"))), "r.source")
    rows = of_source(docs.select(F.struct("*").alias("doc"), F.col(source_col).cast("string").alias("source"), key.alias("key"), size.alias("size")), rates)
    same = F.col("source").eqNullSafe(F.col("at.source")) & (F.col("key") == F.col("at.key")) & (F.col("size") == F.col("at.size"))
    copies = whole + F.coalesce(F.col("extra"), (draw(F.col("key"), seed) < F.col("p")).cast("long"))
    return rows.join(together, same, "left").select("doc", F.struct("size", "r.source_size", "r.target", "r.rate", copies.alias("copies")).alias("mix"))


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as often as the mix takes it, columns unchanged.

    Null texts have no words; rows of the null source are a source of their own,
    the last. An empty table gives an empty one. Columns of any name pass through.
    """
    copied = with_copies(docs, **options).where("mix.copies > 0")
    return copied.select("doc", F.explode(F.sequence(F.lit(1), F.col("mix.copies").cast("int"))).alias("copy")).select("doc.*")


def mixing_sql(seed: int = 7, max_repeat: int = 3) -> str:
    """The same rows for DuckDB, weights 1, 2, 3."""
    return rf"""
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORDS}')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight, {max_repeat} * source_size AS cap FROM s),
l AS (SELECT *, ((sum(source_size) OVER ()) - coalesce(sum(cap) OVER p, 0))::DOUBLE / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER p, 0))::DOUBLE AS level
      FROM w WINDOW p AS (ORDER BY cap::DOUBLE / weight::DOUBLE, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, max(CASE WHEN NOT level * weight > cap THEN level END) OVER () AS rest FROM l),
t AS (SELECT source, source_size, CASE WHEN level * weight > cap THEN cap::DOUBLE ELSE rest * weight END AS target FROM f),
r AS (SELECT *, CASE WHEN source_size = 0 THEN 1.0 ELSE target / source_size END AS rate FROM t),
j AS (SELECT d.doc_id, d.source, d.size, source_size, target, floor(rate)::BIGINT AS whole, rate - floor(rate) AS part,
             ('0x' || substr(md5(concat('{seed}:', d.doc_id)), 1, 13))::BIGINT / 4503599627370496.0 AS u
      FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
h AS (SELECT *, size > 0 AND size * {LARGE} >= source_size AND part > 0 AS large FROM j),
n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size DESC, u, doc_id::VARCHAR) AS n FROM h WHERE large),
q AS (SELECT source, 0::BIGINT AS n, 0::BIGINT AS taken, 0::BIGINT AS seen, 0::BIGINT AS extra FROM (SELECT DISTINCT source FROM h)
      UNION ALL
      SELECT n.source, n.n, taken + CASE WHEN u < (part * source_size - taken) / (source_size - seen) THEN size ELSE 0 END, seen + size,
             (u < (part * source_size - taken) / (source_size - seen))::BIGINT
      FROM q JOIN n ON n.source IS NOT DISTINCT FROM q.source AND n.n = q.n + 1),
e AS (SELECT source, max_by(taken, n) AS taken, max_by(seen, n) AS seen FROM q GROUP BY source),
x AS (SELECT n.doc_id, q.extra FROM q JOIN n ON n.source IS NOT DISTINCT FROM q.source AND n.n = q.n)
SELECT h.doc_id, size, source_size, target,
       (size * (whole + CASE WHEN large THEN x.extra ELSE (u < coalesce((part * source_size - e.taken) / nullif(source_size - e.seen, 0), 0))::BIGINT END))::BIGINT AS taken
FROM h JOIN e ON h.source IS NOT DISTINCT FROM e.source LEFT JOIN x ON h.doc_id = x.doc_id"""
