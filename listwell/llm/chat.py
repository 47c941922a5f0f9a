"""Chat formatting: multi-party perspective rotation, in DataFrame operations only.

For every participant of a conversation the dialogue is rendered once with that speaker as assistant and all others as
named users. Mask spans cover what is to be trained: the assistant's words and their closing token, in characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
UNKNOWN = "unknown"


def _plain(text: Column) -> Column:
    """Text that cannot open or close a turn."""
    return F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("<|im_"), F.lit("< |im_"))


def _name(role: Column) -> Column:
    """A role on one line; null or blank is ``unknown``. Different roles may get one name: see ``_unique``."""
    name = F.regexp_replace(F.trim(_plain(role)), r"[\x00-\x20]+", "_")
    return F.when(F.length(name) == 0, F.lit(UNKNOWN)).otherwise(name)


def _unique(name: str, role: str, keys: tuple[str, ...], system_role: str) -> Column:
    """The name, with ``#`` and a number behind it where several roles of a conversation share it or where it ends so itself."""
    same = Window.partitionBy(*keys, name)
    at = F.dense_rank().over(same.orderBy(F.col(role).asc_nulls_first()))
    several = F.min(F.coalesce(role, F.lit("\0"))).over(same) < F.max(F.coalesce(role, F.lit("\0"))).over(same)
    marked = F.concat(F.col(name), F.lit("#"), at.cast("string"))
    return F.when((F.col(name) != system_role) & (several | F.col(name).rlike("#[0-9]+$")), marked).otherwise(F.col(name))


def rotate_perspectives(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", system_role: str = "system") -> DataFrame:
    """(conv id, speaker, n_turns, text, spans, n_trained) for each conversation and each of its participants.

    Turns follow ``turn_col``, nulls first, ties by speaker and text; repeated rows are repeated turns. Turns of
    ``system_role`` stay system turns in every view and have no view of their own, so a conversation of system turns only
    has no row. Every role is a participant of its own: where roles would share a name (``bob b`` and ``bob_b``, null and
    ``unknown``) they are numbered, as ``bob_b#1``. A null text is an empty turn. A turn without a conversation id is a
    conversation of its own. One shuffle by conversation serves all steps; a view is as large as its conversation. An
    empty table gives an empty result.
    """
    alone = F.when(F.col(conv_col).isNull(), F.monotonically_increasing_id())
    turns = conversations.select(F.col(conv_col).alias("conv"), alone.alias("alone"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), _name(F.col(role_col)).alias("name"), _plain(F.col(text_col)).alias("body"))
    turns = turns.repartition("conv", "alone")  # all windows below go by these
    turns = turns.withColumn("speaker", _unique("name", "role", ("conv", "alone"), system_role))
    whole = Window.partitionBy("conv", "alone")
    views = turns.withColumn("who", F.collect_set("speaker").over(whole)).withColumn("viewer", F.explode(F.array_remove("who", system_role))).drop("who")
    own, system = F.col("speaker") == F.col("viewer"), F.col("speaker") == system_role
    head = F.concat(F.lit(OPEN), F.when(system, F.lit("system")).when(own, F.lit("assistant")).otherwise(F.concat(F.lit("user name="), F.col("speaker"))), F.lit("\n"))
    pieces = views.withColumn("head", head).withColumn("piece", F.concat("head", "body", F.lit(CLOSE + "\n")))
    order = Window.partitionBy("conv", "alone", "viewer").orderBy(F.col("turn").asc_nulls_first(), "speaker", "body")
    placed = pieces.withColumn("n", F.row_number().over(order)).withColumn("at", F.sum(F.length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.length("piece"))
    start = F.col("at") + F.length("head")
    span = F.when(own, F.struct(start.alias("start"), (start + F.length("body") + len(CLOSE)).alias("end")))
    listed = placed.groupBy("conv", "alone", "viewer").agg(F.array_sort(F.collect_list(F.struct("n", "piece", span.alias("span")))).alias("turns"))
    spans = F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull())
    return listed.select(
        F.col("conv").alias(conv_col),
        F.col("viewer").alias("speaker"),
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("text"),
        spans.alias("spans"),
        F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_trained"),
    )


def rotation_sql() -> str:
    """The rows of the registered query, for DuckDB."""
    return r"""
WITH r AS (SELECT conv_id, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone, turn, role, replace(coalesce(text, ''), '<|im_', '< |im_') AS body,
                  CASE WHEN trim(coalesce(role, '')) = '' THEN 'unknown' ELSE regexp_replace(trim(replace(role, '<|im_', '< |im_')), '[\x00-\x20]+', '_', 'g') END AS name FROM conversations),
m AS (SELECT *, dense_rank() OVER (PARTITION BY conv_id, alone, name ORDER BY role NULLS FIRST) AS nth,
             min(coalesce(role, chr(0))) OVER (PARTITION BY conv_id, alone, name) < max(coalesce(role, chr(0))) OVER (PARTITION BY conv_id, alone, name) AS several FROM r),
t AS (SELECT *, CASE WHEN name <> 'system' AND (several OR regexp_matches(name, '#[0-9]+$')) THEN name || '#' || nth ELSE name END AS speaker FROM m),
p AS (SELECT DISTINCT conv_id, alone, speaker AS viewer FROM t WHERE speaker <> 'system'),
h AS (SELECT t.*, viewer, '<|im_start|>' || CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = viewer THEN 'assistant' ELSE 'user name=' || speaker END || chr(10) AS head
      FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.alone IS NOT DISTINCT FROM p.alone),
q AS (SELECT *, head || body || '<|im_end|>' || chr(10) AS piece FROM h),
a AS (SELECT *, row_number() OVER w AS n, sum(length(piece)) OVER w - length(piece) + length(head) AS start FROM q
      WINDOW w AS (PARTITION BY conv_id, alone, viewer ORDER BY turn NULLS FIRST, speaker, body ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT conv_id, viewer AS speaker, count(*)::BIGINT AS n_turns, string_agg(piece, '' ORDER BY n) AS text,
       string_agg(start || '-' || (start + length(body) + 10), ',' ORDER BY n) FILTER (WHERE speaker = viewer) AS mask,
       sum(CASE WHEN speaker = viewer THEN length(body) + 10 ELSE 0 END)::BIGINT AS n_trained
FROM a GROUP BY conv_id, alone, viewer"""
