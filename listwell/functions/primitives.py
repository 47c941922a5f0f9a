"""Normalisation primitives as Columns. Each returns (value, failed): a failed value sends its row to quarantine."""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from .inference import MOMENT, as_timestamp

# Unit factors, boolean words, the longest value a pattern is tried on, and sanity ranges.
UNIT_FACTORS = {
    ("rub", "rub"): Decimal(1),
    ("thousands_rub", "rub"): Decimal(1000),
    ("mln_rub", "rub"): Decimal(1_000_000),
    ("m2", "m2"): Decimal(1),
    ("sotka", "m2"): Decimal(100),
}
TRUE_WORDS, FALSE_WORDS = ("true", "t", "yes", "1", "да"), ("false", "f", "no", "0", "нет")
PATTERN_LIMIT = 65_536
SANITY = {
    "price_rub": (0, 10_000_000_000),
    "area_m2": (1, 1000),
    "rooms": (0, 20),
    "floor": (1, 200),
    "floors_total": (1, 200),
    "metro_minutes": (0, 240),
    "ceiling_height_m": (1.5, 10.0),
    "year_built": (1800, 2100),
}
ABOVE_LOWER_BOUND = ("price_rub",)

Checked = tuple[Column, Column]
_NEVER = False


def trimmed(value: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(value, r"^\s+|\s+$", "")


def text_key(value: Column, missing: str = "none") -> Column:
    """Lower-cased, trimmed grouping key."""
    return F.coalesce(F.lower(trimmed(value)), F.lit(missing))


def java_pattern(pattern: str) -> str:
    """A configured pattern for Spark; refuses nested unbounded repetition, which can run for ever on one value."""
    re.compile(pattern)
    if re.search(r"\([^()]*[+*][^()]*\)[+*{]", pattern):
        raise ValueError(f"nested repetition in pattern: {pattern}")
    return re.sub(r"\(\?P<(\w+)>", r"(?<\1>", pattern)


def java_replacement(replacement: str) -> str:
    r"""A replacement written with \1 and \g<name>, for Spark."""
    literal = replacement.replace("$", r"\$")
    return re.sub(r"\\g<(\d+)>|\\(\d+)", lambda m: f"${m[1] or m[2]}", re.sub(r"\\g<([A-Za-z_]\w*)>", r"${\1}", literal))


def too_long(value: Column, limit: int = PATTERN_LIMIT) -> Column:
    return F.coalesce(F.length(value) > limit, F.lit(False))


def regex_replace(value: Column, pattern: str, replacement: str) -> Checked:
    long = too_long(value)
    return F.when(~long, F.regexp_replace(value, java_pattern(pattern), java_replacement(replacement))), long


def regex_extract(value: Column, pattern: str) -> Checked:
    """Group 1 of the first match if the pattern has a group, else the match; null where nothing matches."""
    long = too_long(value)
    group = 1 if re.compile(pattern).groups else 0
    found = F.when(value.rlike(java_pattern(pattern)), F.regexp_extract(value, java_pattern(pattern), group))
    return F.when(~long, found), long


def _cast(value: Column, typed: Column) -> Checked:
    return typed, value.isNotNull() & typed.isNull()


def cast_decimal(value: Column) -> Checked:
    """Two places, half up, never through a float."""
    return _cast(value, trimmed(value).try_cast("decimal(38,2)"))


def cast_bigint(value: Column) -> Checked:
    return _cast(value, F.when(trimmed(value).rlike(r"^[+-]?[0-9]+$"), trimmed(value).try_cast("bigint")))


def cast_boolean(value: Column) -> Checked:
    low = F.lower(trimmed(value))
    return _cast(value, F.when(low.isin(*TRUE_WORDS), True).when(low.isin(*FALSE_WORDS), False))


def cast_timestamp(value: Column) -> Checked:
    return _cast(value, F.when(trimmed(value).rlike(MOMENT), as_timestamp(trimmed(value))))


CASTS = {"decimal": cast_decimal, "bigint": cast_bigint, "boolean": cast_boolean, "timestamp": cast_timestamp, "varchar": lambda v: (v, F.lit(_NEVER))}


def unit_convert(value: Column, source: str, target: str) -> Checked:
    """Decimal times the factor, two places; an unknown pair is an error of the mapping."""
    if (source, target) not in UNIT_FACTORS:
        raise ValueError(f"unknown unit conversion {source} -> {target}")
    exact = (value.try_cast("decimal(24,2)") * F.lit(UNIT_FACTORS[source, target]).cast("decimal(10,0)")).try_cast("decimal(34,2)")
    return _cast(value, exact)


def enum_map(value: Column, table: dict[str, object]) -> Checked:
    """Lookup by lower-cased, trimmed key; a miss fails, null stays null."""
    keys = {str(k).strip().lower(): v for k, v in table.items()}
    pairs = [F.lit(x) for kv in keys.items() for x in kv]
    return _cast(value, F.try_element_at(F.create_map(*pairs), F.lower(trimmed(value))) if pairs else F.lit(None))


def in_range(field: str, value: Column) -> Column:
    """True for null and for fields without a range."""
    if field not in SANITY:
        return F.lit(True)
    low, high = SANITY[field]
    above = value > low if field in ABOVE_LOWER_BOUND else value >= low
    return value.isNull() | (above & (value <= high))


def stable_id(source: Column, external_id: Column) -> Column:
    """SHA-256 of length, source and external id: no two pairs run together."""
    return F.sha2(F.concat(F.length(source).cast("string"), F.lit(":"), source, F.lit(":"), external_id), 256)


def fields_text(fields: dict[str, Column]) -> Column:
    """``k=v;k=v`` in order of name, a null shown as ``None``: the identity of rows without one of their own."""
    return F.concat_ws(";", *(F.concat(F.lit(f"{k}="), F.coalesce(fields[k].cast("string"), F.lit("None"))) for k in sorted(fields)))


def _beginning(text: Column, size: int) -> Column:
    """The first ``size`` bytes of a text, up to a whole character."""
    raw = F.encode(text, "UTF-8")
    cut = [F.substring(raw, F.lit(1), F.lit(max(0, size - k))) for k in range(4)]
    return F.coalesce(*(F.when(F.is_valid_utf8(c.cast("string")), F.decode(c, "UTF-8")) for c in cut))


def record_json(columns: list[str], limit: int = 200_000) -> Column:
    """The row as JSON with nulls; one of more bytes is replaced by its size and its first ``limit`` - 128 bytes, still valid JSON."""
    text = F.to_json(F.struct(*(F.col(f"`{c}`") for c in columns)), {"ignoreNullFields": "false"})
    short = F.to_json(F.struct(F.lit(True).alias("_truncated"), F.octet_length(text).alias("_original_bytes"), _beginning(text, max(0, limit - 128)).alias("_prefix")))
    return F.when(F.octet_length(text) > limit, short).otherwise(text)
