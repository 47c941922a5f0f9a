"""Declarative field mappings: TOML text, checked, then turned into one projection of Columns."""

from __future__ import annotations

import hashlib
import json
import re
import tomllib
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import primitives as P
from ..functions.schemas import simple_schema
from .rows import REASON

# The typed model of a listing. Service columns follow the mapped ones.
LISTING = simple_schema(
    "id string, source string, external_id string, price_rub decimal(12,2), area_m2 decimal(8,2), rooms bigint, floor bigint, floors_total bigint, "
    "metro_minutes bigint, address string, district string, style string, renovation_style string, has_renovation boolean, has_furniture boolean, "
    "photo_urls string, listed_at timestamp_ntz, ceiling_height_m decimal(4,2), wall_material string, year_built bigint, _source_run_id string, "
    "_source_content_hash string, _mapping_config_hash string, _ingested_at timestamp_ntz, _transformed_at timestamp_ntz, _transform_run_id string"
)
KEY = ("source", "external_id")
MANDATORY = ("price_rub", "area_m2")
MAPPABLE = tuple(f.name for f in LISTING if not f.name.startswith("_") and f.name not in ("id", *KEY))


class MappingError(ValueError):
    pass


@dataclass(frozen=True)
class Field:
    input: str | None = None
    regex_replace: tuple[str, str] | None = None
    regex_extract: str | None = None
    enum_map: dict | None = None
    cast: str = "varchar"
    unit_convert: tuple[str, str] | None = None
    default: object = None


#: Names of the steps that a field may have.
_STEPS = frozenset(Field.__dataclass_fields__)


@dataclass(frozen=True)
class Mapping:
    fields: dict[str, Field]
    external_id: str | None = None
    fingerprint: str = ""
    warnings: tuple[str, ...] = field(default=())


def _pair(spec: dict, step: str, first: str, second: str) -> tuple[str, str] | None:
    value = spec.get(step)
    if value is None:
        return None
    if isinstance(value, dict) and {first, second} <= set(value):
        return str(value[first]), str(value[second])
    if isinstance(value, list) and len(value) == 2:
        return str(value[0]), str(value[1])
    raise MappingError(f"{step} needs {first} and {second}")


def parse_mapping(text: str, mappable: tuple[str, ...] = MAPPABLE) -> Mapping:
    """A mapping from TOML; text that is none, no fields at all, unknown fields, steps, casts and units are errors."""
    try:
        config = tomllib.loads(text)
    except tomllib.TOMLDecodeError as e:
        raise MappingError(f"not valid TOML: {e}") from e
    fields = {}
    if not isinstance(config.get("fields"), dict) or not config["fields"]:
        raise MappingError("the mapping has no fields")
    for name, spec in config["fields"].items():
        if not isinstance(spec, dict):
            raise MappingError(f"field {name}: not a table")
        if name not in mappable:
            raise MappingError(f"unknown field {name}")
        if extra := set(spec) - _STEPS:
            raise MappingError(f"field {name}: unknown step {sorted(extra)}")
        if spec.get("cast", "varchar") not in P.CASTS:
            raise MappingError(f"field {name}: unknown cast {spec['cast']}")
        if "enum_map" in spec and not (isinstance(spec["enum_map"], dict) and spec["enum_map"]):
            raise MappingError(f"field {name}: enum_map must be a table with entries")
        extract = spec.get("regex_extract")
        extract = extract.get("pattern") if isinstance(extract, dict) else extract
        one = Field(spec.get("input"), _pair(spec, "regex_replace", "pattern", "replacement"), extract, spec.get("enum_map"), spec.get("cast", "varchar"), _pair(spec, "unit_convert", "from", "to"), spec.get("default"))
        if one.unit_convert and one.unit_convert not in P.UNIT_FACTORS:
            raise MappingError(f"field {name}: unknown unit conversion {one.unit_convert}")
        if one.default is not None and one.cast in ("decimal", "bigint"):
            if not re.fullmatch(r"[+-]?[0-9]{1,36}(\.[0-9]+)?" if one.cast == "decimal" else r"[+-]?[0-9]{1,18}", str(one.default)):
                raise MappingError(f"field {name}: the default {one.default!r} is not a {one.cast}")
        fields[name] = one
    return Mapping(fields, config.get("meta", {}).get("external_id"), hashlib.sha256(text.encode()).hexdigest())


def check_inputs(mapping: Mapping, columns: list[str]) -> list[str]:
    """Warnings about columns that no field reads; a missing input column is an error."""
    used = {f.input for f in mapping.fields.values() if f.input} | ({mapping.external_id} if mapping.external_id else set())
    if missing := sorted(used - set(columns)):
        raise MappingError(f"input columns missing: {missing}")
    return [f"column {c} is not mapped" for c in columns if c not in used and not c.startswith("_")]


def field_steps(name: str, spec: Field, kind: str) -> list[Callable[[Column], tuple[Column, list[tuple[Column, str]]]]]:
    """The steps of one field: replace, extract, look up or cast, convert, default, then the range and the type ``kind``.

    Each gives from a value the next one and what may be wrong with it, as (failed, reason).
    """
    steps = []

    def checked(run: Callable[[Column], P.Checked], text: str) -> None:
        def step(value: Column) -> tuple[Column, list[tuple[Column, str]]]:
            after, failed = run(value)
            return after, [(failed, f"{name}: {text}")]

        steps.append(step)

    def in_sane_range(value: Column) -> tuple[Column, list[tuple[Column, str]]]:
        number = value.try_cast("decimal(38,2)")
        return value, [(value.isNotNull() & number.isNull(), f"{name}: not a number"), (~P.in_range(name, number), f"{name}: outside sanity range")]

    def fitted(value: Column) -> P.Checked:
        typed = value.try_cast(kind)
        return typed, value.isNotNull() & typed.isNull()

    if spec.regex_replace:
        checked(lambda value: P.regex_replace(value, *spec.regex_replace), "value too long for a pattern")
    if spec.regex_extract:
        checked(lambda value: P.regex_extract(value, spec.regex_extract), "value too long for a pattern")
    if spec.enum_map is not None:
        checked(lambda value: P.enum_map(value, spec.enum_map), "not in dictionary")
    elif spec.cast != "varchar":
        checked(P.CASTS[spec.cast], f"not a {spec.cast}")
    if spec.unit_convert:
        checked(lambda value: P.unit_convert(value, *spec.unit_convert), "not a number, or too large once converted")
    if spec.default is not None:
        default = F.lit(spec.default).try_cast(kind) if spec.cast != "decimal" else F.lit(str(spec.default)).cast("decimal(38,2)")
        steps.append(lambda value: (F.coalesce(value, default), []))
    if name in P.SANITY:
        steps.append(in_sane_range)
    checked(fitted, "outside the range of its type")
    return steps


def _reason(failed: Column, text: str) -> Column:
    return F.when(F.coalesce(failed, F.lit(False)), F.lit(text))


def field_value(name: str, spec: Field, raw: Column, kind: str) -> tuple[Column, Column]:
    """(value, reason or null) of one field, as a single expression of ``raw``."""
    value, reasons = raw, []
    for step in field_steps(name, spec, kind):
        value, failures = step(value)
        reasons += [_reason(*f) for f in failures]
    return value, F.coalesce(*reasons)


def apply_mapping(bronze: DataFrame, mapping: Mapping, source: str, *, run_id: str, now: Column) -> DataFrame:
    """Bronze rows as listings, with ``_reason`` (null for valid rows) and the row's ordinal.

    Numbers reach the steps as text; doubles go through a decimal so that they never show an exponent. The steps of all
    fields are projections one after the other: a value is worked out once, not once for each step and check that follows.
    """
    kinds = dict(bronze.dtypes)

    def text(column: str) -> Column:
        c = F.col(f"`{column}`")
        if kinds[column] not in ("double", "float"):
            return c.cast("string")
        # a number beyond the decimal's range keeps its exponent, by which every numeric step rejects its row
        return F.coalesce(F.regexp_replace(c.try_cast("decimal(38,10)").cast("string"), r"\.?0+$", ""), c.cast("string"))

    specs = list(mapping.fields.items())
    inputs = sorted({spec.input for _, spec in specs if spec.input} | ({mapping.external_id} if mapping.external_id else set()))
    read = {c: F.col(f"_input_{i}") for i, c in enumerate(inputs)}
    rows = bronze.select("*", *(text(c).alias(f"_input_{i}") for i, c in enumerate(inputs)))
    steps = [field_steps(name, spec, LISTING[name].dataType.simpleString()) for name, spec in specs]
    at: list[Column] = [read[spec.input] if spec.input else F.lit(None).cast("string") for _, spec in specs]
    failed: list[list[Column]] = [[] for _ in specs]
    for k in range(max(map(len, steps))):
        made = []
        for i, todo in enumerate(steps):
            if k < len(todo):
                value, failures = todo[k](at[i])
                made.append(value.alias(f"_value_{i}_{k}"))
                made += [broken.alias(f"_failed_{i}_{k}_{j}") for j, (broken, _) in enumerate(failures)]
                at[i] = F.col(f"_value_{i}_{k}")
                failed[i] += [_reason(F.col(f"_failed_{i}_{k}_{j}"), text) for j, (_, text) in enumerate(failures)]
        rows = rows.select("*", *made)
    values = {name: F.lit(None).cast(LISTING[name].dataType) for name in MAPPABLE} | {name: at[i] for i, (name, _) in enumerate(specs)}
    reasons = [F.when(F.coalesce(read[mapping.external_id], F.lit("")) == "", "external id is empty")] if mapping.external_id else []
    reasons += [r for found in failed for r in found]
    reasons += [F.when(values[m].isNull(), f"{m} is missing") for m in MANDATORY]
    origin = F.lit(source)
    external = read[mapping.external_id] if mapping.external_id else P.stable_id(origin, P.fields_text({k: values[k] for k in MAPPABLE}))
    service = {
        "source": origin, "external_id": F.col("_external"), "_source_run_id": F.col("_run_id"), "_source_content_hash": F.col("_content_hash"),
        "_mapping_config_hash": F.lit(mapping.fingerprint), "_ingested_at": F.col("_ingested_at"), "_transformed_at": now, "_transform_run_id": F.lit(run_id),
    }
    every = values | service | {"id": P.stable_id(origin, F.col("_external"))}
    named = rows.select("*", external.alias("_external"))
    return named.select(*(F.col(f"`{c}`") for c in bronze.columns), F.coalesce(*reasons).alias(REASON), F.struct(*(every[f.name].cast(f.dataType).alias(f.name) for f in LISTING)).alias("_listing"))


def fingerprints(mappings: dict[str, Mapping]) -> list[tuple[str, str]]:
    return [(source, m.fingerprint) for source, m in mappings.items()]


def schema_json(mapping: Mapping) -> str:
    """What the run log keeps of a mapping."""
    return json.dumps({"mapping_config_hash": mapping.fingerprint})
