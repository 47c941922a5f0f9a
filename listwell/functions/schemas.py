"""Schemas from text without a session, so that modules can declare them."""

from __future__ import annotations

import re

from pyspark.sql import types as T

_PLAIN = {"string": T.StringType, "bigint": T.LongType, "int": T.IntegerType, "double": T.DoubleType, "boolean": T.BooleanType, "date": T.DateType, "timestamp_ntz": T.TimestampNTZType}


def simple_schema(text: str) -> T.StructType:
    """Columns of flat types, as ``name type, name type``."""
    fields = []
    for name, kind in re.findall(r"(\w+) (decimal\(\d+,\d+\)|\w+)", text):
        sizes = re.findall(r"\d+", kind) if kind.startswith("decimal") else None
        fields.append(T.StructField(name, T.DecimalType(*map(int, sizes)) if sizes else _PLAIN[kind]()))
    return T.StructType(fields)
