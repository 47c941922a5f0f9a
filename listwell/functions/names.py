"""Column names fit for any catalog."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame


def clean_name(raw: str | None) -> str:
    """Lower-case ASCII letters, digits and underscores; '' if nothing is left.

    A leading digit gets ``c_`` in front; a leading underscore is kept for service columns, so a user's gets ``u``.
    """
    name = re.sub("[^a-z0-9_]", "_", (raw or "").strip().lower())
    if not name.strip("_"):
        return ""
    return f"c_{name}" if name[0].isdigit() else f"u{name}" if name[0] == "_" else name


def clean_names(raw: Sequence[str | None]) -> list[str]:
    """Unique clean names in order: an empty one becomes ``col_<position>``, a taken one gets ``_2``, ``_3``, ..."""
    taken: dict[str, int] = {}
    for at, name in enumerate(raw):
        base = clean_name(name) or f"col_{at}"
        unique, k = base, taken.get(base, 0) + 1
        while unique in taken:
            k += 1
            unique = f"{base}_{k}"
        taken[base] = max(k - 1, taken.get(base, 0))
        taken[unique] = taken.get(unique, 0)
    return list(taken)


def with_clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*clean_names(df.columns))
