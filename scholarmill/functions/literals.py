"""Constant lookups as one SQL literal: a map of a few dozen entries costs one call to the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_text(value) -> str:
    """SQL literal of a text, a whole number (bigint), a dict (struct) or a list of pairs (map)."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, int):
        return f"{value}L"
    if isinstance(value, dict):
        fields = ", ".join(f"'{name}', {sql_text(v)}" for name, v in value.items())
        return f"named_struct({fields})"
    return "map(" + ", ".join(f"{sql_text(k)}, {sql_text(v)}" for k, v in value) + ")"


def constant_map(pairs: list[tuple]) -> Column:
    """Map literal; whole-number keys are bigint. A missing key gives NULL."""
    return F.expr(sql_text(pairs))


def bigints(values: list[int]) -> Column:
    """Array literal of bigint."""
    return F.expr("array(" + ", ".join(sql_text(v) for v in values) + ")")
