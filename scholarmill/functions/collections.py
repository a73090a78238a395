"""Edits of array and map columns. A NULL array counts as empty."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scholarmill.constants import NO_FIELDS_TEXT


def contains(items: Column, item: Column) -> Column:
    return F.coalesce(F.array_contains(items, item), F.lit(False))


def toggle_item(items: Column, item: Column) -> Column:
    """Remove every copy of ``item`` when it is there, append it when it is not."""
    held = F.coalesce(items, F.array().cast("array<string>"))
    return F.when(contains(held, item), F.array_remove(held, item)).otherwise(
        F.array_append(held, item)
    )


def without_key(mapping: Column, key: Column) -> Column:
    return F.map_filter(mapping, lambda k, _: k != key)


def with_entry(mapping: Column, key: Column, value: Column) -> Column:
    """Set ``key``, replacing the value it had."""
    return F.map_concat(without_key(mapping, key), F.create_map(key, value))


def items_at(mapping: Column, key: Column) -> Column:
    """The array under ``key``; empty when the key is missing."""
    return F.coalesce(mapping[key], F.array().cast("array<string>"))


def key_count(mapping: Column) -> Column:
    return F.size(F.map_keys(mapping))


def ids_text(ids: Column) -> Column:
    """Ids joined by a comma, or a fixed text when there are none."""
    joined = F.array_join(ids.cast("array<string>"), ", ")
    return F.coalesce(F.nullif(joined, F.lit("")), F.lit(NO_FIELDS_TEXT))


def names_text(profile: Column) -> Column:
    """All sub-field names of a field profile, field after field, joined by a comma."""
    return F.array_join(F.flatten(F.transform(profile, lambda f: f["sub_fields"])), ", ")
