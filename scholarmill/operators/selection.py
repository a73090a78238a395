"""Filters by field, sub-field and area.

A selection is ``{field: [sub-field, ...]}``. With a taxonomy held in the plan it resolves to a set of
sub-field ids before the query runs, and the nested test "has some selected field and shares one of its
selected sub-fields" becomes an overlap of two id arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarmill.constants import AREAS
from scholarmill.functions.literals import bigints
from scholarmill.operators.taxonomy import Selection, Taxonomy


def overlaps(ids: Column, wanted: list[int]) -> Column:
    """True when the arrays share an id; false for a NULL array."""
    if not wanted:
        return F.lit(False)
    return F.coalesce(F.arrays_overlap(ids, bigints(wanted)), F.lit(False))


def ranking_filter(
    ids: Column, taxonomy: Taxonomy, selection: Selection | None, enabled: list[str] | None
) -> Column:
    """Selected sub-fields override enabled fields; with neither, every lab passes."""
    if selection:
        return overlaps(ids, taxonomy.selected_ids(selection))
    if enabled:
        return overlaps(ids, taxonomy.field_ids(enabled))
    return F.lit(True)


def drilldown_filter(
    ids: Column, taxonomy: Taxonomy, selection: Selection | None, enabled: list[str] | None
) -> Column:
    """Enabled fields or selected sub-fields; with neither, no lab passes."""
    return overlaps(ids, taxonomy.field_ids(enabled or [])) | overlaps(
        ids, taxonomy.selected_ids(selection or {})
    )


def profile_filter(profile: Column, selection: Selection) -> Column:
    """The sub-field test on a nested profile, for profiles that carry names and no ids."""

    def test(field: str, names: list[str]) -> Column:
        wanted = F.array(*[F.lit(n) for n in names]).cast("array<string>")
        return F.exists(
            profile,
            lambda f: (f["field"] == field) & F.arrays_overlap(f["sub_fields"], wanted),
        )

    matched = F.lit(False)
    for field, names in selection.items():
        matched = matched | test(field, names)
    return F.coalesce(matched, F.lit(False))


def keep_selected(labs: DataFrame, lab_fields: DataFrame, selection: DataFrame) -> DataFrame:
    """The sub-field test by semi-joins, for a selection relation (field, sub_field) of any size.

    ``lab_fields`` is one row per (id, field, sub_field).
    """
    matching = lab_fields.join(selection, ["field", "sub_field"], "left_semi")
    return labs.join(matching, "id", "left_semi")


def area_filter(ids: Column, area: str | None) -> Column:
    """No area keeps all labs, an unknown area none."""
    if not area:
        return F.lit(True)
    return overlaps(ids, next((members for a, _, members in AREAS if a == area), []))


def areas_of(ids: Column) -> Column:
    """Array of the areas an id array reaches."""
    return F.array_compact(F.array(*[F.when(overlaps(ids, m), a) for a, _, m in AREAS]))
