"""Texts and classes shown for a lab or a university."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scholarmill.constants import (
    LARGE_LAB,
    MEDIUM_LAB,
    SIZE_CRITERIA,
    SIZE_LABELS,
    UNKNOWN,
)
from scholarmill.functions.literals import constant_map


def present(text: Column) -> Column:
    """True when a text is neither NULL nor empty."""
    return F.coalesce(text != "", F.lit(False))


def size_class(members: Column) -> Column:
    """large / medium / small / unknown; NULL and 0 members are unknown, a negative count is small."""
    return (
        F.when(members.isNull() | (members == 0), "unknown")
        .when(members >= LARGE_LAB, "large")
        .when(members >= MEDIUM_LAB, "medium")
        .otherwise("small")
    )


def size_label(size: Column) -> Column:
    return constant_map(list(SIZE_LABELS.items()))[size]


def size_text(size: Column) -> Column:
    """Long label; the unknown class carries no noun."""
    return F.when(size == "unknown", UNKNOWN).otherwise(F.concat(size_label(size), F.lit(" 연구실")))


def size_criteria(size: Column) -> Column:
    return constant_map(list(SIZE_CRITERIA.items()))[size]


def member_text(members: Column) -> Column:
    return F.when(members.isNull(), UNKNOWN).otherwise(F.concat(members.cast("string"), F.lit("명")))


def lab_summary(
    department: Column, papers: Column, members: Column, university: Column | None = None
) -> Column:
    """One line per lab; the university leads where labs of several universities are listed."""
    parts = [
        department,
        F.format_string("논문 %d편", papers),
        F.concat(F.lit("연구원 "), member_text(members)),
    ]
    return F.concat_ws(" | ", *([] if university is None else [university]), *parts)


def ranking_summary(papers: Column, labs: Column) -> Column:
    return F.format_string("총 논문 수: %d편 | 연구실: %d개", papers, labs)


def drilldown_summary(papers: Column, labs: Column) -> Column:
    return F.format_string("총 논문 수: %d | 연구실: %d개", papers, labs)
