"""Validation, quarantine, key checks and latest-wins loading."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarmill.functions.rules import Rules, failures
from scholarmill.operators.state import latest


@dataclass(frozen=True)
class Unique:
    """The values of ``columns`` occur once; every row of a value that occurs again fails, and so does a NULL."""

    label: str
    columns: list[str]


@dataclass(frozen=True)
class Reference:
    """``column`` is a ``key`` of ``targets``; a NULL is none."""

    label: str
    column: str
    targets: DataFrame
    key: str


def set_checked(rows: DataFrame, rules: Rules, sets: list[Unique | Reference]) -> DataFrame:
    """``checked`` with rules over sets of rows, whose labels come after those of the row rules.

    Keys are counted with partial sums and only those that occur again are joined back, so a key of a
    third of all rows costs one row of the join; targets are reduced to their distinct keys.
    """
    names = rows.columns
    marked, failed = rows.withColumn("_failed", failures(rules)), []
    for i, rule in enumerate(sets):
        flag = f"_set{i}"
        failed.append(F.when(F.col(flag), rule.label))
        if isinstance(rule, Unique):
            again = rows.groupBy(*rule.columns).agg(F.count("*").alias("_n")).where("_n > 1")
            again = again.select(*rule.columns, F.lit(True).alias("_again"))
            unknown = reduce(or_, [F.col(c).isNull() for c in rule.columns])
            marked = marked.join(again, rule.columns, "left").withColumn(flag, unknown | F.col("_again").isNotNull()).drop("_again")
        else:
            known = rule.targets.where(F.col(rule.key).isNotNull()).select(F.col(rule.key).alias(rule.column)).distinct()
            marked = marked.join(known.withColumn("_known", F.lit(True)), rule.column, "left")
            marked = marked.withColumn(flag, F.col("_known").isNull()).drop("_known")
    every = F.concat("_failed", F.array_compact(F.array(*failed))) if failed else F.col("_failed")
    return _told(marked.withColumn("_failed", every)).select(*names, "status", "reasons")


def checked(rows: DataFrame, rules: Rules) -> DataFrame:
    """Add ``status`` (valid / quarantine) and the reasons, joined."""
    return _told(rows.withColumn("_failed", failures(rules)))


def _told(marked: DataFrame) -> DataFrame:
    return (
        marked.withColumn("status", F.when(F.size("_failed") == 0, "valid").otherwise("quarantine"))
        .withColumn("reasons", F.array_join("_failed", ","))
        .drop("_failed")
    )


def split(rows: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with reasons)."""
    marked = checked(rows, rules)
    valid = marked.where(F.col("status") == "valid").drop("status", "reasons")
    return valid, marked.where(F.col("status") == "quarantine").drop("status")


def exists_once(probes: DataFrame, targets: DataFrame, key: str, strict: bool = True) -> DataFrame:
    """Whether a probe key matches exactly one target row; any match when not ``strict``."""
    matches = targets.groupBy(key).agg(F.count("*").alias("_n"))
    found = F.col("_n") == 1 if strict else F.col("_n") >= 1
    return probes.join(matches, key, "left").select(
        *probes.columns, F.coalesce(found, F.lit(False)).alias("exists")
    )


def upsert(
    current: DataFrame, incoming: DataFrame, keys: list[str], order: list[str]
) -> DataFrame:
    """The table after loading ``incoming``: one row per key, the latest by ``order``."""
    return latest(current.unionByName(incoming), keys, order)


def with_fallback(
    primary: Column, secondary: Column, value: str = "papers", source: str = "source"
) -> list[Column]:
    """Value from the first source that has one, 0 when none has, and where it came from."""
    origin = (
        F.when(primary.isNotNull(), "primary")
        .when(secondary.isNotNull(), "secondary")
        .otherwise("none")
    )
    return [F.coalesce(primary, secondary, F.lit(0)).alias(value), origin.alias(source)]
