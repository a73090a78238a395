"""Exact positions inside ordered groups, however large one group is."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from scholarmill.session import stored


def sorted_slices(
    df: DataFrame, keys: list[str], order: list[Column], name: str | None = None
) -> DataFrame:
    """Sort ``df`` by range and store it with ``_row`` (global order) and ``_slice`` (sort partition).

    The range boundaries use the whole (keys, order) tuple, so a group of any size spreads over as
    many slices as it needs. ``order`` must end in a unique column.
    """
    numbered = df.orderBy(*keys, *order).withColumn("_row", F.monotonically_increasing_id())
    return stored(numbered.withColumn("_slice", F.shiftright("_row", 33)), name)


def join_slices(rows: DataFrame, per_slice: DataFrame, keys: list[str]) -> DataFrame:
    """Bring per-slice values to the rows of the slice. Keys compare null-safe."""
    names = [*keys, "_slice"]
    values = [c for c in per_slice.columns if c not in names]
    right = per_slice.select(*[F.col(n).alias(f"_of_{n}") for n in names], *values)
    match = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_of_{n}")) for n in names])
    return rows.join(right, match).drop(*[f"_of_{n}" for n in names])


def before(keys: list[str]) -> WindowSpec:
    """Window over all earlier slices of the group: one row per slice, never the group's rows."""
    return Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)


def with_positions(
    df: DataFrame, keys: list[str], order: list[Column], name: str = "pos"
) -> DataFrame:
    """Add the 1-based position of every row within its group.

    A row window over the group would run a third of all rows through one task if one key held them.
    Here each slice counts its own rows and only the per-slice counts are summed up.
    """
    rows = sorted_slices(df, keys, order)
    slices = rows.groupBy(*keys, "_slice").agg(
        F.min("_row").alias("_first"), F.count("*").alias("_n")
    )
    offsets = slices.withColumn("_before", F.coalesce(F.sum("_n").over(before(keys)), F.lit(0)))
    position = F.col("_row") - F.col("_first") + F.col("_before") + 1
    return join_slices(rows, offsets, keys).select(*df.columns, position.alias(name))
