"""A bitmap index of labs: how many match a selection, without reading a lab.

The index has, for every value of a dimension and every range of lab numbers, one bitmap of the labs that
have the value. The labs of a selection are the union of its values' bitmaps, those of a selection within
a university the intersection of that union with the university's bitmap, range by range. Ranges are
independent of each other, so no value's labs ever meet in one task, however many there are.

Labs are numbered by their id if it is a whole number, else by ``numbered``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarmill.operators.positions import with_positions

SUB_FIELD, UNIVERSITY = "sub_field", "university"


def numbered(labs: DataFrame) -> DataFrame:
    """Labs with ``number``, from 1 in the order of their ids, which are unique."""
    return with_positions(labs, [], [F.col("id")], "number")


def _bitmaps(pairs: DataFrame, dimension: str) -> DataFrame:
    """``pairs`` (value, number), each taken once or more often: a bitmap does not count."""
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("labs")
    place = F.bitmap_bucket_number("number").alias("place")
    return pairs.groupBy(F.lit(dimension).alias("dimension"), "value", place).agg(bits)


def lab_index(labs: DataFrame, number: str = "number") -> DataFrame:
    """(dimension, value, place, labs): the labs of each sub-field and each university.

    ``value`` is the id as text. Labs without a number or value are in no bitmap.
    """
    numbers = labs.select(F.col(number).cast("bigint").alias("number"), "university_id", "research_sub_fields")
    known = numbers.where("number IS NOT NULL")
    by_sub_field = known.select(F.explode(F.col("research_sub_fields").cast("array<string>")).alias("value"), "number")
    by_university = known.select(F.col("university_id").cast("string").alias("value"), "number")
    return _bitmaps(by_sub_field.where("value IS NOT NULL"), SUB_FIELD).unionByName(
        _bitmaps(by_university.where("value IS NOT NULL"), UNIVERSITY)
    )


def _united(index: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """(key, place, labs): the union of the sub-fields (key, sub_field_id) that each key wants."""
    values = wanted.select(key, F.col("sub_field_id").cast("string").alias("value")).distinct()
    mine = index.where(F.col("dimension") == SUB_FIELD).join(values, "value")
    return mine.groupBy(key, "place").agg(F.bitmap_or_agg("labs").alias("labs"))


def _n_labs() -> Column:
    return F.coalesce(F.sum(F.bitmap_count("labs")), F.lit(0)).cast("bigint").alias("n_labs")


def matching_labs(index: DataFrame, wanted: DataFrame, key: str = "selection_id") -> DataFrame:
    """Number of labs with any of the sub-fields (key, sub_field_id) of each key; 0 where there is none."""
    found = _united(index, wanted, key)
    return wanted.select(key).distinct().join(found, key, "left").groupBy(key).agg(_n_labs())


def matching_labs_by_university(index: DataFrame, wanted: DataFrame, key: str = "selection_id") -> DataFrame:
    """(key, university_id as text, n_labs) of every university that has a matching lab."""
    places = index.where(F.col("dimension") == UNIVERSITY).select(F.col("value").alias("university_id"), "place", F.col("labs").alias("own"))
    both = _united(index, wanted, key).join(places, "place")
    # Two bitmaps of the same range, as two rows, since intersection is an aggregate.
    sides = both.select(key, "university_id", "place", F.explode(F.array("labs", "own")).alias("labs"))
    met = sides.groupBy(key, "university_id", "place").agg(F.bitmap_and_agg("labs").alias("labs"))
    return met.groupBy(key, "university_id").agg(_n_labs()).where("n_labs > 0")
