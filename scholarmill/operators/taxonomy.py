"""The two-level taxonomy and the research-field profile of a lab."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from scholarmill import schemas
from scholarmill.constants import AREAS, taxonomy_rows
from scholarmill.functions.literals import constant_map


def constant_relation(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small relation held in the plan itself. Its exact size is known to the planner, so joins
    broadcast it without a hint."""
    typed = T.StructType.fromDDL(schema)
    columns = list(zip(*rows))
    table = pa.table(
        [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, typed.fields)],
        names=typed.names,
    )
    return spark.createDataFrame(table, typed)


def taxonomy(spark: SparkSession) -> DataFrame:
    """One row per sub-field."""
    return constant_relation(spark, taxonomy_rows(), schemas.TAXONOMY)


def areas(spark: SparkSession) -> DataFrame:
    return constant_relation(spark, AREAS, schemas.AREAS)


def research_fields(spark: SparkSession) -> DataFrame:
    rows = {(row[2], row[3], row[0]) for row in taxonomy_rows()}
    return constant_relation(spark, sorted(rows), schemas.RESEARCH_FIELDS)


def research_sub_fields(spark: SparkSession) -> DataFrame:
    rows = [(row[4], row[5], row[2]) for row in taxonomy_rows()]
    return constant_relation(spark, rows, schemas.RESEARCH_SUB_FIELDS)


#: Sub-fields that a taxonomy may have to be held as a value in the plan. Beyond it, ``field_profile_rows``
#: and ``keep_selected`` do the same by joins.
MOST_SUB_FIELDS = 5000

Selection = dict[str, list[str]]


class Taxonomy:
    """A taxonomy small enough to be held in the plan: rows as ``constants.taxonomy_rows`` has them."""

    def __init__(self, rows: list[tuple[int, str, int, str, int, str]]):
        self.rows = rows

    @classmethod
    def stored(cls, sub_fields: DataFrame, fields: DataFrame) -> Taxonomy:
        """The taxonomy of two relations. Their size is checked; a larger one is refused."""
        dim = sub_field_dim(sub_fields, fields).orderBy("sub_field_id").limit(MOST_SUB_FIELDS + 1).collect()
        if len(dim) > MOST_SUB_FIELDS:
            raise ValueError(f"over {MOST_SUB_FIELDS} sub-fields: use field_profile_rows and keep_selected")
        return cls([(int(r.category), "", r.field_id, r.field, r.sub_field_id, r.sub_field) for r in dim])

    def selected_ids(self, selection: Selection) -> list[int]:
        return [row[4] for row in self.rows if row[5] in selection.get(row[3], [])]

    def field_ids(self, fields: Iterable[str]) -> list[int]:
        wanted = set(fields)
        return [row[4] for row in self.rows if row[3] in wanted]

    def by_id(self, place: int) -> Column:
        """Map from sub-field id to one column of the rows."""
        return constant_map([(row[4], row[place]) for row in self.rows])


def listed() -> Taxonomy:
    """The taxonomy of the fixed values."""
    return Taxonomy(taxonomy_rows())


def sub_field_dim(sub_fields: DataFrame, fields: DataFrame) -> DataFrame:
    """Sub-fields with the name and category of their field."""
    parent = fields.select(
        F.col("id").alias("field_id"), F.col("name").alias("field"), "category_id"
    )
    return sub_fields.join(parent, "field_id").select(
        F.col("id").alias("sub_field_id"),
        F.col("name").alias("sub_field"),
        "field_id",
        "field",
        F.col("category_id").cast("string").alias("category"),
    )


def with_field_profile(labs: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """Add ``research_fields``: array<struct<category, field, sub_fields>> in first-seen order.

    The taxonomy is held in the plan, so the id lookup is a map literal and nothing is shuffled. Unknown
    ids are dropped, repeated ids give repeated names, a field found under two categories keeps the
    first, and a lab without any match keeps an empty profile.
    """
    lookup = constant_map(
        [
            (row[4], {"category": str(row[0]), "field": row[3], "sub_field": row[5]})
            for row in taxonomy.rows
        ]
    )

    def one_field(field: Column) -> Column:
        mine = F.filter("_found", lambda s: s["field"] == field)
        return F.struct(
            F.get(mine, 0)["category"].alias("category"),
            field.alias("field"),
            F.transform(mine, lambda s: s["sub_field"]).alias("sub_fields"),
        )

    ids = F.coalesce("research_sub_fields", F.array().cast("array<bigint>"))
    found = F.filter(F.transform(ids, lambda i: lookup[i]), lambda s: s.isNotNull())
    names = F.array_distinct(F.transform("_found", lambda s: s["field"]))
    return (
        labs.withColumn("_found", found)
        .withColumn("research_fields", F.transform(names, one_field))
        .drop("_found")
    )


def field_profile_rows(labs: DataFrame, dim: DataFrame) -> DataFrame:
    """The same profile by join, for a sub-field table of any size: one row per lab and field.

    ``sub_fields`` is ordered as in the lab's id array. A group holds at most one lab's array.
    """
    ids = labs.select("id", F.posexplode("research_sub_fields").alias("pos", "sub_field_id"))
    return (
        ids.join(dim, "sub_field_id")
        .groupBy("id", "field")
        .agg(
            F.min("pos").alias("first_pos"),
            F.min_by("category", "pos").alias("category"),
            F.array_sort(F.collect_list(F.struct("pos", "sub_field"))).alias("_named"),
        )
        .withColumn("sub_fields", F.transform("_named", lambda s: s["sub_field"]))
        .drop("_named")
    )


def sub_field_usage(labs: DataFrame, sub_fields: DataFrame, fields: DataFrame) -> DataFrame:
    """Flat taxonomy with the labs and papers under each sub-field; unused sub-fields show 0."""
    used = (
        labs.select(
            F.explode(F.array_distinct("research_sub_fields")).alias("sub_field_id"), "paper_count"
        )
        .groupBy("sub_field_id")
        .agg(F.count("*").alias("n_labs"), F.sum(F.coalesce("paper_count", F.lit(0))).alias("papers"))
    )
    return sub_field_dim(sub_fields, fields).join(used, "sub_field_id", "left").select(
        "category",
        "field",
        "sub_field",
        "sub_field_id",
        F.coalesce("n_labs", F.lit(0)).alias("n_labs"),
        F.coalesce("papers", F.lit(0)).alias("papers"),
    )


def area_usage(spark: SparkSession, labs: DataFrame) -> DataFrame:
    """Members of every area with the number of labs holding each sub-field id."""
    used = (
        labs.select(F.explode(F.array_distinct("research_sub_fields")).alias("sub_field_id"))
        .groupBy("sub_field_id")
        .agg(F.count("*").alias("n_labs"))
    )
    members = areas(spark).select(
        F.col("id").alias("area"),
        F.col("name").alias("area_name"),
        F.explode("sub_field_ids").alias("sub_field_id"),
    )
    return members.join(used, "sub_field_id", "left").select(
        "area", "area_name", "sub_field_id", F.coalesce("n_labs", F.lit(0)).alias("n_labs")
    )
