"""Lab detail: the nested view built from the bridge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.operators.ranking import named_universities


def lab_detail(
    labs: DataFrame,
    universities: DataFrame,
    lab_fields: DataFrame,
    lab_sub_fields: DataFrame,
    fields: DataFrame,
    sub_fields: DataFrame,
    lab_id=None,
) -> DataFrame:
    """One row per lab with ``research_fields`` array<struct<category, field, sub_fields>>.

    Bridge rows without a parent in the dimension are dropped, labs and fields without children keep
    an empty array. Bridge pairs are keys, so an array holds at most the taxonomy.
    """
    if lab_id is not None:
        labs = labs.where(F.col("id") == lab_id)
        lab_fields = lab_fields.where(F.col("professor_id") == lab_id)
        # The lab's few field ids come first, so that the second bridge is not grouped as a whole.
        lab_sub_fields = lab_sub_fields.join(
            lab_fields.select(F.col("id").alias("professor_research_field_id")),
            "professor_research_field_id",
            "left_semi",
        )

    children = (
        lab_sub_fields.join(
            sub_fields.select(F.col("id").alias("sub_field_id"), "name"), "sub_field_id"
        )
        .groupBy(F.col("professor_research_field_id").alias("id"))
        .agg(F.array_sort(F.collect_set(F.struct("sub_field_id", "name"))).alias("_named"))
    )
    parents = lab_fields.join(
        fields.select(F.col("id").alias("field_id"), F.col("name").alias("field"), "category_id"),
        "field_id",
    )
    no_names = F.array().cast("array<string>")
    entry = F.struct(
        "field_id",
        F.col("category_id").cast("string").alias("category"),
        "field",
        F.coalesce(F.transform("_named", lambda s: s["name"]), no_names).alias("sub_fields"),
    )
    per_lab = (
        parents.join(children, "id", "left")
        .groupBy(F.col("professor_id").alias("id"))
        .agg(F.array_sort(F.collect_set(entry)).alias("_entries"))
    )
    profile = F.transform(
        F.coalesce("_entries", F.array()),
        lambda e: F.struct(e["category"].alias("category"), e["field"].alias("field"),
                           e["sub_fields"].alias("sub_fields")),
    )
    return (
        labs.join(named_universities(universities), "university_id")
        .join(per_lab, "id", "left")
        .select(
            "id",
            "name",
            "university",
            "department",
            F.col("paper_count").alias("paper_count"),
            F.lit(1).cast("bigint").alias("lab_count"),
            F.coalesce("lab_member_count", F.lit(0)).alias("lab_member_count"),
            profile.alias("research_fields"),
        )
    )


def detail_rows(detail: DataFrame) -> DataFrame:
    """The nested view flattened: one row per lab and field, labs without fields once."""
    return detail.select(
        "id", "university", "lab_count", F.explode_outer("research_fields").alias("f")
    ).select(
        "id",
        "university",
        "lab_count",
        F.col("f.category").alias("category"),
        F.col("f.field").alias("field"),
        F.array_join("f.sub_fields", ", ").alias("sub_fields"),
    )
