"""Paper counts over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholarmill.operators.taxonomy import Taxonomy, listed


def fields_of(ids: Column, taxonomy: Taxonomy) -> Column:
    """Distinct field names reached by an id array."""
    lookup = taxonomy.by_id(3)
    return F.array_distinct(
        F.filter(F.transform(ids, lambda i: lookup[i]), lambda f: f.isNotNull())
    )


def paper_trend(papers: DataFrame, labs: DataFrame, taxonomy: Taxonomy | None = None) -> DataFrame:
    """Papers per field and year with the change from the year before.

    ``papers`` is one row per paper (lab_id, year). Papers are counted per lab and year before they
    meet the labs, so a lab with a third of all papers adds one row per year to the join. Between a
    field's first and last year every year has a row, with 0 papers if there are none, so a change is
    always from the calendar year before. Papers without a year are left out.
    """
    yearly = papers.where("year IS NOT NULL").groupBy("lab_id", "year").agg(F.count("*").alias("n"))
    reached = fields_of(F.col("research_sub_fields"), taxonomy or listed())
    lab_fields = labs.select(F.col("id").alias("lab_id"), F.explode(reached).alias("field"))
    totals = yearly.join(lab_fields, "lab_id").groupBy("field", "year").agg(F.sum("n").alias("papers"))
    by_year = Window.partitionBy("field").orderBy("year")
    # Each year is followed by the empty years up to the next one: rows of fields and years, not of papers.
    following = F.coalesce(F.lead("year").over(by_year), F.col("year") + 1)
    years = totals.withColumn("until", following).select(
        "field", F.explode(F.sequence("year", F.col("until") - 1)).alias("at"), "year", "papers"
    )
    filled = years.select("field", F.col("at").alias("year"), F.when(F.col("at") == F.col("year"), F.col("papers")).otherwise(0).alias("papers"))
    return filled.withColumn("change", F.col("papers") - F.lag("papers").over(by_year))
