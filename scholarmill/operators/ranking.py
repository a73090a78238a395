"""University rankings and drill-downs by paper count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholarmill.functions.labs import (
    drilldown_summary,
    lab_summary,
    member_text,
    present,
    ranking_summary,
    size_class,
)
from scholarmill.operators.positions import with_positions
from scholarmill.operators.selection import drilldown_filter, ranking_filter
from scholarmill.operators.taxonomy import Selection, Taxonomy, listed, sub_field_dim, with_field_profile

LABS_PER_PAGE = 1000


def papers() -> Column:
    """Paper count, 0 when missing."""
    return F.coalesce("paper_count", F.lit(0))


def named_universities(universities: DataFrame) -> DataFrame:
    """Universities with a usable name."""
    return universities.where(present(F.col("name"))).select(
        F.col("id").alias("university_id"), F.col("name").alias("university")
    )


def roll_up(labs: DataFrame, universities: DataFrame) -> DataFrame:
    """Papers and labs per university name."""
    single = labs.select("university_id", papers().alias("paper_count"), F.lit(1).alias("lab_count"))
    return roll_up_groups(single, universities)


def roll_up_groups(
    groups: DataFrame, universities: DataFrame, by: tuple[str, ...] = ()
) -> DataFrame:
    """Sum (university_id, paper_count, lab_count) per university name.

    Rows are summed per university id before the join, so the join meets one row per university and
    no university is hot. The second sum merges universities of the same name.
    """
    sums = [F.sum(c).alias(c) for c in ("paper_count", "lab_count")]
    per_id = groups.groupBy(*by, "university_id").agg(*sums)
    named = per_id.join(named_universities(universities), "university_id")
    return named.groupBy(*by, "university").agg(*sums)


def ranked(totals: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Number the universities of each ``by`` group by papers, ties by name.

    Runs on rolled-up rows only: a window holds one row per university name.
    """
    order = Window.partitionBy(*by).orderBy(F.desc("paper_count"), "university")
    return totals.select(
        *by,
        F.row_number().over(order).cast("bigint").alias("rnk"),
        "university",
        "paper_count",
        "lab_count",
    )


def rank_universities(
    labs: DataFrame,
    universities: DataFrame,
    selection: Selection | None = None,
    enabled: list[str] | None = None,
    taxonomy: Taxonomy | None = None,
) -> DataFrame:
    """The ranking for one selection. The filter runs before anything is summed."""
    kept = labs.where(
        ranking_filter(F.col("research_sub_fields"), taxonomy or listed(), selection, enabled)
    )
    return ranked(roll_up(kept, universities))


def with_summary(ranking: DataFrame) -> DataFrame:
    return ranking.withColumn("summary", ranking_summary(F.col("paper_count"), F.col("lab_count")))


def lab_cells(labs: DataFrame) -> DataFrame:
    """Papers and labs per university and set of sub-field ids: labs of a cell always match together."""
    ids = F.array_sort(F.array_distinct("research_sub_fields")).alias("ids")
    return labs.groupBy("university_id", ids).agg(F.sum(papers()).alias("paper_count"), F.count("*").alias("lab_count"))


def rank_selections(
    labs: DataFrame,
    universities: DataFrame,
    selections: DataFrame,
    sub_fields: DataFrame,
    fields: DataFrame,
) -> DataFrame:
    """Rankings for a whole relation of selections (selection_id, field, sub_field) in one job.

    Labs of one university with the same set of ids always match together, and selections of the
    same sub-fields rank alike. Both sides are reduced to their distinct sets first, so a popular
    sub-field meets a popular selection once, not once per lab and selection.
    """
    return rank_cells(lab_cells(labs), universities, selections, sub_fields, fields)


def rank_cells(
    cells: DataFrame, universities: DataFrame, selections: DataFrame, sub_fields: DataFrame, fields: DataFrame
) -> DataFrame:
    """``rank_selections`` from the cells of the labs."""
    chosen = (
        selections.join(sub_field_dim(sub_fields, fields), ["field", "sub_field"])
        .groupBy("selection_id")
        .agg(F.array_sort(F.collect_set("sub_field_id")).alias("wanted"))  # at most the taxonomy
    )
    wanted = chosen.select("wanted").distinct().withColumn("sub_field_id", F.explode("wanted"))
    matched = (
        cells.withColumn("sub_field_id", F.explode("ids"))
        .join(wanted, "sub_field_id")
        .groupBy("wanted", "university_id", "ids")
        .agg(F.max("paper_count").alias("paper_count"), F.max("lab_count").alias("lab_count"))
    )
    rankings = ranked(roll_up_groups(matched, universities, ("wanted",)), ("wanted",))
    return chosen.join(rankings, "wanted").drop("wanted")


def _with_status(pairs: DataFrame) -> DataFrame:
    new, old = F.col("new_papers"), F.col("old_papers")
    return pairs.withColumn(
        "status",
        F.when(new.isNull(), "dropped").when(new == old, "kept").otherwise("changed"),
    )


def refresh_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Carry each university of a stored ranking into a new one: kept, changed or dropped."""
    before = old.select("university", F.col("paper_count").alias("old_papers"))
    after = new.select("university", F.col("paper_count").alias("new_papers"))
    return _with_status(before.join(after, "university", "left"))


def selection_diff(
    labs: DataFrame,
    universities: DataFrame,
    old: Selection,
    new: Selection,
    taxonomy: Taxonomy | None = None,
) -> DataFrame:
    """``refresh_diff`` of the rankings for two selections, from one pass over the labs."""
    ids, taxonomy = F.col("research_sub_fields"), taxonomy or listed()
    marked = labs.select(
        "university_id",
        F.when(ranking_filter(ids, taxonomy, old, None), papers()).alias("old_papers"),
        F.when(ranking_filter(ids, taxonomy, new, None), papers()).alias("new_papers"),
    )
    sums = [F.sum(c).alias(c) for c in ("old_papers", "new_papers")]
    per_id = marked.groupBy("university_id").agg(*sums)
    per_name = (
        per_id.join(named_universities(universities), "university_id")
        .groupBy("university")
        .agg(*sums)
        .where(F.col("old_papers").isNotNull())
    )
    return _with_status(per_name)


def directory(labs: DataFrame, universities: DataFrame) -> DataFrame:
    """One line per lab of a named university, as shown in result lists.

    ``lab_member_count`` is 0 when unknown, as in the ranking; the texts keep the difference.
    """
    members = F.col("lab_member_count")
    return labs.join(named_universities(universities), "university_id").select(
        F.col("id").cast("string").alias("id"),
        "name",
        "university",
        "department",
        papers().alias("paper_count"),
        F.coalesce(members, F.lit(0)).alias("lab_member_count"),
        "lab_url",
        "scholar_url",
        "dblp_url",
        present(F.col("lab_url")).alias("has_lab_url"),
        present(F.col("scholar_url")).alias("has_scholar_url"),
        present(F.col("dblp_url")).alias("has_dblp_url"),
        member_text(members).alias("member_text"),
        lab_summary(F.col("department"), papers(), members, F.col("university")).alias("summary"),
    )


def drilldown(
    labs: DataFrame,
    universities: DataFrame,
    selection: Selection | None = None,
    enabled: list[str] | None = None,
    taxonomy: Taxonomy | None = None,
) -> DataFrame:
    """Labs shown after opening a university, for all universities at once."""
    kept = labs.where(
        drilldown_filter(F.col("research_sub_fields"), taxonomy or listed(), selection, enabled)
    )
    return kept.join(named_universities(universities), "university_id").select(
        "id",
        "name",
        "university",
        papers().alias("paper_count"),
        size_class(F.col("lab_member_count")).alias("size"),
    )


def drilldown_totals(
    labs: DataFrame,
    universities: DataFrame,
    selection: Selection | None = None,
    enabled: list[str] | None = None,
    taxonomy: Taxonomy | None = None,
) -> DataFrame:
    kept = labs.where(
        drilldown_filter(F.col("research_sub_fields"), taxonomy or listed(), selection, enabled)
    )
    return roll_up(kept, universities).select(
        "university",
        F.col("paper_count").alias("total_papers"),
        "lab_count",
        drilldown_summary(F.col("paper_count"), F.col("lab_count")).alias("summary"),
    )


def labs_in_university(labs: DataFrame, universities: DataFrame) -> DataFrame:
    """Labs of each university by papers, with their exact place."""
    rows = labs.join(named_universities(universities), "university_id").select(
        "university", "id", papers().alias("paper_count")
    )
    return with_positions(rows, ["university"], [F.desc("paper_count"), F.col("id")])


def lab_pages(
    labs: DataFrame,
    universities: DataFrame,
    page_size: int = LABS_PER_PAGE,
    taxonomy: Taxonomy | None = None,
) -> DataFrame:
    """Each university's labs as nested lists in paper order: (university, page, labs).

    A page holds at most ``page_size`` labs, so the nested form never puts a whole university into
    one row, and the pages of a university hold all its labs.
    """
    profiled = with_field_profile(labs, taxonomy or listed()).join(named_universities(universities), "university_id")
    rows = profiled.select(
        "university",
        "id",
        "name",
        "department",
        papers().alias("paper_count"),
        F.coalesce("lab_member_count", F.lit(0)).alias("lab_member_count"),
        "lab_url",
        "scholar_url",
        "dblp_url",
        "research_fields",
    )
    placed = with_positions(rows, ["university"], [F.desc("paper_count"), F.col("id")])
    entry = F.struct("pos", *[c for c in rows.columns if c != "university"])
    return placed.groupBy(
        "university", F.floor((F.col("pos") - 1) / page_size).alias("page")
    ).agg(F.array_sort(F.collect_list(entry)).alias("labs"))
