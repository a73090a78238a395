"""Bookmarks of all users at once. A bookmark is a pair (user_id, lab_id); duplicates count once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.operators.positions import with_positions
from scholarmill.operators.ranking import named_universities
from scholarmill.operators.selection import areas_of

PAIR = ["user_id", "lab_id"]
IDS_PER_PAGE = 1000


def pairs(bookmarks: DataFrame, user_id=None) -> DataFrame:
    """Distinct bookmarks, of one user when ``user_id`` is given."""
    rows = bookmarks.select(*PAIR)
    if user_id is not None:
        rows = rows.where(F.col("user_id") == user_id)
    return rows.distinct()


def bookmarked_labs(
    bookmarks: DataFrame, labs: DataFrame, universities: DataFrame, user_id=None
) -> DataFrame:
    """The bookmarked labs with their university: one join where a client would send an id list."""
    found = labs.join(named_universities(universities), "university_id").withColumnRenamed(
        "id", "lab_id"
    )
    return pairs(bookmarks, user_id).join(found, "lab_id")


def bookmarks_by_area(bookmarks: DataFrame, labs: DataFrame) -> DataFrame:
    """Bookmarks under every area their lab belongs to."""
    tagged = labs.select(
        F.col("id").alias("lab_id"), F.explode(areas_of(F.col("research_sub_fields"))).alias("area")
    )
    return pairs(bookmarks).join(tagged, "lab_id").select("user_id", "area", "lab_id")


def bookmark_counts(bookmarks: DataFrame) -> DataFrame:
    return pairs(bookmarks).groupBy("user_id").agg(F.count("*").alias("n"))


def bookmark_key_lists(bookmarks: DataFrame, page_size: int = IDS_PER_PAGE) -> DataFrame:
    """Lab ids of every user as sorted, joined lists: one row per page of ``page_size`` ids.

    Pages keep a row small for a user who bookmarked millions of labs; no id is left out.
    """
    placed = with_positions(pairs(bookmarks), ["user_id"], [F.col("lab_id")])
    page = F.floor((F.col("pos") - 1) / page_size).alias("page")
    return (
        placed.groupBy("user_id", page)
        .agg(
            F.count("*").alias("n"),
            F.array_sort(F.collect_list("lab_id")).cast("array<string>").alias("_ids"),
        )
        .select("user_id", "page", "n", F.array_join("_ids", ", ").alias("lab_ids"))
    )


def bookmark_flags(probes: DataFrame, bookmarks: DataFrame) -> DataFrame:
    """Whether each probed pair is bookmarked."""
    held = pairs(bookmarks).withColumn("_held", F.lit(True))
    return probes.join(held, PAIR, "left").select(
        *probes.columns, F.coalesce("_held", F.lit(False)).alias("is_bookmarked")
    )


def apply_changes(bookmarks: DataFrame, inserts: DataFrame, deletes: DataFrame) -> DataFrame:
    """Bookmarks after removing every match of ``deletes`` and then adding ``inserts``.

    One grouping by pair does the anti-join, the union and the duplicate removal together.
    """

    def marked(rows: DataFrame, role: str) -> DataFrame:
        return rows.select(*PAIR, F.lit(role).alias("role"))

    changes = marked(bookmarks, "held").unionByName(marked(inserts, "insert"))
    changes = changes.unionByName(marked(deletes, "delete"))

    def has(role: str):
        return F.max(F.col("role") == role)

    return (
        changes.groupBy(*PAIR)
        .agg(has("held").alias("held"), has("insert").alias("new"), has("delete").alias("gone"))
        .where(F.col("new") | (F.col("held") & ~F.col("gone")))
        .select(*PAIR)
    )


def toggle_counts(events: DataFrame) -> DataFrame:
    """Presses per pair; works on tables and on streams."""
    return events.groupBy(*PAIR).agg(F.count("*").alias("n"))


def toggled_on(counts: DataFrame) -> DataFrame:
    """Every press flips the bookmark, so an odd count means present."""
    return counts.where(F.col("n") % 2 == 1)


def toggle_state(events: DataFrame) -> DataFrame:
    return toggled_on(toggle_counts(events))
