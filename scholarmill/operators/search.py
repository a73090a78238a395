"""Search, similarity, recommendation and comparison of labs."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholarmill.functions.literals import constant_map
from scholarmill.operators.bookmarks import pairs
from scholarmill.operators.positions import with_positions
from scholarmill.operators.ranking import roll_up
from scholarmill.operators.taxonomy import Taxonomy, listed
from scholarmill.session import scratch_folder, stored
from scholarmill.sources.folders import folders


def keyword_search(documents: DataFrame, keywords: list[str]) -> DataFrame:
    """Documents holding any keyword, case-insensitive: keywords matched and total occurrences.

    Keywords are literals, so the scan alone answers; nothing is tokenised or shuffled. Without
    keywords nothing is found.
    """
    words = [k.lower() for k in keywords if k]
    text = F.lower("text")
    if not words:
        none = F.lit(0).cast("bigint")
        return documents.where(F.lit(False)).select("doc_id", none.alias("n_matched"), none.alias("score"))

    def occurrences(word: str) -> Column:
        shorter = F.length(F.replace(text, F.lit(word), F.lit("")))
        return ((F.length(text) - shorter) / len(word)).cast("bigint")

    any_word = "|".join(re.escape(w) for w in words)
    matched = [F.when(text.contains(w), 1).otherwise(0) for w in words]
    return documents.where(text.rlike(any_word)).select(
        "doc_id",
        reduce(add, matched).cast("bigint").alias("n_matched"),
        reduce(add, [occurrences(w) for w in words]).alias("score"),
    )


def named_like(universities: DataFrame, term: str) -> DataFrame:
    """Universities whose name contains ``term``, in any case."""
    return universities.where(F.lower("name").contains(term.lower()))


def name_search(labs: DataFrame, universities: DataFrame, term: str) -> DataFrame:
    """Universities whose name contains ``term``, with their labs and papers.

    ``labs`` is best read for ``named_like`` universities alone, before papers are counted.
    """
    return roll_up(labs, named_like(universities, term))


def label_profiles(vectors: DataFrame) -> DataFrame:
    """Mean vector of every label: (qid, vector)."""
    means = vectors.groupBy("label").agg(
        Summarizer.mean(array_to_vector(F.col("embedding").cast("array<double>"))).alias("mean")
    )
    return means.select(
        F.col("label").cast("bigint").alias("qid"), vector_to_array("mean").alias("vector")
    )


NEAREST = "qid bigint, vec_id bigint, sim double"


def _nearest_in(k: int):
    """Function giving the best ``k`` points per query, ties by id, from one matrix product.

    A closure, so that it travels to executors that do not have this package installed.
    """

    def nearest(points: pd.DataFrame, qids: list, queries: list) -> pd.DataFrame:
        asked = np.array([np.asarray(q, dtype="float64") for q in queries])
        asked /= np.linalg.norm(asked, axis=1, keepdims=True)
        vectors = np.stack(points["embedding"].to_numpy()).astype("float64")
        ids = points["vec_id"].to_numpy()
        sims = np.round(vectors @ asked.T / np.linalg.norm(vectors, axis=1)[:, None], 6)
        found = []
        for i, qid in enumerate(qids):
            first = np.lexsort((ids, -sims[:, i]))[:k]
            found.append(pd.DataFrame({"qid": qid, "vec_id": ids[first], "sim": sims[first, i]}))
        return pd.concat(found)

    return nearest


QUERIES_PER_BLOCK = 1000


def vector_topk(
    vectors: DataFrame, queries: DataFrame, k: int, per_block: int = QUERIES_PER_BLOCK
) -> DataFrame:
    """The ``k`` vectors most similar to each query (qid, vector) by cosine, ties by id.

    Queries are stored once, numbered, and taken in blocks of ``per_block``, whatever their number. A
    block travels with the tasks of one pass over the vectors, which are not shuffled; each Arrow batch
    keeps its own best ``k`` per query, and only those are. Each pass is run and stored before the next
    block is fetched, so no more than a block is ever on the driver, and the plan that is returned reads
    the stored rows alone. Neither a third of equal vectors nor their number reaches one task. Vectors
    and queries without direction (all zero, or empty) are left out. For many queries see ``cells``.
    """
    spark = vectors.sparkSession
    directed = F.coalesce(F.exists(F.col("v"), lambda x: x != 0), F.lit(False))
    points = vectors.select("vec_id", "embedding").withColumn("v", F.col("embedding")).where(directed).drop("v")
    asked = queries.select("qid", "vector").withColumn("v", F.col("vector")).where(directed).drop("v")
    placed = stored(with_positions(asked, [], [F.col("qid")], "place"))
    n_queries = placed.count()
    nearest_in = _nearest_in(k)

    def one_pass(first: int) -> DataFrame:
        block = placed.where(F.col("place").between(first, first + per_block - 1)).collect()
        qids, wanted = [q["qid"] for q in block], [list(q["vector"]) for q in block]

        def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    yield nearest_in(batch, qids, wanted)

        return points.mapInPandas(best, NEAREST)

    folder = scratch_folder(spark)
    for first in range(1, n_queries + 1, per_block):
        one_pass(first).write.parquet(f"{folder}/block={first}")
    nearest = folders(spark, folder, NEAREST, "parquet").select("qid", "vec_id", "sim")
    place = Window.partitionBy("qid").orderBy(F.desc("sim"), "vec_id")
    return (
        nearest.withColumn("rk", F.row_number().over(place))
        .where(F.col("rk") <= k)
        .withColumn("rk", F.col("rk").cast("bigint"))
    )


class FieldBits:
    """Sets of fields as the bits of a bigint, for a taxonomy of at most 62 fields."""

    MOST = 62

    def __init__(self, taxonomy: Taxonomy):
        order = {field: i for i, field in enumerate(dict.fromkeys(row[3] for row in taxonomy.rows))}
        self.bits = constant_map([(row[4], 1 << order[row[3]]) for row in taxonomy.rows])

    def of(self, ids: Column) -> Column:
        """The fields reached by an id array; NULL for none."""
        none = F.lit(0).cast("bigint")
        every = F.aggregate(
            F.coalesce(ids, F.array().cast("array<bigint>")),
            none,
            lambda acc, i: acc.bitwiseOR(F.coalesce(self.bits[i], none)),
        )
        return F.nullif(every, none)

    def united(self, held: DataFrame) -> DataFrame:
        """(user_id, interest, n_held) of the labs that users hold."""
        return held.groupBy("user_id").agg(F.bit_or("fields").alias("interest"), F.count("*").alias("n_held"))

    def shared(self) -> Column:
        return F.bit_count(F.col("fields").bitwiseAND(F.col("interest")))

    def each(self, mask: str) -> Column:
        """A row for each field of the set."""
        return F.expr(f"explode(filter(sequence(0, 62), i -> (shiftright({mask}, i) & 1) = 1))")


class FieldLists:
    """Sets of fields as sorted arrays of their numbers, for any taxonomy."""

    def __init__(self, taxonomy: Taxonomy):
        order = {field: i for i, field in enumerate(dict.fromkeys(row[3] for row in taxonomy.rows))}
        self.numbers = constant_map([(row[4], order[row[3]]) for row in taxonomy.rows])

    def of(self, ids: Column) -> Column:
        known = F.array_compact(F.transform(F.coalesce(ids, F.array().cast("array<bigint>")), lambda i: self.numbers[i]))
        return F.when(F.size(known) > 0, F.array_sort(F.array_distinct(known)))

    def united(self, held: DataFrame) -> DataFrame:
        sets = held.groupBy("user_id", "fields").agg(F.count("*").alias("n"))
        reached = sets.select("user_id", F.explode("fields").alias("f")).distinct()
        interest = reached.groupBy("user_id").agg(F.array_sort(F.collect_list("f")).alias("interest"))  # at most all fields
        return interest.join(sets.groupBy("user_id").agg(F.sum("n").alias("n_held")), "user_id")

    def shared(self) -> Column:
        return F.size(F.array_intersect("fields", "interest"))

    def each(self, fields: str) -> Column:
        return F.explode(fields)


def field_sets(taxonomy: Taxonomy) -> FieldBits | FieldLists:
    n_fields = len({row[3] for row in taxonomy.rows})
    return FieldBits(taxonomy) if n_fields <= FieldBits.MOST else FieldLists(taxonomy)


def recommend(
    labs: DataFrame, bookmarks: DataFrame, k: int = 5, taxonomy: Taxonomy | None = None
) -> DataFrame:
    """The ``k`` best labs per user that the user has not bookmarked.

    A user's interest is the set of fields of the bookmarked labs; a lab scores one point per shared
    field, ties go to more papers, then to the lower id. Every sub-field belongs to a field.

    Labs are put in order once, within those of the same fields. A free lab that a user can be
    recommended is then in one of two places: among the first k of its own list, or among the k after
    one of the user's bookmarks there. The first kind is a table of the first k of every list, put in
    order for every interest that shares a field with it; lists and interests are sets of fields, of which
    there are few if fields are, and never more than labs and users. A user with n bookmarks needs the
    first n + k. Only these places are looked up.
    """
    sets = field_sets(taxonomy or listed())
    profiles = stored(
        labs.select(
            F.col("id").alias("lab_id"),
            F.coalesce("paper_count", F.lit(0)).alias("paper_count"),
            sets.of(F.col("research_sub_fields")).alias("fields"),
        ).where(F.col("fields").isNotNull())
    )
    order = [F.desc("paper_count"), F.col("lab_id")]
    lists = stored(with_positions(profiles, ["fields"], order))
    marks = stored(pairs(bookmarks))
    held = stored(marks.join(lists.select("lab_id", "fields", "pos"), "lab_id"))
    users = stored(sets.united(held))

    score = sets.shared()
    interests = users.select("interest").distinct().withColumn("bit", sets.each("interest"))
    firsts = lists.where(F.col("pos") <= k).withColumn("bit", sets.each("fields"))
    met = firsts.join(interests, "bit").drop("bit").distinct().withColumn("score", score)
    merged = Window.partitionBy("interest").orderBy(F.desc("score"), *order)
    openers = met.withColumn("place", F.row_number().over(merged)).select(
        "interest", F.col("place").cast("bigint").alias("place"), "lab_id", "paper_count", "score"
    )

    first_places = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n_held") + k)).alias("place")
    leading = users.select("user_id", "interest", first_places).join(openers, ["interest", "place"])
    next_places = F.explode(F.sequence(F.col("pos") + 1, F.col("pos") + k)).alias("pos")
    following = (
        held.select("user_id", "fields", next_places)
        .distinct()
        .join(lists, ["fields", "pos"])
        .join(users, "user_id")
        .withColumn("score", score)
    )
    names = ["user_id", "lab_id", "paper_count", "score"]
    free = (
        leading.select(*names)
        .unionByName(following.select(*names))
        .distinct()
        .join(marks, ["user_id", "lab_id"], "left_anti")
    )
    place = Window.partitionBy("user_id").orderBy(F.desc("score"), *order)
    chosen = free.withColumn("rk", F.row_number().over(place)).where(F.col("rk") <= k)
    return chosen.select(
        "user_id", "lab_id", F.col("score").cast("bigint").alias("score"), F.col("rk").cast("bigint").alias("rk")
    )


def neighbour_pairs(placed: DataFrame) -> DataFrame:
    """Each lab with the next one in its university's list: pairs grow with the labs."""
    one = placed.select("university", "pos", F.col("id").alias("lab_a"))
    two = placed.select(
        "university", (F.col("pos") - 1).alias("pos"), F.col("id").alias("lab_b")
    )
    return one.join(two, ["university", "pos"]).select("lab_a", "lab_b")


def compare_labs(labs: DataFrame, lab_pairs: DataFrame) -> DataFrame:
    """Side-by-side figures for given pairs (lab_a, lab_b)."""

    def side(suffix: str) -> DataFrame:
        return labs.select(
            F.col("id").alias(f"lab_{suffix}"),
            F.coalesce("paper_count", F.lit(0)).alias(f"papers_{suffix}"),
            F.col("lab_member_count").alias(f"members_{suffix}"),
            F.coalesce("research_sub_fields", F.array().cast("array<bigint>")).alias(
                f"ids_{suffix}"
            ),
        )

    return (
        lab_pairs.join(side("a"), "lab_a")
        .join(side("b"), "lab_b")
        .select(
            "lab_a",
            "lab_b",
            (F.col("papers_a") - F.col("papers_b")).alias("paper_diff"),
            (F.col("members_a") - F.col("members_b")).alias("member_diff"),
            F.size(F.array_intersect("ids_a", "ids_b")).cast("bigint").alias("shared_sub_fields"),
        )
    )
