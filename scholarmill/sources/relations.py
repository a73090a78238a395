"""The canonical relations as stored tables.

``Relations`` offers what ``Tables`` offers for labs, universities, bookmarks and bridges, so every
query over these runs on a stored data set: ``catalogue.q_ranking_all(Relations(spark, folder))``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarmill import schemas
from scholarmill.operators.bookmarks import pairs
from scholarmill.operators.taxonomy import Taxonomy
from scholarmill.sources.files import read_relation
from scholarmill.sources.tables import Tables

SCHEMAS = {
    "professors": schemas.PROFESSORS,
    "universities": schemas.UNIVERSITIES,
    "research_fields": schemas.RESEARCH_FIELDS,
    "research_sub_fields": schemas.RESEARCH_SUB_FIELDS,
    "professor_research_fields": schemas.PROFESSOR_RESEARCH_FIELDS,
    "professor_sub_fields": schemas.PROFESSOR_SUB_FIELDS,
    "bookmarks": schemas.BOOKMARKS,
}


class Relations:
    """Stored relations of one folder, one sub-folder of parquet files each."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def relation(self, name: str) -> DataFrame:
        return read_relation(self.spark, f"{self.folder}/{name}", SCHEMAS[name])

    def labs(
        self, papers: bool = True, sub_fields: bool = True, universities: DataFrame | None = None
    ) -> DataFrame:
        """Stored labs have every column; unused ones are pruned by the reader."""
        labs = self.relation("professors")
        if universities is None:
            return labs
        return labs.join(universities.select(F.col("id").alias("university_id")), "university_id", "left_semi")

    def fields(self) -> DataFrame:
        return self.relation("research_fields")

    def sub_fields(self) -> DataFrame:
        return self.relation("research_sub_fields")

    def taxonomy(self) -> Taxonomy:
        return Taxonomy.stored(self.sub_fields(), self.fields())

    def universities(self) -> DataFrame:
        return self.relation("universities")

    def bookmarks(self) -> DataFrame:
        return self.relation("bookmarks")

    def lab_bridges(self, labs: DataFrame) -> tuple[DataFrame, DataFrame]:
        return self.relation("professor_research_fields"), self.relation("professor_sub_fields")


def _as(rows: DataFrame, name: str) -> DataFrame:
    """Columns in the order and types of the relation."""
    wanted = [field.strip().rsplit(" ", 1) for field in SCHEMAS[name].split(",")]
    return rows.select(*[F.col(column).cast(kind).alias(column) for column, kind in wanted])


def publish(tables: Tables, folder: str) -> None:
    """Derive the canonical relations once and store them, so that queries need not join again."""
    professors = _as(tables.labs(papers=True, sub_fields=True), "professors")
    professors.write.parquet(f"{folder}/professors")
    ids = professors.sparkSession.read.schema(schemas.PROFESSORS).parquet(f"{folder}/professors")
    numbered = ids.select(F.col("id").cast("bigint").alias("id"), "research_sub_fields")
    lab_fields, lab_sub_fields = tables.lab_bridges(numbered)
    derived = {
        "universities": tables.universities(),
        "research_fields": tables.fields(),
        "research_sub_fields": tables.sub_fields(),
        "professor_research_fields": lab_fields,
        "professor_sub_fields": lab_sub_fields,
        "bookmarks": pairs(tables.bookmarks()),
    }
    for name, rows in derived.items():
        _as(rows, name).write.parquet(f"{folder}/{name}")


#: The lab key of each relation that is joined by lab.
LAB_KEYS = {"professors": "id", "professor_research_fields": "professor_id", "bookmarks": "lab_id"}


class Colocated(Relations):
    """Relations of which those joined by lab are stored in buckets of the lab key, sorted by it.

    Joins of any two of them, and aggregates by lab, read bucket against bucket and shuffle nothing.
    Tables are known to the session's catalogue as ``<prefix>_<relation>``.
    """

    def __init__(self, spark: SparkSession, folder: str, prefix: str):
        super().__init__(spark, folder)
        self.prefix = prefix

    def relation(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.prefix}_{name}") if name in LAB_KEYS else super().relation(name)


def publish_colocated(source: Relations, folder: str, prefix: str, buckets: int) -> Colocated:
    """Store stored relations anew, hashed by lab into ``buckets``: two or three times the cores.

    A lab with a third of all bookmarks makes its bucket that large; bookmarks are pairs, once each, so it
    is bounded by the number of users.
    """
    spark = source.spark
    for name in SCHEMAS:
        rows, path = source.relation(name), f"{folder}/{name}"
        if name in LAB_KEYS:
            key = LAB_KEYS[name]
            # One file a bucket, so that the sort is known to hold for the bucket as a whole.
            placed = rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
            placed.option("path", path).mode("overwrite").saveAsTable(f"{prefix}_{name}")
        else:
            rows.write.mode("overwrite").parquet(path)
    return Colocated(spark, folder, prefix)
