"""File sources and sinks with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from scholarmill import schemas
from scholarmill.functions.labs import present
from scholarmill.functions.rules import Rules
from scholarmill.operators.bookmarks import PAIR, pairs
from scholarmill.operators.ingest import extracted_records
from scholarmill.operators.quality import Reference, Unique, set_checked, upsert
from scholarmill.session import stored
from scholarmill.sources.buckets import BucketTable


def read_relation(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A canonical relation stored as parquet, read with its fixed schema."""
    return spark.read.schema(schema).parquet(path)


def read_professors(spark: SparkSession, path: str) -> DataFrame:
    return read_relation(spark, path, schemas.PROFESSORS)


def read_url_sheet(spark: SparkSession, path: str) -> DataFrame:
    """The sheet of lab sites: a CSV with header; rows without an address are left out."""
    sheet = spark.read.csv(path, schema=schemas.URL_SHEET, header=True)
    return sheet.where(present(F.col("url")))


def append_bookmarks(new: DataFrame, path: str) -> DataFrame:
    """Append bookmarks and return the rows written."""
    rows = new.select(*PAIR)
    rows.write.mode("append").parquet(path)
    return rows


def rewrite_without(bookmarks: DataFrame, deletes: DataFrame, target: str) -> None:
    """Write the bookmarks minus every match of ``deletes`` to a new folder."""
    bookmarks.join(pairs(deletes), PAIR, "left_anti").write.parquet(target)


def staged_load(
    spark: SparkSession,
    rows: DataFrame,
    rules: Rules,
    staging: str,
    current: DataFrame,
    target: str,
    keys: list[str],
    order: list[str],
) -> None:
    """Two-stage load: checked rows go to staging, by status, then the merged table to ``target``.

    The crawl is read and validated once: one write puts valid and quarantined rows (with their
    reasons) in the folders ``status=valid`` and ``status=quarantine``, and the final step reads the
    valid ones back. ``target`` is a new folder; readers switch to it when it is complete.
    """
    upsert(current, stage(rows, rules, staging), keys, order).write.parquet(target)


def staged_upsert(
    rows: DataFrame, rules: Rules, staging: str, table: BucketTable, order: list[str], token: str | None = None,
    sets: list[Unique | Reference] | None = None, most_bad: float | None = None,
) -> list[int]:
    """``staged_load`` into a table hashed by key: only the buckets of the valid rows' keys are rewritten.

    See ``stage`` for rules over sets and for loads that are refused.
    """
    return table.upsert(stage(rows, rules, staging, sets, most_bad), order, token)


class LoadRefused(Exception):
    """Too many rows of a load were bad; nothing but the staging folder was written."""

    def __init__(self, counts: dict[str, int]):
        super().__init__(f"{counts['quarantined']} of {counts['rows']} rows in quarantine")
        self.counts = counts


def stage(
    rows: DataFrame,
    rules: Rules,
    staging: str,
    sets: list[Unique | Reference] | None = None,
    most_bad: float | None = None,
) -> DataFrame:
    """Write rows to ``status=valid`` and ``status=quarantine`` and return the valid ones, read back.

    ``sets`` are rules over sets of rows. The write itself counts rows and quarantined rows; if the share
    of the latter is over ``most_bad`` the load is refused, with both kinds left in ``staging`` to look at.
    """
    spark, names = rows.sparkSession, rows.columns
    if sets:
        rows = stored(rows)  # checked row by row and by its sets, from one reading of the source
    counts = Observation()
    marked = set_checked(rows, rules, sets or []).observe(
        counts, F.count("*").alias("rows"), F.count_if(F.col("status") == "quarantine").alias("quarantined")
    )
    marked.write.mode("overwrite").partitionBy("status").parquet(staging)
    seen = counts.get
    if most_bad is not None and seen["quarantined"] > most_bad * seen["rows"]:
        raise LoadRefused(seen)
    return spark.read.schema(marked.schema).parquet(staging).where("status = 'valid'").select(*names)


def stage_records(
    rows: DataFrame, column: str, schema: str, rules: Rules, staging: str,
    sets: list[Unique | Reference] | None = None, most_bad: float | None = None,
) -> DataFrame:
    """``stage`` for extracted records: the JSON of ``column`` decoded through ``schema``.

    A record that does not fit the schema goes to the quarantine with the reason ``corrupt``, before all
    other rules, and keeps its JSON there; the valid rows have the decoded fields instead.
    """
    told = extracted_records(rows.withColumn("raw", F.col(column)), column, schema)
    valid = stage(told, [("corrupt", F.col("is_corrupt")), *rules], staging, sets, most_bad)
    return valid.drop("raw", "is_corrupt")
