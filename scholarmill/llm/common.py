"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ship(spark: SparkSession) -> None:
    """Give executors that do not have this package a copy of it, once in an application."""
    context = spark.sparkContext
    if getattr(context, "_has_scholarmill", None) != context.applicationId:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        archive = os.path.join(tempfile.mkdtemp(prefix="scholarmill-"), "scholarmill")
        context.addPyFile(shutil.make_archive(archive, "zip", root, "scholarmill"))
        context._has_scholarmill = context.applicationId


def text_bytes() -> Column:
    """The text's UTF-8 bytes; a null text is empty."""
    return F.coalesce("text", F.lit("")).cast("binary")


def text_sha() -> Column:
    return F.unhex(F.sha2(text_bytes(), 256))


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores in front as it takes to be no column of ``docs``, in any case."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def keep_rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``docs`` named by ``keys`` (doc_id, sha, copies), one for each key, with all columns.

    ``copies`` is the number of rows of ``docs`` with the key. Keys compare null-safe. Only rows that
    are repeated go through a grouping of whole rows.
    """
    own, sha, key, copies = free_names(docs, "own_id", "own_sha", "text_sha", "n_copies")
    wanted = keys.select(F.col("doc_id").alias(own), F.col("sha").alias(sha), F.col("copies").alias(copies))
    told = docs.withColumn(key, text_sha())
    match = (F.col(key) == F.col(sha)) & docs["doc_id"].eqNullSafe(F.col(own))
    once = told.join(wanted.where(f"{copies} = 1"), match, "left_semi").drop(key)
    again = told.join(wanted.where(f"{copies} > 1"), match, "left_semi").dropDuplicates(["doc_id", key])
    return once.unionByName(again.drop(key))


def doc_hash() -> Column:
    """crc32 of the doc_id as text, on which held-out sets are drawn; a null doc_id is empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
