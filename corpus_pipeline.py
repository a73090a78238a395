"""A corpus pipeline: each stage applies one operator to all that the stage before has kept.

A stage takes (spark, docs, folder) and returns a DataFrame, which is written as Parquet and read again
as the next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from scholarmill.llm import exact, neartext, packing, pii, quality  # noqa: E402
from scholarmill.llm.common import ship  # noqa: E402
from scholarmill.llm.queries import table  # noqa: E402
from scholarmill.session import stored  # noqa: E402

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from ``labels`` and these documents."""
    return quality.drop_rejected(docs, table(spark, folder, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each text, the one with the largest doc_id."""
    return exact.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id.

    Near are texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.
    """
    return neartext.drop_near_texts(docs)


def remove_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with personal data taken out of the text and n_chars made to fit."""
    return pii.sanitise(docs)


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pieces of all documents with their sequence and offset."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def _shipped(stage: Stage) -> Stage:
    """A stage may be called by itself, so each sees to it that executors have the package."""

    @wraps(stage)
    def with_package(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        ship(spark)
        return stage(spark, docs, folder)

    return with_package


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", _shipped(keep_quality)),
    ("exact_dedup", _shipped(drop_copies)),
    ("simhash_near_dedup", _shipped(drop_near_copies)),
    ("pii", _shipped(remove_personal_data)),
    ("best_fit_packing", _shipped(pack)),
]

# Trained scores, fingerprints and packing have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """Apply all stages to ``documents``; each one's result is written and read again."""
    docs = table(spark, folder, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, folder))
    return STAGES[-1][1](spark, docs, folder)
