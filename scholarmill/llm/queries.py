"""The registered queries of this subpackage: ``fn(spark, folder) -> DataFrame`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarmill.llm import (
    alignment, bpe, exact, html, imatch, lm, packing, pii, quality, sentencepieces, shards, simhash, whitening,
)
from scholarmill.llm.common import ship

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A whole table; executors get this package along with it."""
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact.exact_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE["op1_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.token_digests(
        table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


@query
def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(table(spark, folder, "documents"))


@query
def op6_html(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(spark, folder, "pages"))


@query
def op7_imatch(spark: SparkSession, folder: str) -> DataFrame:
    return imatch.edited_fingerprints(table(spark, folder, "documents"))


@query
def op8_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score_documents(table(spark, folder, "documents"))


@query
def op9_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shards.shard_documents(table(spark, folder, "documents"))


@query
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(
        table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )


@query
def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.alignment_counts(
        table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


@query
def op12_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepieces.token_digests(
        table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )


@query
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    # A deviation beyond a long is null here; the column after the contract's has it.
    found = whitening.whiten(table(spark, folder, "embeddings"))
    whole = F.expr("try_cast(deviation AS long)").alias("deviation")
    return found.select("vec_id", "component", "n", whole, "whitened", "explained", "identity_error",
                        F.col("deviation").alias("deviation_decimal"))
