"""Chat turns: cleaning, classification and assembly of ordered text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarmill.functions.text import trimmed

PARTS_PER_SEGMENT = 64


def clean_turns(turns: DataFrame) -> DataFrame:
    """User turns trimmed, empty ones dropped; turns of other roles as they are."""
    is_user = F.col("role") == "user"
    text = F.when(is_user, trimmed(F.col("text"))).otherwise(F.col("text"))
    return turns.withColumn("text", text).where(~is_user | (F.length("text") > 0))


def user_turns(turns: DataFrame) -> DataFrame:
    return clean_turns(turns.where(F.col("role") == "user")).select("conv_id", "turn", "text")


def assemble(
    parts: DataFrame,
    key: str,
    seq: str,
    text: Column,
    separator: str = "",
    per_segment: int = PARTS_PER_SEGMENT,
) -> DataFrame:
    """Concatenate parts in ``seq`` order: one row per key and segment of ``per_segment`` numbers.

    A part that is delivered again is taken once: of the parts of one (key, seq) the smallest text
    stays, which is the only one unless a sender changed it. So a segment gathers at most
    ``per_segment`` parts even when one key holds a third of all rows. Parts without a key or number
    have no place in a text and are left to ``unplaced``. Segments read in order give the whole text.
    Empty parts are skipped.
    """
    piece = F.struct(F.col("seq"), F.col("text"))
    numbered = parts.where(F.col(key).isNotNull() & F.col(seq).isNotNull() & (F.length(text) > 0))
    return (
        numbered.groupBy(key, F.col(seq).alias("seq"))
        .agg(F.min(text).alias("text"))
        .groupBy(key, F.floor(F.col("seq") / per_segment).alias("segment"))
        .agg(F.array_sort(F.collect_list(piece)).alias("_pieces"))
        .select(
            key,
            "segment",
            F.array_join(F.transform("_pieces", lambda p: p["text"]), separator).alias("text"),
            F.size("_pieces").cast("bigint").alias("n_parts"),
        )
    )


def unplaced(parts: DataFrame, key: str, seq: str) -> DataFrame:
    """The parts that ``assemble`` cannot place, as they are."""
    return parts.where(F.col(key).isNull() | F.col(seq).isNull())


def message_text(chunks: DataFrame, per_segment: int = PARTS_PER_SEGMENT) -> DataFrame:
    """Streamed deltas (message_id, seq, text) put together."""
    return assemble(chunks, "message_id", "seq", F.col("text"), "", per_segment)


def transcripts(turns: DataFrame, per_segment: int = PARTS_PER_SEGMENT) -> DataFrame:
    """The conversation as role-tagged lines."""
    line = F.concat(F.col("role"), F.lit(": "), F.col("text"))
    return assemble(clean_turns(turns), "conv_id", "turn", line, "\n", per_segment).select(
        "conv_id", "segment", F.col("text").alias("transcript"), F.col("n_parts").alias("n_turns")
    )
