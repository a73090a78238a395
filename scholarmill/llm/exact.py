"""Exact duplicates by deterministic block naming.

A text is cut into blocks of fixed size. All blocks of the corpus are sorted, and a block's name is its
place among the distinct ones. Then the names of adjacent blocks are paired, the pairs sorted and named
in the same way, level by level, until every text has one name. Two texts of the same number of levels
have the same name exactly if they are equal: no step compares hashes of blocks.

The sort is by range over (first bytes, digest, row key) and then by the block itself, so the occurrences
of one frequent block spread over as many tasks as they need, and the sample that Spark draws for the
ranges holds no blocks. Each task numbers the runs of equal values it sees; a table of one row per
task (first value, last value, number of runs) turns these into places in the whole order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scholarmill.llm.common import keep_rows, text_bytes
from scholarmill.session import stored

BLOCK_BYTES = 8192
KEY = ["doc_id", "sha", "pos"]


def _edge(values: tuple) -> bytes:
    return b"|".join(v if isinstance(v, bytes) else str(v).encode() for v in values)


def _number_runs(values: list[str], kept: list[str], schema: pa.Schema):
    """Numbers the runs of equal ``values`` in a sorted partition; its last row describes the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        first = last = None
        runs = 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            columns = [batch.column(batch.schema.get_field_index(v)) for v in values]
            change = np.zeros(n, bool)
            for c in columns:
                change[1:] |= pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            head = tuple(c[0].as_py() for c in columns)
            change[0] = head != last
            first = head if first is None else first
            last = tuple(c[n - 1].as_py() for c in columns)
            number = runs - 1 + np.cumsum(change)
            runs = int(number[-1]) + 1
            rows = [batch.column(batch.schema.get_field_index(k)) for k in kept]
            rows += [pa.array(np.full(n, part, "int32")), pa.array(number.astype("int64"))]
            rows += [pa.nulls(n, schema.field(f).type) for f in ("first", "last", "runs")]
            yield pa.RecordBatch.from_arrays([r.cast(f.type) for r, f in zip(rows, schema)], schema=schema)
        if first is not None:
            row = {"part": part, "first": _edge(first), "last": _edge(last), "runs": runs}
            yield pa.RecordBatch.from_pylist([row], schema=schema)

    return run


def name_values(df: DataFrame, values: list[str], kept: list[str], dealt_by: list[str]) -> DataFrame:
    """``kept`` columns of every row with ``name``: the rank of its values among the distinct ones.

    ``values`` hold no nulls. Rows are dealt by ranges of (dealt_by, kept), so equal values never have
    to meet in one task, and sorted by (dealt_by, values, kept). ``dealt_by`` has the same value for
    equal values and another for different ones; Spark samples it for the ranges, so it is short.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    extra = {"part": "int", "run": "bigint", "first": "binary", "last": "binary", "runs": "bigint"}
    out = {k: kinds[k] for k in kept} | extra
    schema = pa.schema([(k, arrow[v]) for k, v in out.items()])
    dealt = df.repartitionByRange(*dealt_by, *kept).sortWithinPartitions(*dealt_by, *values, *kept)
    ordered = dealt.select(*values, *kept)
    numbered = stored(
        ordered.mapInArrow(_number_runs(values, kept, schema), ", ".join(f"{k} {v}" for k, v in out.items()))
    )
    # One row per sort task, so the window's only partition stays as small as the number of tasks.
    along = Window.orderBy("part")
    edges = (
        numbered.where("runs IS NOT NULL")
        .select("part", "runs", F.coalesce(F.col("first") == F.lag("last").over(along), F.lit(False)).alias("joined"))
        .select(
            "part",
            (
                F.sum("runs").over(along) - F.col("runs") - F.sum(F.col("joined").cast("long")).over(along)
            ).alias("offset"),
        )
    )
    rows = numbered.where("runs IS NULL").select(*kept, "part", "run")
    return rows.join(F.broadcast(edges), "part").select(*kept, (F.col("offset") + F.col("run")).alias("name"))


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per distinct (doc_id, text): doc_id, sha, copies, level, name.

    (level, name) identifies the text. ``sha`` (SHA-256 of the text) only tells rows of one repeated
    doc_id apart; ``copies`` counts the rows that agree in both.
    """
    whole = docs.select("doc_id", text_bytes().alias("bytes")).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "bytes",
        F.unhex(F.sha2("bytes", 256)).alias("sha"),
        F.greatest(F.lit(1), F.ceil(F.octet_length("bytes") / block_bytes)).cast("int").alias("n"),
    )
    blocks = whole.select("*", F.explode(F.expr("sequence(0, n - 1)")).alias("pos")).select(
        "doc_id", "sha", "n", "pos", F.lit(1).cast("long").alias("copies"),
        F.expr(f"substring(bytes, pos * {block_bytes} + 1, {block_bytes})").alias("block"),
    )
    short = blocks.withColumn("head", F.expr("substring(block, 1, 16)")).withColumn("digest", F.unhex(F.sha2("block", 256)))
    rows = name_values(short, ["block"], [*KEY, "n", "copies"], ["head", "digest"])
    done, level = [], 0
    most = rows.agg(F.max("n")).first()[0] or 1
    while True:
        done.append(rows.where("n = 1").select("doc_id", "sha", "copies", F.lit(level).alias("level"), "name"))
        if most == 1:
            break
        level, most = level + 1, (most + 1) // 2
        pairs = (
            rows.where("n > 1")
            .groupBy("doc_id", "sha", F.shiftright("pos", 1).alias("pos"), F.shiftright(F.col("n") + 1, 1).alias("n"))
            .agg(
                F.max(F.expr("if(pos % 2 = 0, name, null)")).alias("a"),
                F.coalesce(F.max(F.expr("if(pos % 2 = 1, name, null)")), F.lit(-1)).cast("long").alias("b"),
                F.sum(F.expr("if(pos = 0, copies, 0)")).alias("copies"),
            )
        )
        rows = name_values(pairs, ["a", "b"], [*KEY, "n", "copies"], ["a", "b"])
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found.groupBy("doc_id", "sha", "level", "name").agg(F.sum("copies").alias("copies"))


def _shared(known: DataFrame) -> DataFrame:
    """keep_id and group_size of the texts that several doc_ids have.

    The table is stored, so that the join on it is one of two plain shuffles, which adaptive execution
    splits where one text has very many rows.
    """
    groups = known.groupBy("level", "name").agg(
        F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"), F.count("*").alias("keys")
    )
    return stored(groups.where("keys > 1").drop("keys"))


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, level, name.

    A null text is empty; empty texts are equal to each other. A null doc_id is the smallest one. Of
    several rows with the largest doc_id of a group one is kept. Columns but doc_id and text are
    ignored. A very long text is many blocks, dealt out like those of others. An empty table gives no rows.
    """
    known = identities(docs, block_bytes)
    each = known.join(_shared(known), ["level", "name"], "left").withColumn(
        "copy", F.explode(F.expr("sequence(1L, copies)"))
    )
    return each.select(
        "doc_id",
        F.expr("if(group_size is null, doc_id, keep_id)").alias("keep_id"),
        F.coalesce("group_size", "copies").alias("group_size"),
        F.expr("copy = 1 AND (group_size IS NULL OR doc_id <=> keep_id)").alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "level",
        "name",
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows repeated with the same doc_id and text leave one of them, whichever other columns they have and
    whatever these are called. Texts of any length are compared whole; an empty table gives no rows.
    """
    known = identities(docs)
    keys = known.join(_shared(known), ["level", "name"], "left").where("group_size IS NULL OR doc_id <=> keep_id")
    return keep_rows(docs, keys.select("doc_id", "sha", "copies"))
