"""Sharding by fixed virtual slots, with DataFrame functions only.

Records hash into a fixed number of slots. The map from slot to shard is a small stored table with a
version. Its first version gives every shard as many slots; then the bytes of each slot are summed and
the map is edited: a shard keeps its slots up to its fair share of the bytes, and the others go, largest
first, to the shard with the least so far. Adding shards edits it in the same way, so that only the slots
that have to move get another shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarmill.operators.positions import with_positions
from scholarmill.session import stored

SLOTS = 4096


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus 1), text_crc32 and virtual slot of every row."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        _slot(slots, F.col("doc_id").cast("long"), F.crc32(text)),
    )


def _slot(slots: int, *by: Column) -> Column:
    return F.pmod(F.xxhash64(*by), F.lit(slots)).cast("int").alias("virtual_slot")


def spread(rows: DataFrame, shards: int, slots: int = SLOTS) -> DataFrame:
    """``rows`` of ``records``, with those of slots that are too large dealt anew by a row number.

    A slot can only be large by rows of the same doc_id and text. Too large is one that holds a 64th of a
    shard's fair share and several rows; its rows are numbered by a distributed sort.
    """
    rows = stored(rows)
    sizes = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    heavy = stored(sizes.where((F.col("n") > 64) & (F.col("bytes") * shards * 64 > total)).select("virtual_slot"))
    if heavy.isEmpty():
        return rows
    heavy = F.broadcast(heavy)  # at most 64 slots a shard
    names = ["doc_id", "size", "text_crc32"]
    numbered = with_positions(rows.join(heavy, "virtual_slot", "left_semi").select(*names), [], [F.col(c) for c in names], "place")
    again = numbered.select(*names, _slot(slots, "doc_id", "text_crc32", "place"))
    return rows.join(heavy, "virtual_slot", "left_anti").select(*names, "virtual_slot").unionByName(again)


def slot_sizes(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Bytes of every slot, 0 for an empty one. As many rows as there are slots."""
    spark = rows.sparkSession
    sums = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"))
    every = spark.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(sums, "virtual_slot", "left").fillna(0, ["bytes"])


def assign(sizes: DataFrame, loads: DataFrame, shards: int) -> DataFrame:
    """Slots to shards: largest slot first, always to the shard with the least bytes.

    ``loads`` has the bytes that each shard holds already. The fold runs over one array with a struct
    per slot, so its length is the number of slots whatever the data.
    """
    slot = F.struct((-F.col("bytes")).alias("minus"), F.col("virtual_slot"))
    shard = F.struct("shard", "load")
    both = sizes.select("virtual_slot", "bytes").unionByName(loads.select("shard", "load"), allowMissingColumns=True)
    folded = both.agg(
        F.array_sort(F.collect_list(F.when(F.col("virtual_slot").isNotNull(), slot))).alias("queue"),
        F.transform(
            F.array_sort(F.collect_list(F.when(F.col("shard").isNotNull(), shard))), lambda x: x.load
        ).alias("held"),
    ).select(
        F.expr(
            f"""aggregate(queue,
                named_struct('held', transform(sequence(0, {shards - 1}), i -> coalesce(get(held, i), 0L)),
                             'out', cast(array() as array<struct<virtual_slot:int,shard:int>>)),
                (s, x) -> named_struct(
                    'held', transform(s.held, (v, i) ->
                        if(i + 1 = array_position(s.held, array_min(s.held)), v - x.minus, v)),
                    'out', concat(s.out, array(named_struct('virtual_slot', x.virtual_slot, 'shard',
                        cast(array_position(s.held, array_min(s.held)) - 1 as int))))))"""
        ).alias("s")
    )
    return folded.select(F.inline("s.out"))


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 1 of the map, made before any size is known: virtual_slot, shard, version."""
    return spark.range(slots).select(
        F.col("id").cast("int").alias("virtual_slot"),
        F.floor(F.col("id") * shards / slots).cast("int").alias("shard"),
        F.lit(1).alias("version"),
    )


def edit_map(current: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """The next version of the map for ``shards`` shards (as many as before, or more).

    Every shard keeps its slots in slot order up to its fair share of the bytes; only the others are
    dealt anew. With more shards of even load they all go to the new ones.
    """
    placed = current.join(sizes, "virtual_slot")
    fair = -(-(sizes.agg(F.sum("bytes")).first()[0] or 0) // shards)
    # Windows over the rows of the map, whose number is fixed.
    told = stored(placed.withColumn("up_to", F.expr("sum(bytes) OVER (PARTITION BY shard ORDER BY virtual_slot)")))
    stay = told.where(F.col("up_to") <= fair).select("virtual_slot", "shard", "version", "bytes")
    go = told.where(F.col("up_to") > fair).select("virtual_slot", "bytes")
    loads = (
        sizes.sparkSession.range(shards)
        .select(F.col("id").cast("int").alias("shard"))
        .join(stay.groupBy("shard").agg(F.sum("bytes").alias("load")), "shard", "left")
        .fillna(0, ["load"])
    )
    moved = assign(go, loads, shards)
    version = told.select(F.max("version") + 1).first()[0]
    kept = stay.select("virtual_slot", "shard")
    return stored(kept.unionByName(moved).withColumn("version", F.lit(version)))


def shard_documents(docs: DataFrame, shards: int = 8, slots: int = SLOTS) -> DataFrame:
    """Every row with its shard and its place there: doc_id, size, text_crc32, law, shard, slot,
    grown_shard, virtual_slot, map_version.

    The law is ``bytes``: the shards' sizes are near equal, as near as whole slots allow. ``slot`` is
    the place within the shard, from 0 without gaps, ordered by virtual slot and doc_id. A null text
    has size 1. Rows are dealt by doc_id and text, null ones too, and rows equal in both by their number
    where they are many, so the law holds whatever repeats; a very long text is a slot's least size.
    Other columns are ignored. An empty table gives no rows.
    """
    rows = spread(records(docs, slots), shards, slots)
    slot_map = edit_map(first_map(docs.sparkSession, shards, slots), slot_sizes(rows, slots), shards)
    placed = rows.join(F.broadcast(slot_map), "virtual_slot")
    order = [F.col(c) for c in ("virtual_slot", "doc_id", "text_crc32", "size")]
    return with_positions(placed, ["shard"], order, "place").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        F.col("version").alias("map_version"),
    )
