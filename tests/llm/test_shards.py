from __future__ import annotations

import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from scholarmill.llm import queries, shards
from tests.conftest import CHECK


def test_query(spark):
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{CHECK}/documents.parquet").collect()}
    rows = queries.op9_shards(spark, CHECK).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {
        i: (len(t) + 1, zlib.crc32(t)) for i, t in texts.items()}
    assert len(rows) == len(texts)
    load, places = Counter(), defaultdict(list)
    for r in rows:
        load[r.shard] += r.size
        places[r.shard].append(r.slot)
    assert sorted(load) == list(range(8))
    assert max(load.values()) - min(load.values()) < 0.001 * sum(load.values())
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}


def test_slots_go_largest_first(spark):
    sizes = spark.createDataFrame([(i, b) for i, b in enumerate([5, 9, 0, 7, 7, 3, 1, 0])], "virtual_slot int, bytes long")
    load, expected = [0, 0, 0], {}
    for minus, slot in sorted((-r.bytes, r.virtual_slot) for r in sizes.collect()):
        shard = load.index(min(load))
        load[shard] -= minus
        expected[slot] = shard
    none = spark.createDataFrame([(i, 0) for i in range(3)], "shard int, load long")
    assert {r.virtual_slot: r.shard for r in shards.assign(sizes, none, 3).collect()} == expected


def test_edited_map_moves_little(spark):
    docs = spark.read.parquet(f"{CHECK}/documents.parquet")
    sizes = shards.slot_sizes(shards.records(docs))
    first = shards.first_map(spark, 8)
    old = shards.edit_map(first, sizes, 8)
    new = shards.edit_map(old, sizes, 9)
    assert {r.version for r in old.collect()} == {2} and {r.version for r in new.collect()} == {3}
    total = sizes.agg(F.sum("bytes")).first()[0]
    for before, after, n, most in ((first, old, 8, 0.3), (old, new, 9, 0.2)):
        both = before.join(after.select("virtual_slot", F.col("shard").alias("to")), "virtual_slot").join(sizes, "virtual_slot")
        assert both.count() == shards.SLOTS
        loads = [r[0] for r in both.groupBy("to").agg(F.sum("bytes")).select("sum(bytes)").collect()]
        assert len(loads) == n and max(loads) - min(loads) < 0.02 * total
        assert both.where("shard <> to").agg(F.sum("bytes")).first()[0] < most * total


def test_the_law_holds_where_ids_and_texts_repeat(spark):
    """A third of the rows have no id, a third are one row again and again, and one text is long."""
    rows = [(None, f"text {i}" * (i % 7)) for i in range(3000)] + [(7, "the same row")] * 3000
    rows += [(i, "x" * (i % 50)) for i in range(10, 3010)] + [(5, "long " * 2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = shards.shard_documents(docs).collect()
    load, places = Counter(), defaultdict(list)
    for r in found:
        load[r.shard] += r.size
        places[r.shard].append(r.slot)
    assert sorted(load) == list(range(8)) and max(load.values()) - min(load.values()) < 0.01 * max(load.values())
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    told = Counter((r.doc_id, r.size, r.text_crc32) for r in found)
    assert told == Counter((i, len(t) + 1, zlib.crc32(t.encode())) for i, t in rows)
    assert {r.map_version for r in found} == {2}


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 0), (None, "a", 1), (None, "a", 1), (2, "", 2), (2, "é", 3)], "doc_id long, text string, shard int")
    rows = shards.shard_documents(docs, shards=2).collect()
    assert sorted(r.size for r in rows) == [1, 1, 2, 2, 3]
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert shards.shard_documents(docs.limit(0)).count() == 0
