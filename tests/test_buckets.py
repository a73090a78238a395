"""Loads into a table hashed by key rewrite the buckets of their keys and nothing else."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from scholarmill.operators.state import latest
from scholarmill.sources import files
from scholarmill.sources.buckets import BucketTable
from scholarmill.streaming import jobs
from tests.fixtures import tuples

SCHEMA, KEYS, ORDER = "id string, papers bigint, ts bigint", ["id"], ["ts"]


def rows_of(seed, n=400, ids=60):
    pick = random.Random(seed)
    return [(f"l{min(pick.randint(0, ids), pick.randint(0, ids))}", pick.randint(0, 9), 1000 * seed + i) for i in range(n)]


def data_files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{path}/data") for f in names if f.endswith(".parquet")}


def test_loads_are_the_latest_rows(spark, tmp_path):
    table, seen = BucketTable(spark, str(tmp_path / "t"), SCHEMA, KEYS, 16), []
    assert table.read().count() == 0
    for seed in (1, 3, 2):
        seen += rows_of(seed)
        table.upsert(spark.createDataFrame(rows_of(seed), SCHEMA), ORDER)
        expected = latest(spark.createDataFrame(seen, SCHEMA), KEYS, ORDER)
        assert sorted(tuples(table.read())) == sorted(tuples(expected))


def test_one_key_rewrites_one_bucket(spark, tmp_path):
    path = str(tmp_path / "t")
    table = BucketTable(spark, path, SCHEMA, KEYS, 16)
    table.upsert(spark.createDataFrame(rows_of(1), SCHEMA), ORDER)
    before = data_files(path)
    touched = table.upsert(spark.createDataFrame([("l3", 7, 10**6)] * 50, SCHEMA), ORDER)
    new = data_files(path) - before
    assert len(touched) == 1 and len(new) == 1 and f"bucket_number={touched[0]}/" in new.pop()
    assert before <= data_files(path)
    assert ("l3", 7, 10**6) in tuples(table.read()) and table.read().count() == len({r[0] for r in rows_of(1)})


def test_readers_keep_what_they_began_with(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), SCHEMA, KEYS, 4)
    table.upsert(spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], SCHEMA), ORDER)
    old = table.read()
    table.upsert(spark.createDataFrame([("a", 2, 2)], SCHEMA), ORDER)
    assert sorted(tuples(old)) == [("a", 1, 1), ("b", 1, 1)]
    assert sorted(tuples(table.read())) == [("a", 2, 2), ("b", 1, 1)]
    table.upsert(spark.createDataFrame([("a", 3, 3)], SCHEMA), ORDER)
    assert table.vacuum(keep=1) == 2
    assert sorted(tuples(table.read())) == [("a", 3, 3), ("b", 1, 1)]


def test_a_load_that_broke_off_is_not_seen(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), SCHEMA, KEYS, 4)
    table.upsert(spark.createDataFrame([("a", 1, 1)], SCHEMA), ORDER)

    def broken(old, new):
        return new.withColumn("papers", F.raise_error(F.lit("stop")).cast("bigint"))

    with pytest.raises(Exception, match="stop"):
        table.load(spark.createDataFrame([("a", 2, 2)], SCHEMA), broken)
    assert tuples(table.read()) == [("a", 1, 1)]
    table.upsert(spark.createDataFrame([("a", 3, 3)], SCHEMA), ORDER)
    assert tuples(table.read()) == [("a", 3, 3)]


def test_merges_may_drop_rows_and_tokens_load_once(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), "id string, n bigint", KEYS, 4)

    def add(old, new):
        return old.unionByName(new).groupBy("id").agg(F.sum("n").alias("n")).where("n <> 0")

    first = spark.createDataFrame([("a", 1), ("b", 2), (None, 5)], "id string, n bigint")
    assert table.load(first, add, "one") and not table.load(first, add, "one")
    table.load(spark.createDataFrame([("a", -1), ("c", 4)], "id string, n bigint"), add, "two")
    assert sorted(tuples(table.read()), key=str) == sorted([("b", 2), ("c", 4), (None, 5)], key=str)
    table.load(spark.createDataFrame([("b", -2), ("c", -4), (None, -5)], "id string, n bigint"), add)
    assert table.read().count() == 0
    assert table.load(first.limit(0), add, "none") == [] and table.loaded("none")
    table.vacuum(1)
    assert table.loaded("one") and table.loaded("two")


def test_an_old_table_keeps_its_number_of_buckets(spark, tmp_path):
    BucketTable(spark, str(tmp_path / "t"), SCHEMA, KEYS, 5)
    assert BucketTable(spark, str(tmp_path / "t"), SCHEMA, KEYS, 9).buckets == 5


def test_a_hot_key_and_its_bucket(spark, tmp_path):
    """Half of the incoming rows are one key; a bucket still has one row a key."""
    table = BucketTable(spark, str(tmp_path / "t"), SCHEMA, KEYS, 8)
    rows = spark.range(20_000).selectExpr("IF(id % 2 = 0, 'hot', concat('l', id % 97)) AS id", "id AS papers", "id AS ts")
    table.upsert(rows, ORDER)
    assert table.read().count() == 98
    assert table.read().where("id = 'hot'").first().ts == 19_998


def test_streams_load_buckets(spark, tmp_path):
    path, folder, cp = (str(tmp_path / n) for n in ("t", "in", "cp"))
    rows = rows_of(1) + rows_of(2)
    table = BucketTable(spark, path, SCHEMA, KEYS, 16)
    for part in (rows[:300], rows[300:500], rows[500:]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        jobs.refresh_buckets(jobs.read_events(spark, folder, SCHEMA, 1), table, cp, ORDER).awaitTermination(240)
    assert sorted(tuples(table.read())) == sorted(tuples(latest(spark.createDataFrame(rows, SCHEMA), KEYS, ORDER)))


def test_staged_rows_go_to_buckets(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), SCHEMA, KEYS, 4)
    rows = spark.createDataFrame([("a", 1, 1), ("b", -1, 1), ("c", None, 1)], SCHEMA)
    files.staged_upsert(rows, [("negative", F.col("papers") < 0)], str(tmp_path / "s"), table, ORDER)
    assert tuples(table.read()) == [("a", 1, 1)]
    held = spark.read.parquet(str(tmp_path / "s")).where("status = 'quarantine'")
    assert sorted(r.id for r in held.collect()) == ["b", "c"]
