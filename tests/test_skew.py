"""A key that holds a third or more of the rows is split, not sent to one task."""

from __future__ import annotations

import random

import pytest

from scholarmill import schemas
from scholarmill.operators import bookmarks, quality
from tests import fixtures

LOW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def small_thresholds(spark):
    for key, value in LOW.items():
        spark.conf.set(key, value)
    yield
    for key in LOW:
        spark.conf.unset(key)


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_lab_in_bookmarks_is_split(spark, small_thresholds):
    rng = random.Random(1)
    labs = [(f"p{i:04d}", f"u{i % 2 + 1}", i, i, [i % 27]) for i in range(400)]
    marks = [(f"user{i}", "p0007" if i % 2 else f"p{rng.randint(0, 399):04d}") for i in range(20_000)]
    df = bookmarks.bookmarked_labs(
        spark.createDataFrame(marks, schemas.BOOKMARKS), fixtures.labs(spark, labs), fixtures.universities(spark)
    )
    assert "skew=true" in final_plan(df)
    assert df.count() == 20_000


def test_hot_key_shrinks_before_the_shuffle(spark):
    """Counting combines on the map side: the exchange carries one row per task and key."""
    rows = [("hot" if i % 3 else f"k{i}", i) for i in range(9_000)]
    targets = spark.createDataFrame(rows, "key string, i int").repartition(4)
    probes = spark.createDataFrame([("hot",), ("k0",), ("none",)], "key string")
    found = {r["key"]: r["exists"] for r in quality.exists_once(probes, targets, "key").collect()}
    assert found == {"hot": False, "k0": True, "none": False}
    plan = quality.exists_once(probes, targets, "key")._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
