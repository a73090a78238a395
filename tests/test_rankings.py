"""Kept rankings equal the ranking of all labs after any feed."""

from __future__ import annotations

import os
import random

import pytest

from scholarmill import schemas
from scholarmill.operators.ranking import rank_selections
from scholarmill.operators.taxonomy import constant_relation, research_fields, research_sub_fields
from scholarmill.plans.catalogue import SELECTIONS
from scholarmill.sources.rankings import FEED, KeptRankings
from scholarmill.streaming import jobs
from tests.fixtures import tuples

SCHEMA = FEED.format(id="string", university="string")


def feed(seed, n, labs=30):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        ids = sorted(pick.sample(range(1, 26), pick.randint(0, 3))) or None
        rows.append((f"l{pick.randint(0, labs)}", pick.choice(["u1", "u2", "u3", None]), pick.choice([None, 0, 3, 7]), ids,
                     pick.random() < 0.2, 1000 * seed + i))
    return rows


def final(rows):
    newest = {}
    for r in rows:
        if r[0] not in newest or newest[r[0]][5] < r[5]:
            newest[r[0]] = r
    return [r for r in newest.values() if not r[4]]


@pytest.fixture(scope="module")
def parts(spark):
    universities = spark.createDataFrame([("u1", "Alpha"), ("u2", "Beta"), ("u3", "Alpha")], schemas.UNIVERSITIES)
    selections = constant_relation(spark, SELECTIONS, schemas.SELECTIONS)
    return universities, selections, research_sub_fields(spark), research_fields(spark)


def expected(spark, rows, parts):
    return sorted(tuples(rank_selections(spark.createDataFrame(final(rows), SCHEMA), *parts)))


def test_random_edits_in_any_order(spark, tmp_path, parts):
    kept, seen = KeptRankings(spark, str(tmp_path / "k"), buckets=4), []
    for seed in (2, 4, 3):  # the third feed is older than the second
        rows = feed(seed, 120)
        seen += rows
        kept.apply(spark.createDataFrame(rows, SCHEMA).repartition(3))
        assert sorted(tuples(kept.rank(*parts))) == expected(spark, seen, parts)
    cells = tuples(kept.cells.read())
    assert sum(r[3] for r in cells) == len(final(seen)) and all(r[3] > 0 for r in cells)


def test_a_feed_of_one_lab_touches_its_buckets_only(spark, tmp_path, parts):
    rows = feed(1, 200, 80)
    kept = KeptRankings(spark, str(tmp_path / "k"), buckets=32)
    kept.apply(spark.createDataFrame(rows, SCHEMA))

    def written(name):
        return {d for d, _, names in os.walk(tmp_path / "k" / name / "data") if any(n.endswith(".parquet") for n in names)}

    before = {name: written(name) for name in ("labs", "cells")}
    kept.apply(spark.createDataFrame([(*rows[0][:1], "u1", 5, [1, 2], False, 10**6)], SCHEMA))
    assert len(written("labs") - before["labs"]) == 1
    assert len(written("cells") - before["cells"]) <= 2
    assert sorted(tuples(kept.rank(*parts))) == expected(spark, [*rows, (rows[0][0], "u1", 5, [1, 2], False, 10**6)], parts)


def test_a_load_that_broke_off_is_finished_by_its_token(spark, tmp_path, parts, monkeypatch):
    kept = KeptRankings(spark, str(tmp_path / "k"), buckets=4)
    one, two = feed(1, 60), feed(2, 60)
    kept.apply(spark.createDataFrame(one, SCHEMA), "one")
    load = kept.labs.load
    monkeypatch.setattr(kept.labs, "load", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        kept.apply(spark.createDataFrame(two, SCHEMA), "two")
    monkeypatch.setattr(kept.labs, "load", load)
    for _ in range(2):
        kept.apply(spark.createDataFrame(two, SCHEMA), "two")
        assert sorted(tuples(kept.rank(*parts))) == expected(spark, one + two, parts)


def test_a_stream_of_edits(spark, tmp_path, parts):
    rows, folder = feed(5, 150), str(tmp_path / "in")
    kept = KeptRankings(spark, str(tmp_path / "k"), buckets=4)
    for part in (rows[:70], rows[70:]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        kept.follow(jobs.read_events(spark, folder, SCHEMA, 1), str(tmp_path / "cp")).awaitTermination(240)
    assert sorted(tuples(kept.rank(*parts))) == expected(spark, rows, parts)
