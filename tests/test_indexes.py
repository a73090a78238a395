"""Bitmap and inverted indexes against scans of the same rows."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from scholarmill.operators import bitmaps, inverted
from tests.fixtures import labs, tuples

WANTED = "selection_id string, sub_field_id bigint"


def test_bitmaps_of_hand_made_labs(spark):
    index = bitmaps.lab_index(bitmaps.numbered(labs(spark)))
    wanted = spark.createDataFrame([("s", 1), ("s", 2), ("t", 3), ("none", 77), ("s", 2)], WANTED)
    assert sorted(tuples(bitmaps.matching_labs(index, wanted))) == [("none", 0), ("s", 3), ("t", 1)]
    by_university = sorted(tuples(bitmaps.matching_labs_by_university(index, wanted)))
    assert by_university == [("s", "u1", 1), ("s", "u2", 1), ("s", "u3", 1), ("t", "u1", 1)]


def test_bitmaps_over_many_ranges(spark):
    """A third of the labs have one sub-field; numbers reach over several ranges of a bitmap."""
    rows = spark.range(100_000).select(
        F.col("id").alias("number"),
        (F.col("id") % 7).alias("university_id"),
        F.expr("IF(id % 3 = 0, array(1, 2), array(id % 5 + 3))").cast("array<bigint>").alias("research_sub_fields"),
    )
    index = bitmaps.lab_index(rows.repartition(9)).cache()
    assert index.where("dimension = 'sub_field' AND value = '1'").count() > 1
    wanted = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), ("b", 3)], WANTED)
    total = dict(tuples(bitmaps.matching_labs(index, wanted)))
    third = sum(n % 3 == 0 for n in range(100_000))
    assert total == {"a": third, "b": third + sum(n % 3 != 0 and n % 5 == 0 for n in range(100_000))}
    mine = {u: n for s, u, n in tuples(bitmaps.matching_labs_by_university(index, wanted)) if s == "b"}
    assert mine == {str(u): sum(n % 7 == u and (n % 3 == 0 or n % 5 == 0) for n in range(100_000)) for u in range(7)}


def test_bitmaps_read_no_lab(spark, tmp_path):
    path = str(tmp_path / "index")
    bitmaps.lab_index(bitmaps.numbered(labs(spark))).write.parquet(path)
    wanted = spark.createDataFrame([("s", 1)], WANTED)
    plan = bitmaps.matching_labs(spark.read.parquet(path), wanted)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "professor" not in plan
    empty = bitmaps.lab_index(bitmaps.numbered(labs(spark)).limit(0))
    assert tuples(bitmaps.matching_labs(empty, wanted)) == [("s", 0)]


def bm25(docs, queries, k):
    words = {d: re.findall(r"[^\W_]+", (t or "").lower()) for d, t in docs}
    mean = sum(map(len, words.values())) / len(words)
    df = Counter(w for ws in words.values() for w in set(ws))
    out = []
    for q, text in queries:
        scored = []
        asked = set(re.findall(r"[^\W_]+", (text or "").lower()))
        for d, ws in words.items():
            times = Counter(ws)
            hit = [t for t in asked if times[t]]
            if hit:
                s = sum(math.log(1 + (len(words) - df[t] + 0.5) / (df[t] + 0.5)) * times[t] * 2.2
                        / (times[t] + 1.2 * (0.25 + 0.75 * len(ws) / mean)) for t in hit)
                scored.append((-round(s, 6), d, len(hit)))
        out += [(q, d, -s, n, i) for i, (s, d, n) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def test_ranked_search_is_bm25(spark, tmp_path):
    pick = random.Random(6)
    vocabulary = ["the"] * 30 + [f"w{n}" for n in range(40)] + ["Été", "naïve", "日本"]
    docs = [(i, " ".join(pick.choice(vocabulary) for _ in range(pick.randint(0, 30)))) for i in range(80)]
    docs += [(200, None), (201, ""), (202, "same words"), (203, "same words")]
    queries = [(1, "the w3"), (2, "ÉTÉ the the"), (3, ""), (4, None), (5, "unknown"), (6, "same words, same!"), (7, "日本 w1-w2")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    for per_part in (7, 1 << 16):  # with 7, "the" has many parts
        path = str(tmp_path / f"i{per_part}")
        inverted.build_index(frame.unionByName(spark.createDataFrame([(None, "the lost row")], frame.schema)), path, per_part)
        found = inverted.TextIndex(spark, path).search(spark.createDataFrame(queries, "qid long, text string"), 5)
        rows = sorted((r.qid, r.doc_id, r.score, r.n_terms, r.rk) for r in found.collect())
        assert rows == bm25(docs, queries, 5)
    assert spark.read.parquet(str(tmp_path / "i7" / "terms")).where("term = 'the'").first().parts > 5


def test_search_opens_the_folders_of_its_terms(spark, tmp_path):
    path = str(tmp_path / "i")
    docs = spark.createDataFrame([(i, " ".join(f"t{n}" for n in range(i % 9, 60))) for i in range(40)], "doc_id long, text string")
    inverted.build_index(docs, path)
    index = inverted.TextIndex(spark, path)
    found = index.search(spark.createDataFrame([(1, "t59")], "qid long, text string"), 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "folder#" in plan
    assert found.count() == 3


def test_search_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    inverted.build_index(empty, str(tmp_path / "i"))
    index = inverted.TextIndex(spark, str(tmp_path / "i"))
    assert index.search(spark.createDataFrame([(1, "a")], "qid long, text string"), 3).count() == 0


def test_ranked_search_deals_no_document_out_by_term_or_query(spark, tmp_path):
    """Building shuffles a row for a term and task, a search packed postings; scored pairs meet in their part."""
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.expr("concat('all of these words are everywhere ', id % 7)").alias("text"))
    path = str(tmp_path / "i")
    inverted.build_index(docs.repartition(3), path, 50)
    index = inverted.TextIndex(spark, path)
    rows = index.postings.where(f"folder < {inverted.FOLDERS}")
    assert rows.where("term = 'all'").count() < 20 and rows.where("term = 'all'").selectExpr("sum(size(places))").first()[0] == 400
    queries = spark.createDataFrame([(q, f"all of these words are {q % 9}") for q in range(60)], "qid long, text string")
    found = index.search(queries, 2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(qid" not in plan.split("FlatMapGroupsInArrow")[1] and "hashpartitioning(part" in plan
    assert sum("Exchange hashpartitioning" in line for line in plan.splitlines()) == 2
    whole = sorted(tuples(found))
    assert whole == sorted(tuples(index.search(queries, 2, per_block=7)))
    assert [(q, d) for q, d, *_, rk in whole if rk == 1] == [(q, q % 9 if q % 9 < 7 else 0) for q in range(60)]
