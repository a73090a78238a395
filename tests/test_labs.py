"""Rankings, profiles and texts on hand-worked labs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from scholarmill import schemas
from scholarmill.constants import AREAS, taxonomy_rows
from scholarmill.functions import collections as coll
from scholarmill.functions.labs import lab_summary, member_text, present, size_class, size_text
from scholarmill.operators import detail, ranking, selection, taxonomy
from tests import fixtures
from tests.fixtures import tuples


SMALL_TAXONOMY = taxonomy.Taxonomy(fixtures.ROWS)


def rank(spark, **how):
    how.setdefault("taxonomy", SMALL_TAXONOMY)
    found = ranking.rank_universities(fixtures.labs(spark), fixtures.universities(spark), **how)
    return sorted(tuples(found))


def test_taxonomy_ids():
    rows = taxonomy_rows()
    assert len(rows) == 28
    assert [r[4] for r in rows] == [*range(1, 28), 55]
    assert sum(len(ids) for _, _, ids in AREAS) == 26


def test_ranking_without_filter(spark):
    assert rank(spark) == [(1, "Alpha", 15, 2), (2, "Beta", 15, 2)]


@pytest.mark.parametrize(
    ("chosen", "enabled", "expected"),
    [
        ({"Systems": ["Databases"]}, None, [(1, "Alpha", 10, 1)]),
        ({"AI": ["Databases"]}, None, []),
        ({"Systems": ["Databases"]}, ["AI"], [(1, "Alpha", 10, 1)]),
        (None, ["AI"], [(1, "Beta", 15, 1), (2, "Alpha", 10, 1)]),
        ({"Systems": []}, None, []),
        ({}, [], [(1, "Alpha", 15, 2), (2, "Beta", 15, 2)]),
        (None, ["CS"], []),
    ],
)
def test_ranking_filters(spark, chosen, enabled, expected):
    assert rank(spark, selection=chosen, enabled=enabled) == expected


def test_same_name_merges_and_null_papers_count_zero(spark):
    rows = [("a", "u1", None, 1, []), ("b", "u2", 4, 1, [])]
    unis = spark.createDataFrame([("u1", "Same"), ("u2", "Same")], schemas.UNIVERSITIES)
    found = ranking.rank_universities(fixtures.labs(spark, rows), unis)
    assert tuples(found) == [(1, "Same", 4, 2)]


@pytest.mark.parametrize(
    ("ids", "chosen", "enabled", "expected"),
    [
        (["p1", "p2"], {}, ["AI"], ["p1"]),
        (["p1", "p2"], {}, [], []),
        (["p1", "p3"], {"Systems": ["Databases"]}, ["AI"], ["p1", "p3"]),
    ],
)
def test_drilldown(spark, ids, chosen, enabled, expected):
    labs = fixtures.labs(spark).where(F.col("id").isin(ids))
    found = ranking.drilldown(labs, fixtures.universities(spark), chosen, enabled, SMALL_TAXONOMY)
    assert sorted(r["id"] for r in found.collect()) == expected


def test_drilldown_totals_equal_ranking(spark):
    """On a selection the interface can reach both give the same labs."""
    chosen = {"AI": ["Artificial intelligence"], "Systems": ["Databases"]}
    rows = [(f"x{i}", "u1" if i % 3 else "u2", i, i, [i % 12, i % 5]) for i in range(40)]
    labs, unis = fixtures.labs(spark, rows), fixtures.universities(spark)
    ranked = {r["university"]: (r["paper_count"], r["lab_count"])
              for r in ranking.rank_universities(labs, unis, chosen).collect()}
    totals = {r["university"]: (r["total_papers"], r["lab_count"])
              for r in ranking.drilldown_totals(labs, unis, chosen, []).collect()}
    assert ranked == totals


def test_profile(spark):
    found = taxonomy.with_field_profile(fixtures.labs(spark), SMALL_TAXONOMY)
    profile = {r["id"]: [tuple(f) for f in r["research_fields"]] for r in found.collect()}
    assert profile["p1"] == [
        ("1", "Systems", ["Databases", "Computer security"]),
        ("1", "AI", ["Machine learning"]),
    ]
    assert profile["p2"] == [] and profile["p4"] == []


def test_profile_repeats_and_first_category(spark):
    rows = [*fixtures.ROWS, (7, "Other", 9, "Systems", 4, "Compilers")]
    labs = fixtures.labs(spark, [("a", "u1", 1, 1, [2, 2]), ("b", "u1", 1, 1, [4, 2]), ("c", "u1", 1, 1, None)])
    found = taxonomy.with_field_profile(labs, taxonomy.Taxonomy(rows)).collect()
    profile = {r["id"]: [tuple(f) for f in r["research_fields"]] for r in found}
    assert profile["a"] == [("1", "Systems", ["Databases", "Databases"])]
    assert profile["b"] == [("7", "Systems", ["Compilers", "Databases"])]
    assert profile["c"] == []


def test_profile_by_join_is_the_same(spark):
    labs = fixtures.labs(spark, [(f"x{i}", "u1", 1, 1, [(i * 7 + j * 5) % 30 for j in range(i % 6)]) for i in range(60)])
    flat = taxonomy.with_field_profile(labs, taxonomy.listed()).select("id", F.explode("research_fields").alias("f"))
    nested = {(r["id"], r["f"]["field"]): (r["f"]["category"], r["f"]["sub_fields"]) for r in flat.collect()}
    dim = taxonomy.sub_field_dim(taxonomy.research_sub_fields(spark), taxonomy.research_fields(spark))
    joined = {(r["id"], r["field"]): (r["category"], r["sub_fields"])
              for r in taxonomy.field_profile_rows(labs, dim).collect()}
    assert nested == joined and len(nested) > 50


def test_three_forms_of_the_sub_field_test_agree(spark):
    labs = fixtures.labs(spark, [(f"x{i}", "u1", 1, 1, [(i * 7 + j * 5) % 30 for j in range(i % 6)]) for i in range(90)])
    chosen = {"Systems": ["Databases", "Computer networks"], "Theory": ["Cryptography"], "AI": []}
    by_ids = labs.where(selection.ranking_filter(F.col("research_sub_fields"), taxonomy.listed(), chosen, None))
    profiled = taxonomy.with_field_profile(labs, taxonomy.listed())
    by_names = profiled.where(selection.profile_filter(F.col("research_fields"), chosen))
    rows = [(f, s) for f, subs in chosen.items() for s in subs]
    wanted = spark.createDataFrame(rows, "field string, sub_field string")
    flat = profiled.select("id", F.explode("research_fields").alias("f")).select(
        "id", "f.field", F.explode("f.sub_fields").alias("sub_field"))
    by_join = selection.keep_selected(labs, flat, wanted)
    found = [sorted(r["id"] for r in df.collect()) for df in (by_ids, by_names, by_join)]
    assert found[0] == found[1] == found[2] and found[0]


def test_adding_a_sub_field_never_removes_a_lab(spark):
    labs = fixtures.labs(spark, [(f"x{i}", "u1", 1, 1, [i % 28]) for i in range(60)])
    before: set = set()
    chosen: dict = {}
    for _, _, _, field, _, sub in taxonomy_rows()[::5]:
        chosen.setdefault(field, []).append(sub)
        kept = labs.where(selection.ranking_filter(F.col("research_sub_fields"), taxonomy.listed(), chosen, None))
        now = {r["id"] for r in kept.collect()}
        assert before <= now
        before = now


def test_multi_selection_equals_single_rankings(spark):
    rows = [(f"x{i}", f"u{i % 2 + 1}", i % 9, 1, [i % 28, (i * 3) % 28, (i * 3) % 28]) for i in range(120)]
    labs, unis = fixtures.labs(spark, rows), fixtures.universities(spark)
    choices = {"a": {"Systems": ["Databases"], "AI": ["Machine learning"]}, "b": {"Theory": ["Cryptography"]}}
    table = [(k, f, s) for k, c in choices.items() for f, subs in c.items() for s in subs]
    every = tuples(ranking.rank_selections(
        labs, unis, spark.createDataFrame(table, schemas.SELECTIONS),
        taxonomy.research_sub_fields(spark), taxonomy.research_fields(spark)))
    for key, chosen in choices.items():
        single = sorted(tuples(ranking.rank_universities(labs, unis, chosen)))
        assert sorted(r[1:] for r in every if r[0] == key) == single


def test_refresh_diff(spark):
    names = "university string, paper_count bigint"
    old = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3)], names)
    new = spark.createDataFrame([("A", 1), ("B", 5), ("D", 9)], names)
    found = {r["university"]: r["status"] for r in ranking.refresh_diff(old, new).collect()}
    assert found == {"A": "kept", "B": "changed", "C": "dropped"}


def test_area_filter(spark):
    ids = F.col("research_sub_fields")
    labs = fixtures.labs(spark, [*fixtures.LABS, ("p6", "u1", 1, 1, None)])
    in_area = lambda area: sorted(
        r["id"] for r in labs.where(selection.area_filter(ids, area)).collect())
    assert in_area("ai") == ["p1", "p3", "p5"]
    assert in_area("nowhere") == []
    assert in_area(None) == ["p1", "p2", "p3", "p4", "p5", "p6"]


def test_size_and_texts(spark):
    rows = [(20,), (19,), (8,), (7,), (1,), (-1,), (0,), (None,)]
    df = spark.createDataFrame(rows, "m bigint").select(
        "m", size_class(F.col("m")).alias("s"), member_text(F.col("m")).alias("t"))
    found = {r["m"]: (r["s"], r["t"]) for r in df.collect()}
    assert [found[m[0]][0] for m in rows] == [
        "large", "medium", "medium", "small", "small", "small", "unknown", "unknown"]
    assert found[0][1] == "0명" and found[None][1] == "알 수 없음"
    long = spark.createDataFrame([("large",), ("unknown",)], "s string").select(size_text(F.col("s")))
    assert tuples(long) == [("대형 연구실",), ("알 수 없음",)]


def test_summary_and_links(spark):
    df = fixtures.labs(spark).where("id = 'p3'").select(
        lab_summary(F.col("department"), F.col("paper_count"), F.col("lab_member_count")).alias("s"),
        lab_summary(F.col("department"), F.col("paper_count"), F.col("lab_member_count"), F.lit("Beta")).alias("u"),
        present(F.col("lab_url")), present(F.col("scholar_url")), present(F.col("dblp_url")))
    assert tuples(df) == [
        ("CS | 논문 15편 | 연구원 알 수 없음", "Beta | CS | 논문 15편 | 연구원 알 수 없음", False, False, True)]


def test_id_text(spark):
    df = spark.createDataFrame([([2, 1, 3],), ([],), (None,)], "ids array<bigint>")
    assert tuples(df.select(coll.ids_text(F.col("ids")))) == [("2, 1, 3",), ("정보 없음",), ("정보 없음",)]


def test_collection_edits(spark):
    df = spark.createDataFrame(
        [(["a", "b", "a"], {"x": ["1"], "y": ["2", "3"]}), (None, {})],
        "items array<string>, m map<string, array<string>>")
    found = tuples(df.select(
        coll.toggle_item(F.col("items"), F.lit("a")),
        coll.toggle_item(F.col("items"), F.lit("z")),
        coll.contains(F.col("items"), F.lit("b")),
        coll.without_key(F.col("m"), F.lit("x")),
        coll.with_entry(F.col("m"), F.lit("x"), F.array(F.lit("9"))),
        coll.items_at(F.col("m"), F.lit("q")),
        coll.key_count(F.col("m"))))
    assert found[0] == (["b"], ["a", "b", "a", "z"], True, {"y": ["2", "3"]},
                        {"y": ["2", "3"], "x": ["9"]}, [], 2)
    assert found[1] == (["a"], ["z"], False, {}, {"x": ["9"]}, [], 0)


def test_detail(spark):
    fields = spark.createDataFrame([(1, "AI", 1), (2, "Systems", 1)], schemas.RESEARCH_FIELDS)
    subs = spark.createDataFrame(
        [(1, "Machine learning", 1), (2, "Databases", 2), (3, "Computer security", 2)], schemas.RESEARCH_SUB_FIELDS)
    lab_fields = spark.createDataFrame(
        [(10, "p1", 2), (11, "p1", 1), (12, "p1", 9), (13, "p3", 1)], schemas.PROFESSOR_RESEARCH_FIELDS)
    lab_subs = spark.createDataFrame([(10, 2), (10, 3), (10, 77), (13, 1)], schemas.PROFESSOR_SUB_FIELDS)
    found = detail.lab_detail(
        fixtures.labs(spark), fixtures.universities(spark), lab_fields, lab_subs, fields, subs)
    nested = {r["id"]: [tuple(f) for f in r["research_fields"]] for r in found.collect()}
    assert nested == {
        "p1": [("1", "AI", []), ("1", "Systems", ["Databases", "Computer security"])],
        "p2": [], "p3": [("1", "AI", ["Machine learning"])], "p4": []}
    one = detail.lab_detail(
        fixtures.labs(spark), fixtures.universities(spark), lab_fields, lab_subs, fields, subs, lab_id="p3")
    assert [(r["id"], r["lab_count"], r["lab_member_count"]) for r in one.collect()] == [("p3", 1, 0)]
