"""Queries give the same on stored canonical relations as on the tables they come from."""

from __future__ import annotations

import pytest

from scholarmill.operators import ranking, taxonomy
from scholarmill.plans import catalogue
from scholarmill.sources.relations import SCHEMAS, Relations, publish
from scholarmill.sources.tables import Tables
from tests import fixtures
from tests.conftest import SMALL

SHARED = [
    "q_ranking_by_subfield", "q_ranking_by_field", "q_ranking_all", "q_ranking_multi_selection",
    "q_professor_directory", "q_field_profile", "q_lab_field_text", "q_drilldown_totals",
    "q_taxonomy_flat", "q_area_members", "q_user_bookmarks", "q_bookmarks_in_area",
    "q_bookmark_counts", "q_professor_detail", "q_name_search", "q_ranking_refresh_diff", "q_drilldown",
]


@pytest.fixture(scope="module")
def relations(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("relations") / "all")
    publish(Tables(spark, SMALL), folder)
    return Relations(spark, folder)


def texts(df):
    names = sorted(df.columns)
    return sorted(tuple(str(r[n]) for n in names) for r in df.collect())


@pytest.mark.parametrize("name", SHARED)
def test_same_on_stored_relations(spark, relations, name):
    fn = getattr(catalogue, name)
    assert texts(fn(relations)) == texts(fn(Tables(spark, SMALL)))


def test_taxonomy_with_other_ids(spark, tmp_path):
    """Rankings follow the stored taxonomy, not the listed one."""
    fields = spark.createDataFrame([(1, "Systems", 1), (2, "AI", 1)], SCHEMAS["research_fields"])
    subs = spark.createDataFrame([(101, "Databases", 1), (102, "Machine learning", 2)], SCHEMAS["research_sub_fields"])
    for name, df in {"research_fields": fields, "research_sub_fields": subs}.items():
        df.write.parquet(str(tmp_path / name))
    found = Relations(spark, str(tmp_path)).taxonomy()
    labs = fixtures.labs(spark, [("a", "u1", 3, 1, [101]), ("b", "u2", 5, 1, [9]), ("c", "u2", 2, 1, [102, 101])])
    ranked = ranking.rank_universities(labs, fixtures.universities(spark), {"Systems": ["Databases"]}, taxonomy=found)
    assert sorted(fixtures.tuples(ranked)) == [(1, "Alpha", 3, 1), (2, "Beta", 2, 1)]
    profile = taxonomy.with_field_profile(labs, found).where("id = 'c'").first()["research_fields"]
    assert [tuple(f) for f in profile] == [("1", "AI", ["Machine learning"]), ("1", "Systems", ["Databases"])]


def test_stored_schema_and_pruning(spark, relations):
    for name in SCHEMAS:
        assert relations.relation(name).count() > 0
    plan = catalogue.q_ranking_all(relations)._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "FileScan" in x and "paper_count" in x)
    assert "lab_url" not in scan and "research_sub_fields" not in scan


def test_colocated_relations_join_without_a_shuffle(spark, small, tmp_path):
    """Joins and aggregates by lab read bucket against bucket; only the small side by university is sent."""
    from pyspark.sql import functions as F

    from scholarmill.operators import bookmarks
    from scholarmill.sources.relations import Relations, publish, publish_colocated
    from scholarmill.sources.tables import Tables

    publish(Tables(spark, small), str(tmp_path / "plain"))
    plain = Relations(spark, str(tmp_path / "plain"))
    labs = publish_colocated(plain, str(tmp_path / "buckets"), "colocated_test", buckets=4)
    try:
        for limit, made in (
            ("3KB", lambda r: bookmarks.bookmarked_labs(r.bookmarks(), r.labs(), r.universities())),
            ("-1", lambda r: r.labs().join(r.lab_bridges(r.labs())[0].withColumnRenamed("professor_id", "lab_id").drop("id"), F.col("id") == F.col("lab_id"))),
            ("-1", lambda r: r.bookmarks().groupBy("lab_id").count()),
        ):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            text = made(labs)._jdf.queryExecution().executedPlan().toString()
            assert "Exchange hashpartitioning" not in text and "Bucketed: true" in text
            assert "Exchange hashpartitioning" in made(plain)._jdf.queryExecution().executedPlan().toString()
            assert sorted(map(str, made(labs).collect())) == sorted(map(str, made(plain).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("professors", "professor_research_fields", "bookmarks"):
            spark.sql(f"DROP TABLE colocated_test_{name}")
