"""Text, rules, loading, conversations, search and file sources."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scholarmill import schemas
from scholarmill.constants import AUTH_MESSAGE_RULES
from scholarmill.functions import text as tx
from scholarmill.functions.rules import first_failure, registration_rules
from scholarmill.operators import conversations, ingest, quality, search, trends
from scholarmill.operators.taxonomy import Taxonomy
from scholarmill.sources import files
from scholarmill.sources.buckets import BucketTable
from tests import fixtures
from tests.fixtures import labs, tuples


def column(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in sorted(tuples(df.select("i", fn(F.col("v")))))]


def test_trim(spark):
    values = ["  a b \n", " 　x﻿ ", "\t\r\n ", "", "a \u0085", "y​"]
    assert column(spark, values, tx.trimmed) == ["a b", "x", "", "", "a \u0085", "y​"]


def test_page_text(spark):
    pages = [
        "<html><head><title> A &amp;\n B </title><style>p{}</style></head><body>x<p>y</body>",
        "<SCRIPT type='a'>if (a<b) { '<!--' }</SCRIPT>kept<!-- <script> -->also<br/>this",
        "a &amp;lt; b&nbsp;&lt;c&gt; &quot;d&#39;",
        "<!-- one --> <b>two</b> <!-- three\nfour -->",
        "",
    ]
    assert column(spark, pages, tx.page_text) == [
        "A & B x y", "kept also this", "a &lt; b <c> \"d'", "two", ""]
    assert column(spark, pages, tx.page_title) == ["A & B", "", "", "", ""]


def test_long_page_is_read_whole(spark):
    page = "<script>" + "x<y;" * 200_000 + "</script>" + "<p>word</p> " * 100_000
    assert column(spark, [page], tx.page_text) == [" ".join(["word"] * 100_000)]


def test_links(spark):
    html = (
        '<a href="/people">a</a><a href="https://Lab.example.org/x">b</a>'
        '<a href="https://scholar.google.co.kr/citations?user=1">c</a><a href="https://dblp.org/pid/1">d</a>'
        '<a href="https://elsewhere.org/?u=dblp.org">e</a><a href="mailto:x@y">f</a>'
    )
    pages = spark.createDataFrame([(1, "https://lab.example.org/", html)], "page_id int, url string, html string")
    kinds = [r["kind"] for r in ingest.page_link_rows(pages).collect()]
    assert kinds == ["home", "home", "scholar", "dblp", "other", "other"]


def test_links_of_every_form(spark):
    html = (
        """<A HREF='/one'>a</A><a class=x href=two.html>b</a><a title="a > b" href="/three?a=1&amp;b=2">c</a>"""
        """<a href = "//scholar.google.com/citations?user=1">d</a><a href="HTTPS://Scholar.Google.de/x">e</a>"""
        """<a href="//dblp.org/pid/2">f</a><!-- <a href="/not"> --><script>x='<a href="/nor">'</script>"""
        """<a data-href="/no" href="">g</a><a href="mailto:a@b">h</a><a href="#top">i</a><a href="//other.org">j</a><a>k</a>"""
        """<p title=">" >l</p>""" + "<p " + "a='b' " * 20000 + ">m</p>"
    )
    rows = [(1, "//lab.example.org/", html), (2, "no scheme", '<a href="mailto:x">a</a><a href="https://lab.org">b</a>'), (3, "u", None)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string")
    found = sorted(tuples(ingest.page_link_rows(pages)))
    assert found == sorted([
        (1, "/one", "home"), (1, "two.html", "home"), (1, "/three?a=1&b=2", "home"),
        (1, "//scholar.google.com/citations?user=1", "scholar"), (1, "HTTPS://Scholar.Google.de/x", "scholar"),
        (1, "//dblp.org/pid/2", "dblp"), (1, "", "home"), (1, "mailto:a@b", "other"), (1, "#top", "home"),
        (1, "//other.org", "other"), (2, "mailto:x", "other"), (2, "https://lab.org", "other")])


def test_null_passes_no_rule(spark):
    rows = spark.createDataFrame([(1, 5), (2, -1), (3, None)], "id int, v int")
    rules = [("low", F.col("v") < 0), ("odd", F.coalesce(F.col("v") % 2 == 1, F.lit(False)))]
    marked = quality.checked(rows, rules).select("id", "status", "reasons")
    assert sorted(tuples(marked)) == [(1, "quarantine", "odd"), (2, "quarantine", "low"), (3, "quarantine", "low")]
    page = spark.createDataFrame([(1, "u", None)], "page_id int, url string, html string")
    (found,) = quality.checked(ingest.measured_pages(page), ingest.page_rules()).collect()
    assert found["status"] == "quarantine" and found["reasons"] == "no_title,short_text,no_links"


def test_parts_delivered_again_or_without_a_place(spark):
    rows = [("m", 0, "a"), ("m", 1, "b"), ("m", 1, "b"), ("m", 1, "bb"), ("m", None, "x"), ("m", None, "y"), (None, 3, "z")]
    parts = spark.createDataFrame(rows, "message_id string, seq bigint, text string")
    assert tuples(conversations.message_text(parts)) == [("m", 0, "ab", 2)]
    assert conversations.unplaced(parts, "message_id", "seq").count() == 3


def test_no_keywords_find_nothing(spark):
    docs = spark.createDataFrame([(1, "text")], "doc_id bigint, text string")
    assert search.keyword_search(docs, []).count() == 0


def test_message_class(spark):
    values = ["Error: Invalid login credentials", "Email not confirmed", "User already registered", "?",
              "Email not confirmed / Invalid login credentials"]
    found = column(spark, values, lambda c: tx.first_match(c, AUTH_MESSAGE_RULES))
    assert found == ["bad_credentials", "email_unconfirmed", "already_registered", "other", "bad_credentials"]


def test_registration(spark):
    rows = [
        ("a@b", "", "secret1", "other"),
        ("a@b", None, "secret1", "secret1"),
        ("a@b", "A", "secret1", "other"),
        ("a@b", "A", "12345", "12345"),
        ("a@b", "A", "123456", "123456"),
    ]
    df = spark.createDataFrame(rows, schemas.REGISTRATIONS).select(first_failure(registration_rules()))
    assert [r[0] for r in tuples(df)] == [
        "missing_field", "missing_field", "password_mismatch", "password_too_short", "ok"]


def test_exists_once(spark):
    probes = spark.createDataFrame([("none",), ("one",), ("two",)], "email string")
    users = spark.createDataFrame([("1", "one"), ("2", "two"), ("3", "two")], schemas.USERS)
    assert sorted(tuples(quality.exists_once(probes, users, "email"))) == [
        ("none", False), ("one", True), ("two", False)]
    assert sorted(tuples(quality.exists_once(probes, users, "email", strict=False))) == [
        ("none", False), ("one", True), ("two", True)]


def test_extracted_records(spark):
    docs = [
        (1, '{"name": "Lab", "paper_count": 3, "research_sub_fields": [1, 2], "extra": 1}'),
        (2, '{"name": "Lab", "paper_count": "many"}'),
        (3, "not json"),
        (4, "{}"),
    ]
    df = spark.createDataFrame(docs, "id int, body string")
    found = {r["id"]: r for r in ingest.extracted_records(df, "body", schemas.EXTRACTED_LAB).collect()}
    assert {i: r["is_corrupt"] for i, r in found.items()} == {1: False, 2: True, 3: True, 4: False}
    assert (found[1]["paper_count"], found[1]["research_sub_fields"]) == (3, [1, 2])
    assert found[4]["name"] is None


def test_fallback(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (None, None), (0, 5)], "a bigint, b bigint")
    found = df.select(*quality.with_fallback(F.col("a"), F.col("b")))
    assert tuples(found) == [(1, "primary"), (2, "secondary"), (0, "none"), (0, "primary")]


def test_staged_load(spark, tmp_path):
    schema = "id string, papers bigint, at int"
    current = spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], schema)
    crawl = spark.createDataFrame([("a", 5, 2), ("c", 7, 2), ("c", 6, 1), ("d", None, 2), ("b", 9, 0)], schema)
    rules = [("no_papers", F.col("papers").isNull())]
    target = str(tmp_path / "final")
    files.staged_load(spark, crawl, rules, str(tmp_path / "stage"), current, target, ["id"], ["at"])
    assert sorted(tuples(spark.read.parquet(target))) == [("a", 5, 2), ("b", 1, 1), ("c", 7, 2)]
    bad = spark.read.parquet(str(tmp_path / "stage/status=quarantine"))
    assert tuples(bad.select("id", "reasons")) == [("d", "no_papers")]


def test_url_sheet(spark, tmp_path):
    sheet = tmp_path / "sheet.csv"
    sheet.write_text("lab_id,url\n1,https://a.org\n2,\n3,https://c.org\n")
    assert tuples(files.read_url_sheet(spark, str(sheet)).select("lab_id")) == [("1",), ("3",)]


def test_bookmark_sinks(spark, tmp_path):
    make = lambda rows: spark.createDataFrame(rows, schemas.BOOKMARKS)
    table, rest = str(tmp_path / "marks"), str(tmp_path / "rest")
    files.append_bookmarks(make([("u", "1"), ("u", "2")]), table)
    assert tuples(files.append_bookmarks(make([("u", "1")]), table)) == [("u", "1")]
    stored = files.read_relation(spark, table, schemas.BOOKMARKS)
    assert stored.count() == 3
    files.rewrite_without(stored, make([("u", "1")]), rest)
    assert tuples(files.read_relation(spark, rest, schemas.BOOKMARKS)) == [("u", "2")]


def test_professor_source(spark, tmp_path):
    path = str(tmp_path / "labs")
    fixtures.labs(spark).write.parquet(path)
    assert files.read_professors(spark, path).count() == 5


def test_message_text(spark):
    chunks = spark.createDataFrame([("m", 2, "b"), ("m", 0, "a"), ("m", 1, ""), ("n", 0, "")], schemas.CHAT_CHUNKS)
    assert tuples(conversations.message_text(chunks).select("message_id", "text")) == [("m", "ab")]


@pytest.mark.parametrize("per_segment", [1, 3, 64])
def test_segments_join_to_the_whole(spark, per_segment):
    chunks = spark.createDataFrame([("m", i, f"<{i}>") for i in range(50)], schemas.CHAT_CHUNKS)
    parts = sorted(conversations.message_text(chunks, per_segment).collect(), key=lambda r: r["segment"])
    assert "".join(p["text"] for p in parts) == "".join(f"<{i}>" for i in range(50))
    assert max(p["n_parts"] for p in parts) <= per_segment


def test_transcript_drops_empty_user_turns(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", " hi "), (1, 1, "assistant", " yo "), (1, 2, "user", " \n ")],
        "conv_id bigint, turn bigint, role string, text string")
    assert tuples(conversations.transcripts(turns)) == [(1, 0, "user: hi\nassistant:  yo ", 2)]


def test_keyword_search(spark):
    docs = spark.createDataFrame([(1, "Robots and ROBOTS"), (2, "vision"), (3, "robot vision")], "doc_id bigint, text string")
    assert sorted(tuples(search.keyword_search(docs, ["Robot", "vision"]))) == [(1, 1, 2), (2, 1, 1), (3, 2, 2)]


@pytest.mark.parametrize("per_block", [10, 2, 1])
def test_vector_topk(spark, per_block):
    rng = np.random.default_rng(0)
    points = rng.normal(size=(500, 4)).round(1)
    points[100:300] = points[100]  # a large group of equal vectors
    points[7] = 0
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(7)
    queries = [(0, [1.0, 0.0, 0.0, 0.0]), (1, [float(x) for x in points[100]]), (2, [0.5, -1.0, 2.0, 0.0])]
    nowhere = [(8, [0.0] * 4), (9, None)]
    asked = spark.createDataFrame(queries + nowhere, "qid bigint, vector array<double>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        nearest = search.vector_topk(df, asked, 9, per_block)
        assert "Cogroup" not in nearest._jdf.queryExecution().toString()
        found = sorted(tuples(nearest.select("qid", "rk", "vec_id")))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    single = points.astype("float32").astype("float64")
    expected = []
    for qid, q in queries:
        keep = np.linalg.norm(single, axis=1) > 0
        sims = np.full(len(single), -2.0)
        sims[keep] = (single[keep] @ np.array(q)) / np.linalg.norm(single[keep], axis=1) / np.linalg.norm(q)
        order = sorted(range(len(single)), key=lambda i: (-round(sims[i], 6), i))[:9]
        expected += [(qid, rk, i) for rk, i in enumerate(order, start=1)]
    assert found == expected


def test_vector_topk_without_queries(spark):
    df = spark.createDataFrame([(1, [1.0])], "vec_id bigint, embedding array<float>")
    none = spark.createDataFrame([], "qid bigint, vector array<double>")
    assert search.vector_topk(df, none, 3).count() == 0


def test_trend(spark):
    papers = spark.createDataFrame([("p1", 2001)] * 2 + [("p1", 2002)] * 5 + [("p3", 2002)], "lab_id string, year bigint")
    labs = fixtures.labs(spark, [("p1", "u1", 1, 1, [1, 2]), ("p3", "u1", 1, 1, [9])])
    assert sorted(tuples(trends.paper_trend(papers, labs))) == [
        ("AI", 2001, 2, None), ("AI", 2002, 5, 3), ("Systems", 2002, 1, None)]


def test_compare(spark):
    pairs = spark.createDataFrame([("p1", "p3"), ("p3", "p4")], "lab_a string, lab_b string")
    assert sorted(tuples(search.compare_labs(fixtures.labs(spark), pairs))) == [
        ("p1", "p3", -5, None, 1), ("p3", "p4", 15, None, 0)]


def test_page_text_of_any_page(spark):
    pages = [
        """<p title="a>b">x &#8217; &copy;</p>""",
        "a &#x1F600;&#65;&#0;&#xD800; &lt;b&gt; &amp;lt; &unknown; &; & &#; AT&T",
        """<a title='it"s > that' href=x>y</a> 1 < 2 > z <p class="open>unpaired</p>""",
    ]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "page_id long, html string")
    found = [r.text for r in ingest.cleaned_pages(rows).orderBy("page_id").collect()]
    assert found == ["x ’ ©", "a 😀A�� <b> &lt; &unknown; &; & &#; AT&T", "y 1 z unpaired"]


def test_links_are_those_of_whole_tags(spark):
    html = """<a title=" href='no' " href="yes?a=1&amp;b=&#50;">x</a><a
      HREF = two>y</a><a href="cut<!-- <a href='hidden'> --><p>href=plain</p><a data-href=z>n</a><a hreflang=de href=''>e</a>"""
    rows = spark.createDataFrame([(1, "https://h.org/", html)], "page_id long, url string, html string")
    found = [r.link for r in ingest.page_link_rows(rows).collect()]
    assert found[:2] == ["yes?a=1&b=2", "two"] and "hidden" not in found and "no" not in found and "z" not in found


def test_trend_over_a_gap(spark):
    rows = [("p1", y) for y in (2000, 2003, 2003, 2004, None)]
    trend = trends.paper_trend(spark.createDataFrame(rows, "lab_id string, year long"), labs(spark, [("p1", "u1", 1, 1, [2])]))
    expected = [(2000, 1, None), (2001, 0, -1), (2002, 0, 0), (2003, 2, 2), (2004, 1, -1)]
    assert sorted((r.year, r.papers, r.change) for r in trend.collect()) == expected


def test_rules_over_sets(spark):
    rows = [(1, "a", "x", 5), (2, "a", "x", 5), (3, "b", "x", 5), (4, "c", "gone", -1), (5, None, "x", 5), (6, "d", None, 5)] + [
        (10 + n, "hot", "x", 1) for n in range(200)]
    frame = spark.createDataFrame(rows, "id long, k string, ref string, v long")
    targets = spark.createDataFrame([("x",), ("x",), (None,)], "name string")
    sets = [quality.Unique("repeated", ["k"]), quality.Reference("orphan", "ref", targets, "name")]
    found = {r.id: r.reasons for r in quality.set_checked(frame, [("negative", F.col("v") < 0)], sets).collect()}
    assert {i: found[i] for i in range(1, 7)} == {1: "repeated", 2: "repeated", 3: "", 4: "negative,orphan", 5: "repeated", 6: "orphan"}
    assert len(found) == len(rows) and all(found[10 + n] == "repeated" for n in range(200))


def test_a_load_with_too_many_bad_rows_is_refused(spark, tmp_path):
    rows = spark.createDataFrame([(str(i), i, i) for i in range(10)], "id string, papers long, ts long")
    table = BucketTable(spark, str(tmp_path / "t"), "id string, papers bigint, ts bigint", ["id"], 4)
    rules = [("small", F.col("papers") < 4)]
    with pytest.raises(files.LoadRefused) as refused:
        files.staged_upsert(rows, rules, str(tmp_path / "s1"), table, ["ts"], most_bad=0.3)
    assert refused.value.counts == {"rows": 10, "quarantined": 4} and table.read().count() == 0
    assert spark.read.parquet(str(tmp_path / "s1")).count() == 10
    files.staged_upsert(rows, rules, str(tmp_path / "s2"), table, ["ts"], most_bad=0.4)
    assert table.read().count() == 6
    files.staged_upsert(rows.limit(0), rules, str(tmp_path / "s3"), table, ["ts"], most_bad=0.0)


def test_corrupt_records_go_to_the_quarantine(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, '{"k": 3}'), (2, '{"k": "no"}'), (3, "{broken"), (4, '{"k": 99}'), (5, None), (6, '{"k": 4}')], "id long, doc string")
    labs_there = spark.createDataFrame([(3,), (4,)], "lab long")
    sets = [quality.Reference("orphan", "k", labs_there, "lab")]
    valid = files.stage_records(rows, "doc", "k bigint", [], str(tmp_path / "s"), sets)
    assert sorted((r.id, r.k) for r in valid.collect()) == [(1, 3), (6, 4)]
    held = spark.read.parquet(str(tmp_path / "s")).where("status = 'quarantine'").collect()
    assert {r.id: (r.reasons, r.raw) for r in held} == {
        2: ("corrupt,orphan", '{"k": "no"}'), 3: ("corrupt,orphan", "{broken"), 4: ("orphan", '{"k": 99}'), 5: ("orphan", None)}


def test_recommend_with_many_fields(spark):
    """Seventy fields: more than a bigint has bits; the answer is that of scoring every lab."""
    taxonomy = Taxonomy([(1, "C", f, f"F{f}", 100 + f, f"S{f}") for f in range(70)])
    pick = random.Random(2)
    rows = [(f"p{i}", "u1", pick.randint(0, 5), 1, sorted(pick.sample(range(100, 170), pick.randint(0, 4)))) for i in range(60)]
    marks = sorted({(f"user{pick.randint(0, 6)}", f"p{pick.randint(0, 59)}") for _ in range(25)})
    found = search.recommend(labs(spark, rows), spark.createDataFrame(marks, "user_id string, lab_id string"), 4, taxonomy)
    ids = {r[0]: set(r[4]) for r in rows}
    papers = {r[0]: r[2] for r in rows}
    expected = []
    for user in {u for u, _ in marks}:
        held = {p for u, p in marks if u == user}
        interest = set().union(*(ids[p] for p in held))
        scored = sorted((-len(ids[p] & interest), -papers[p], p) for p in ids if p not in held and ids[p] & interest)
        expected += [(user, p, -s, i) for i, (s, _, p) in enumerate(scored[:4], 1)]
    assert sorted(tuples(found)) == sorted(expected)


def test_vector_passes_are_stored(spark):
    vectors = spark.createDataFrame([(i, [float(i % 5), 1.0]) for i in range(40)], "vec_id long, embedding array<float>")
    queries = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(25)], "qid long, vector array<double>")
    found = search.vector_topk(vectors, queries, 3, per_block=4)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "ExistingRDD" not in plan
    assert sorted(tuples(found)) == sorted(tuples(search.vector_topk(vectors, queries, 3)))
