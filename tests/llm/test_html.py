from __future__ import annotations

import html as entities
import itertools
import random
import re

from scholarmill.llm import html, queries
from tests.conftest import CHECK


def by_template(page):
    """What the pages of the test data hold: everything in the article element."""
    inside = page.split("<article>")[1].split("</article>")[0]
    parts = re.split(r"</?(?:p|h1)>", inside)
    plain = (" ".join(entities.unescape(re.sub(r"<[^>]*>", " ", p) if "<br" in p else re.sub(r"<[^>]*>", "", p)).split()) for p in parts)
    return "\n".join(p for p in plain if p)


def test_query(spark):
    pages = {r.page_id: (r.url, by_template(r.html)) for r in spark.read.parquet(f"{CHECK}/pages.parquet").collect()}
    rows = queries.op6_html(spark, CHECK).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.url, r.text, r.n_chars) == (*pages[r.page_id], len(r.text))


def test_labels_are_a_minimum_cut():
    rng = random.Random(2)
    for _ in range(150):
        n = rng.randint(1, 9)
        found = [(rng.choice(["Word", "A sentence ends here.", "some words " * 9, "twelve words or so without an end"]),
                  rng.choice([0, 0, 3, 400]), rng.choice([0, 0, 0, 1]), rng.choice([0, 0, 1, 2]), rng.randint(0, 2)) for _ in range(n)]
        edges, last = [], {}
        for i, b in enumerate(found):
            edges += [(i - 1, i, html.NEXT)] * (i > 0) + [(last.get(b[4]), i, html.SIBLING)] * (b[4] in last)
            last[b[4]] = i

        def cost(labels):
            own = sum((c[1] if x else c[0]) for c, x in zip(map(html.costs, found), labels))
            return own + sum(w for a, b, w in edges if labels[a] != labels[b])

        best = min(map(cost, itertools.product([False, True], repeat=n)))
        assert abs(cost(html.labels(found)) - best) < 1e-6


PAGE = """<!doctype html><html><head><title>Not this</title><style>p{}</style><meta charset=utf-8></head><body class="page has-sidebar">
<header><h1>Site</h1><p>The best site there is, every day of the week, for you and all of your friends.</p></header>
<nav><ul><li><a href=/>Home</a><li><a href=/x>News</a></ul></nav>
<div id="cookie-notice"><p>We use cookies. This is a long notice that has many words, as such notices always do.</p></div>
<div class="content"><article><h1>Title &amp; more</h1><p>First  paragraph
with <a href=y>a link</a> and <b>bold</b>text.<p>Short.<blockquote>A quote &lt;here&gt;</blockquote>
<div class="ad">Buy this wonderful thing now, it is the best thing that money can buy these days.</div>
<table><tr><td>one<td>two</table><script>var x = "</p><p>no";</script><!-- <p>no</p> -->
<form><p>Name and address, please give them here to get our letter every single week.</p><input></form>
<section class="comments"><h2>Comments</h2><p>I read this with joy, and so should you, dear reader of comments.</p></section>
</article></div><aside><p>Others read this very long line about other things that are not this article at all.</p></aside>
<footer>&copy; us</footer></body></html>"""


def test_page_of_every_kind():
    assert html.main_text(PAGE) == "Title & more\nFirst paragraph with a link and boldtext.\nShort.\nA quote <here>\none\ntwo"


def test_page_without_marks():
    page = "<div><a href=1>Home</a> <a href=2>Shop</a></div><div><p>%s</p><p>So it is.</p><p>%s</p></div>" % ("A long tale. " * 9, "It went on. " * 9)
    assert html.main_text(page) == "\n".join([("A long tale. " * 9).strip(), "So it is.", ("It went on. " * 9).strip()])


def test_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (2, "u", "<p>"), (None, "u", "plain words, and they end here."), (3, "u", "<article>" + "<p>Is so.</p>" * 4000),
            (4, "u", "<" * 1000), (5, "u", "<b>" * 3000 + "deep words end here.")]
    pages = spark.createDataFrame([(*r, "t", 0) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    found = {(r.page_id, r.url): r for r in html.extract(pages).collect()}
    assert len(found) == len(rows)
    assert found[1, "u"].text == found[2, None].text == found[2, "u"].text == "" and found[1, "u"].n_chars == 0
    assert found[None, "u"].text == "plain words, and they end here."
    assert found[3, "u"].text == "\n".join(["Is so."] * 4000)
    assert found[5, "u"].text == "deep words end here."
    assert html.extract(pages.limit(0)).count() == 0


def test_words_of_elements_around_the_article():
    text = "This is the article, and it has a whole sentence that is long enough to count as prose."
    for mark in ("class='layout has-sidebar'", "class='with-sidebar'", "class='no-sidebar'", "id='legal'", "class='search tags'"):
        assert html.main_text(f"<body><div {mark}><article><p>{text}</p></article></div></body>") == text
        assert html.main_text(f"<body><div {mark}><div class='post-content'><p>{text}</p></div></div></body>") == text or "has" not in mark
    # One word gives way to the cut, more of them do not.
    assert html.main_text(f"<div id='legal'><div class='post-content'><p>{text}</p></div></div>") == text
    assert html.main_text(f"<div class='comments'><div class='comment'><div class='text'><p>{text}</p></div></div></div>") == ""
    assert html.main_text(f"<article><p>{text}</p><section class='comments'><article><p>Mine. {text}</p></article></section></article>") == text


def test_title_formula_and_closed_svg():
    page = """<body><header><h1>Site</h1></header><article><header class="entry-header"><h1>Title</h1><p>By someone, who wrote this on a day.</p></header>
    <p>So <math><msup><mi>x</mi><mn>2</mn></msup><annotation>x^2</annotation></math> is a square.</p><svg viewBox="0"/><p>It goes on.</p></article></body>"""
    assert html.main_text(page) == "Title\nSo x2 is a square.\nIt goes on."
