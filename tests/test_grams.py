"""The name index against every name."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from scholarmill.operators import grams
from tests.fixtures import tuples


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_containing(spark, tmp_path):
    pick = random.Random(1)
    names = [(i, "".join(pick.choice("abAB é日.%_") for _ in range(pick.randint(0, 9)))) for i in range(300)]
    names += [(1000 + i, "hot name") for i in range(150)] + [(2000, None), (2001, ""), (2002, "hot name")]
    terms = ["a", "AB", "hot", "HOT NAME", "t n", "é日", "%", "_.", "zzz", "abab", "", None, "hot", "a" * 20]
    grams.build_names(spark.createDataFrame(names, "id long, name string").repartition(3), str(tmp_path / "n"))
    found = grams.NameIndex(spark, str(tmp_path / "n")).containing(spark.createDataFrame([(t,) for t in terms], "term string"))
    expected = {(t, i, n) for t in terms if t for i, n in names if n and t.lower() in n.lower()}
    rows = tuples(found)
    assert len(rows) == len(set(rows)) and set(rows) == expected


def test_a_search_reads_postings_of_its_grams(spark, tmp_path):
    path = str(tmp_path / "n")
    names = spark.range(500).select("id", F.concat(F.lit("lab "), F.col("id").cast("string")).alias("name"))
    grams.build_names(names, path)
    counts = {r.gram: r.names for r in spark.read.parquet(f"{path}/counts").collect()}
    assert counts["lab"] == 500 and counts["499"] == 1  # the rare one is looked up
    found = grams.NameIndex(spark, path).containing(spark.createDataFrame([("b 499",)], "term string"))
    assert tuples(found) == [("b 499", 499, "lab 499")]


def test_renamed(spark):
    pick = random.Random(4)
    old = ["".join(pick.choice("abcde ") for _ in range(pick.randint(1, 18))) for _ in range(120)] + ["University of Here", "aaaaaaaaaa", None]
    new = []
    for name in old[:-1]:
        changed = list(name)
        for _ in range(pick.randint(0, 4)):
            at = pick.randint(0, len(changed))
            changed[at : at + pick.randint(0, 1)] = pick.choice(["", "x", "Q"])
        new.append("".join(changed))
    new += ["university of there", "aaaaaaaaaaa", None, "completely different"]
    found = grams.renamed(spark.createDataFrame([(n,) for n in old], "name string"), spark.createDataFrame([(n,) for n in new], "name string"))
    expected = set()
    gone, came = {o for o in old if o is not None and o not in new}, {n for n in new if n is not None and n not in old}
    for o in gone:
        near = sorted((edits(o.lower(), n.lower()), n) for n in came if edits(o.lower(), n.lower()) <= min(len(o) // 5, 3))
        # A name that only changed its case shares all of its letters.
        if near:
            expected.add((o, near[0][1], near[0][0]))
    assert set(tuples(found)) == expected and len(expected) > 20
