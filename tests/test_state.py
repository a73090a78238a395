"""Positions, bookmark changes and folded state against step-by-step replays."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from scholarmill import schemas
from scholarmill.constants import FIELDS, taxonomy_rows
from scholarmill.operators import bookmarks, positions, search, state
from tests import fixtures
from tests.fixtures import tuples


def replay(events):
    """Press by press, as a person at the selector would."""
    on, chosen = {}, {}
    for session, _, kind, field, sub in sorted(events):
        key = (session, field)
        held = chosen.get(key, [])
        if kind == "field":
            on[key] = not on.get(key, False)
            chosen[key] = list(FIELDS[field]) if on[key] else []
        else:
            chosen[key] = [s for s in held if s != sub] if sub in held else [*held, sub]
            on[key] = on.get(key, False) and bool(chosen[key])
    return {k: (on[k], sorted(chosen[k])) for k in chosen}


def folded(df):
    rows = df.select(*state.KEYS, "enabled", state.sub_fields_of(F.col("selected")).alias("s")).collect()
    return {(r["session"], r["field"]): (r["enabled"], sorted(r["s"])) for r in rows}


def presses(seed, n, sessions, fields=("AI", "Theory", "etc")):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        field = rng.choice(fields)
        kind = "field" if rng.random() < 0.25 else "sub"
        sub = None if kind == "field" else rng.choice(FIELDS[field])
        out.append((rng.choice(sessions), i, kind, field, sub))
    return out


@pytest.mark.parametrize(
    ("kinds", "expected"),
    [
        (["F"], (True, FIELDS["Theory"])),
        (["F", "F"], (False, [])),
        (["Cryptography"], (False, ["Cryptography"])),
        (["Cryptography", "F"], (True, FIELDS["Theory"])),
        (["F", *FIELDS["Theory"]], (False, [])),
        (["F", *FIELDS["Theory"], "Cryptography"], (False, ["Cryptography"])),
        (["F", *FIELDS["Theory"], "F"], (True, FIELDS["Theory"])),
        (["Cryptography", "Cryptography", "F", "F"], (False, [])),
    ],
)
def test_fold_cases(spark, kinds, expected):
    events = [("s", i, "field" if k == "F" else "sub", "Theory", None if k == "F" else k)
              for i, k in enumerate(kinds)]
    found = folded(state.fold_selection(spark.createDataFrame(events, schemas.TOGGLE_EVENTS)))
    assert found == {("s", "Theory"): (expected[0], sorted(expected[1]))}


def test_fold_equals_replay_with_a_hot_session(spark):
    events = presses(1, 6000, ["hot"] * 6 + ["a", "b", "c"])
    df = spark.createDataFrame(events, schemas.TOGGLE_EVENTS)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = folded(state.fold_selection(df))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == replay(events)


def test_fold_ignores_unlisted_names(spark):
    events = [("s", 1, "sub", "AI", "Nothing"), ("s", 2, "field", "Nowhere", None), ("s", 3, "sub", "AI", "Computer vision")]
    found = folded(state.fold_selection(spark.createDataFrame(events, schemas.TOGGLE_EVENTS)))
    assert found == {("s", "AI"): (False, ["Computer vision"])}


@pytest.mark.parametrize("seed", [3, 4])
def test_state_as_toggles_round_trip(spark, seed):
    events = presses(seed, 400, ["a", "b", "c", "d"], tuple(FIELDS))
    once = positions.stored(state.fold_selection(spark.createDataFrame(events, schemas.TOGGLE_EVENTS)))
    again = state.fold_selection(state.as_toggles(once))
    kept = {k: v for k, v in folded(once).items() if v != (False, [])}
    assert folded(again) == kept


def test_positions_of_a_hot_group(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.7 else f"k{i % 40}", rng.randint(0, 5), i) for i in range(4000)]
    rows += [(None, 1, 10_000), (None, 2, 10_001)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "k string, v int, id bigint")
        placed = positions.with_positions(df, ["k"], [F.desc("v"), F.col("id")]).collect()
        slices = positions.sorted_slices(df, ["k"], [F.desc("v"), F.col("id")])
        n_hot = slices.where("k = 'hot'").select("_slice").distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert n_hot > 1
    expected = {}
    for key in {r[0] for r in rows}:
        ordered = sorted((r for r in rows if r[0] == key), key=lambda r: (-r[1], r[2]))
        expected.update({r[2]: i for i, r in enumerate(ordered, start=1)})
    assert {r["id"]: r["pos"] for r in placed} == expected and len(placed) == len(rows)


@pytest.mark.parametrize("presses_", [1, 2, 3])
def test_toggle(spark, presses_):
    df = spark.createDataFrame([("u", "l")] * presses_, schemas.BOOKMARKS)
    assert (bookmarks.toggle_state(df).count() == 1) == (presses_ % 2 == 1)


def test_apply_changes(spark):
    make = lambda rows: spark.createDataFrame(rows, schemas.BOOKMARKS)
    found = bookmarks.apply_changes(
        make([("u", "1"), ("u", "1"), ("u", "2"), ("v", "1")]),
        inserts=make([("u", "3"), ("u", "2"), ("u", "3")]),
        deletes=make([("u", "1"), ("u", "2"), ("w", "9")]))
    assert sorted(tuples(found)) == [("u", "2"), ("u", "3"), ("v", "1")]


def test_bookmarked_labs_of_one_user(spark):
    marks = spark.createDataFrame(
        [("u", "p1"), ("u", "p1"), ("u", "p5"), ("u", "zz"), ("v", "p3")], schemas.BOOKMARKS)
    labs, unis = fixtures.labs(spark), fixtures.universities(spark)
    assert [r["lab_id"] for r in bookmarks.bookmarked_labs(marks, labs, unis, "u").collect()] == ["p1"]
    assert bookmarks.bookmarked_labs(marks, labs, unis).count() == 2


def test_key_lists_pages_hold_every_id(spark):
    marks = spark.createDataFrame([("u", f"{i:04d}") for i in range(1005)], schemas.BOOKMARKS)
    pages = sorted(bookmarks.bookmark_key_lists(marks, page_size=100).collect(), key=lambda r: r["page"])
    ids = [i for p in pages for i in p["lab_ids"].split(", ")]
    assert ids == [f"{i:04d}" for i in range(1005)] and max(p["n"] for p in pages) == 100


def test_latest(spark):
    rows = [("a", 1, 1, "x"), ("a", 2, 1, "y"), ("a", 2, 2, None), ("b", 1, 1, "z")]
    df = spark.createDataFrame(rows, "k string, ts int, seq int, v string")
    found = state.latest(df, ["k"], ["ts", "seq"])
    assert sorted(tuples(found)) == [("a", 2, 2, None), ("b", 1, 1, "z")]


def test_recommend_skips_long_runs_of_bookmarks(spark):
    """A user who holds most of the top of the list still gets the best five of the rest."""
    rng = random.Random(8)
    rows = [(f"p{i:03d}", "u1", rng.randint(0, 6), 1, rng.sample([*range(1, 28), 55, 99], rng.randint(0, 3)))
            for i in range(120)]
    labs = fixtures.labs(spark, rows)
    held = {"few": {"p001", "p002"}, "many": {r[0] for r in rows if rng.random() < 0.9},
            "all": {r[0] for r in rows}, "odd": {"nowhere"}}
    marks = spark.createDataFrame([(u, l) for u, s in held.items() for l in s], schemas.BOOKMARKS)
    area = lambda ids: {r[3] for r in taxonomy_rows() if r[4] in ids}
    expected = set()
    for user, mine in held.items():
        interest = set().union(*[area(r[4]) for r in rows if r[0] in mine])
        scored = [(-len(area(r[4]) & interest), -r[2], r[0]) for r in rows
                  if r[0] not in mine and area(r[4]) & interest]
        for place, (score, _, lab) in enumerate(sorted(scored)[:5], start=1):
            expected.add((user, lab, -score, place))
    assert set(tuples(search.recommend(labs, marks, 5))) == expected and len(expected) >= 10


def test_recommend_reaches_every_sub_field(spark):
    """26 and 27 are in the interdisciplinary field though in no area; 55 is in the last field."""
    rows = [("p1", "u1", 9, 1, [26]), ("p2", "u1", 5, 1, [27]), ("p3", "u1", 7, 1, [55]), ("p4", "u1", 1, 1, [55, 26]), ("p5", "u1", 8, 1, [1])]
    marks = spark.createDataFrame([("a", "p1"), ("b", "p3")], schemas.BOOKMARKS)
    found = sorted(tuples(search.recommend(fixtures.labs(spark, rows), marks, 5)))
    assert found == [("a", "p2", 1, 1), ("a", "p4", 1, 2), ("b", "p4", 1, 1)]
