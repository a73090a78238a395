from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from scholarmill.llm import exact, neartext, queries
from tests.conftest import CHECK


def shingles(text: str) -> set[str]:
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(len(words) - 4)} or {b" ".join(words)}


def near_pairs(rows: list[tuple]) -> set[tuple]:
    """Pairs (smaller, larger doc_id) of texts with a Jaccard similarity of 0.8, by an index of shingles."""
    sets, index, shared = {d: shingles(t) for d, t in rows}, defaultdict(list), defaultdict(int)
    for d, s in sets.items():
        for gram in s:
            for other in index[gram]:
                shared[min(d, other), max(d, other)] += 1
            index[gram].append(d)
    return {(a, b) for (a, b), n in shared.items() if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n)}


def test_hashes_and_fingerprints():
    for text in ("", " \n", "one", "a b c d e f g A B C D E F G", "x " * 40, "é É ü " * 30):
        hashes = neartext.shingle_hashes(text)
        assert hashes.tolist() == sorted(xxhash.xxh64_intdigest(g, 42) for g in shingles(text))
    hashes = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 40_000).astype(np.uint64))
    ones = np.zeros(neartext.BANDS * neartext.BITS, int)
    for h in hashes[:300]:
        ones += np.array([int(x) >> (63 - i) & 1 for x in neartext._mixed(h[None])[:, 0].byteswap() for i in range(64)])
    bits = "".join(f"{int(x):064b}" for x in neartext.wide_fingerprint(hashes[:300]))
    assert bits == "".join("1" if 2 * n > 300 else "0" for n in ones)
    whole = neartext.wide_fingerprint(hashes)  # more hashes than are unpacked at once
    assert 0.4 < np.bitwise_count(whole).sum() / (neartext.BANDS * neartext.BITS) < 0.6


def edited(pick, words, share):
    return [pick.choice(["new", "other", "word"]) + str(pick.randint(0, 999)) if pick.random() < share else w for w in words]


@pytest.mark.parametrize("variants", [1 << 21, 1 << 12])
def test_groups_of_edited_texts(spark, monkeypatch, variants):
    """Recall over pairs from 0.8 to 1, a group of hundreds of near copies, and no link below."""
    monkeypatch.setattr(neartext, "VARIANTS", variants)
    pick, rows = random.Random(2), []
    for group in range(60):
        base = [f"g{group}w{pick.randint(0, 400)}" for _ in range(pick.randint(60, 400))]
        for _ in range(4):
            rows.append((len(rows), " ".join(edited(pick, base, pick.choice([0.005, 0.01, 0.02, 0.04])))))
    hot = [f"hot{pick.randint(0, 500)}" for _ in range(300)]
    rows += [(1000 + i, " ".join(edited(pick, hot, 0.003))) for i in range(250)]
    pairs = near_pairs(rows)
    found = {r.doc_id: r.component_id for r in neartext.near_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert len(found) == len(rows)
    assert sum(found[a] == found[b] for a, b in pairs) >= 0.95 * len(pairs)
    parent = {d: d for d, _ in rows}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a, b in pairs:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    assert all(root(d) == root(c) for d, c in found.items())  # every group is connected by pairs over 0.8


def test_few_pairs_of_a_large_group(spark, monkeypatch):
    """Members of a group share hundreds of variants; what meets are a few pairs a text, and all are linked."""
    pick, store, pairs = random.Random(4), neartext.stored, []

    def counted(df):
        out = store(df)
        if sorted(out.columns) == ["a", "b"]:
            pairs.append(out.count())
        return out

    monkeypatch.setattr(neartext, "stored", counted)
    hot = [f"hot{pick.randint(0, 500)}" for _ in range(300)]
    rows = [(i, " ".join(edited(pick, hot, 0.01))) for i in range(400)]
    found = neartext.near_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sum(r.component_id == 0 for r in found) > 380
    assert max(pairs) < 10 * len(rows)  # 49 a text when all bands meet at once


def test_recall_on_the_documents(spark):
    kept = exact.drop_exact_duplicates(queries.table(spark, CHECK, "documents"))
    rows = [(r.doc_id, r.text) for r in kept.select("doc_id", "text").collect()]
    pairs = near_pairs(rows)
    found = {r.doc_id: r.component_id for r in neartext.near_texts(kept).collect()}
    assert pairs and sum(found[a] == found[b] for a, b in pairs) >= 0.9 * len(pairs)
    linked = {d for p in pairs for d in p}
    assert all(c == d or d in linked for d, c in found.items())


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(1, text), (2, text), (2, text), (None, text), (4, None), (3, ""), (5, "  "), (None, "alone here"), (6, "other"),
            (7, text + " end"), (8, "long " * 400_000), (9, "LONG " * 400_001)]
    docs = spark.createDataFrame([(*r, "x", 7, 8) for r in rows], "doc_id long, text string, fps string, n long, SHA long")
    found = sorted({(r.doc_id, r.component_id) for r in neartext.near_texts(docs).collect()}, key=repr)
    assert found == sorted([(1, 1), (2, 1), (None, 1), (4, 3), (3, 3), (5, 3), (None, None), (6, 6), (7, 1), (8, 8), (9, 8)], key=repr)
    stay = neartext.drop_near_texts(docs)
    assert stay.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in stay.collect()) == sorted(
        [(1, text), (3, ""), (0, "alone here"), (6, "other"), (8, "long " * 400_000)])
    assert neartext.near_texts(docs.limit(0)).count() == 0 and neartext.drop_near_texts(docs.limit(0)).count() == 0
