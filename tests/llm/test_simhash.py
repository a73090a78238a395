from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from scholarmill.llm import queries, simhash
from tests.conftest import SMALL


def plain(text: str) -> int:
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
             .replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ")
             .split(" ") if w]
    if not words:
        return 0
    grams = [words[i : i + 4] for i in range(len(words) - 3)] or [words]
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows: list[tuple]) -> list[tuple]:
    """(doc_id, fingerprint, component_id) by comparing all pairs."""
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 4:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return [(doc, f"{fp:016x}", least.get(root(i))) for i, (doc, fp) in enumerate(rows)]


def ordered(rows):
    return sorted(rows, key=repr)


def test_fingerprint_of_odd_texts(monkeypatch):
    texts = ["", " \t\n", "one", "One two THREE", "a b c d", "a b c d e É é\x0b f\x0cg\rh", "x " * 50, "Ünï " * 9, "\x1ca b c\x85d e"]
    assert [simhash.simhash(t) for t in texts] == [plain(t) for t in texts]
    long = " ".join(random.Random(3).choice("abcdefghij") * n for n in range(1, 400))
    monkeypatch.setattr(simhash, "CHUNK", 37)
    assert simhash.simhash(long) == plain(long)


def test_hash_is_that_of_spark(spark):
    text = "ab cd ef gé"
    (found,) = spark.range(1).select(F.xxhash64(F.lit(text))).first()
    assert simhash.simhash(text) == found % (1 << 64)


@pytest.mark.parametrize("variants", [1 << 22, 1 << 12])
def test_links_as_by_all_pairs(spark, monkeypatch, variants):
    rng = random.Random(variants)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for fp in list(fps)[:30]:  # chains and dense balls
        for _ in range(rng.randint(1, 25)):
            for b in rng.sample(range(64), rng.randint(1, 5)):
                fp ^= 1 << b
            fps.add(fp)
    fps = np.array(sorted(fps), np.uint64)
    monkeypatch.setattr(simhash, "VARIANTS", variants)
    bucket = [(int(fp) >> 52) ^ int(m) for fp in fps for m in simhash._masks(12, 2)]
    order = np.argsort(bucket, kind="stable")
    import pyarrow as pa

    batch = pa.record_batch([pa.array(np.repeat(fps, 79)[order].view(np.int64)), pa.array(np.array(bucket)[order])], names=["fp", "bucket"])
    edges = [e for out in simhash._match(12, 2)(iter([batch])) for e in zip(*(c.to_numpy().view(np.uint64) for c in out.columns))]
    rows = [(i, int(fp)) for i, fp in enumerate(fps)]
    place = {fp: i for i, fp in rows}
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = root(place[int(a)]), root(place[int(b)])
        parent[max(x, y)] = min(x, y)
    assert [(i, f"{fp:016x}", root(i)) for i, fp in rows] == brute_components(rows)


def test_query_as_by_all_pairs(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    expected = brute_components([(d.doc_id, plain(d.text)) for d in docs])
    found = [tuple(r) for r in queries.op2_simhash(spark, SMALL).collect()]
    assert ordered(found) == ordered(expected)


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(1, text), (2, text), (2, text), (None, text), (4, None), (3, ""), (5, "  "), (None, "alone here"), (6, "other")]
    docs = spark.createDataFrame([(*r, "x", 7) for r in rows], "doc_id long, text string, fp string, component_id long")
    found = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
    assert ordered(found) == ordered(brute_components([(d, plain(t or "")) for d, t in rows]))
    stay = simhash.drop_near_duplicates(docs)
    assert stay.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in stay.collect()]
    assert ordered(kept) == ordered([(1, text), (3, ""), (None, "alone here"), (6, "other")])
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
