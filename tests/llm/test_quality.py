from __future__ import annotations

import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from scholarmill.llm import quality, queries
from tests.conftest import CHECK


def test_query_on_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{CHECK}/labels.parquet").collect()}
    rows = queries.op3_quality(spark, CHECK).collect()
    assert len(rows) == spark.read.parquet(f"{CHECK}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(r.score, labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([y == p for _, y, p in held]) > 0.97
    good, bad = ([s for s, y, _ in held if y == k] for k in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.99


def test_words_in_pieces(monkeypatch):
    rng = random.Random(1)
    text = " ".join(rng.choice(["ab", "ab", "c!", "é", "12", "XY&&", "the"]) for _ in range(500)) + "   "
    whole = quality.features(text)
    monkeypatch.setattr(quality, "CHUNK", 11)
    assert all((a == b).all() for a, b in zip(whole, quality.features(text)))
    assert len(quality.features("")[0]) == len(quality.features(" \n ")[0]) == 0
    assert (quality._hash_words(np.frombuffer(b"abc abc ab", np.uint8))[[0, 0]] == quality._hash_words(np.frombuffer(b"abc abc", np.uint8))).all()


def test_odd_rows(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(["good", "fine", "text"] if i % 2 else ["bad!!", "junk##"], k=9)), None, i) for i in range(200)]
    rows += [(None, "good text", "a", 0), (7, None, "b", 1), (7, "", "c", 1), (900, "x" * 400_000, "d", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string, quality int")
    labels = [(i, i % 2, 0) for i in range(200)] + [(None, 1, 0), (5, None, 0), (6, 3, 0), (4, 0, 1), (4, 0, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, text int")
    found = quality.classify(docs, labels).collect()
    assert len(found) == len(rows)
    assert all(r.predicted == r.doc_id % 2 for r in found if r.doc_id is not None and r.doc_id not in (7, 900))
    kept = quality.drop_rejected(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= set(range(1, 200, 2)) - {7}
    assert not {r.doc_id for r in kept.collect()} & set(range(0, 200, 2))
    none = quality.classify(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.classify(docs.limit(0), labels).count() == 0
    few = quality.fit(docs, labels, sample=10)
    assert 0 < few.count() <= quality.DIMENSIONS + 1


def plain_features(text: str) -> dict[int, float]:
    """Runs of letters, digits or other marks, one by one, hashed byte by byte; words and pairs of words."""
    mask = (1 << 64) - 1
    kinds = {**dict.fromkeys(b"\t\n\v\f\r ", 0), **dict.fromkeys(b"0123456789", 2)}

    def kind(b):
        return 1 if b >= 128 or chr(b).isalpha() else kinds.get(b, 3)

    runs = []
    for b in text.encode():
        if runs and runs[-1][0] == kind(b):
            runs[-1][1].append(b)
        else:
            runs.append((kind(b), [b]))
    words = []
    for _, run in (r for r in runs if r[0]):
        total, power = 0, 1
        for b in run:
            power = power * 0x100000001B3 & mask
            total = total + (b + 1) * power & mask
        words.append((total ^ total >> 29) * 0x9E3779B97F4A7C15 & mask)
    places = [w >> 46 for w in words]
    places += [((a * 3 + b & mask) * 0x9E3779B97F4A7C15 & mask) >> 46 for a, b in zip(words, words[1:])]
    places += [0] * sum(a == b for a, b in zip(words, words[1:])) + [1] * sum(a == b for a, b in zip(words, words[2:]))
    counts = {p: math.log1p(places.count(p)) for p in set(places)}
    size = math.sqrt(sum(v * v for v in counts.values())) or 1.0
    return {p: float(np.float32(v / size)) for p, v in counts.items()}


def test_fitted_as_by_a_dictionary(spark):
    """Follow-the-regularised-leader over dictionaries, one coordinate at a time, in the same order."""
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "né", "12", "!!", "good", "good"][: 7 - 2 * (i % 2)]) for _ in range(rng.randint(0, 14)))) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows if i % 7], "doc_id long, quality int")
    found = {r["index"]: r.weight for r in quality.fit(docs, labels).collect()}
    texts, bias = dict(rows), quality.DIMENSIONS
    order = [r for r in labels.orderBy(F.xxhash64("doc_id"), "doc_id").collect() if zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        l1 = 0.0 if i == bias else quality.L1
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    for _ in range(quality.EPOCHS):
        for r in order:
            x = {**plain_features(texts[r.doc_id]), bias: 1.0}
            w = {i: weight(i) for i in x}
            error = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items()))) - r.quality
            for i, v in x.items():
                g = error * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA * w[i]
                n[i] += g * g
    plain = {i: weight(i) for i in z if weight(i)}
    assert found.keys() == plain.keys() and all(math.isclose(found[i], plain[i], rel_tol=1e-6, abs_tol=1e-9) for i in plain)
    for r in quality.classify(docs, labels).collect():
        total = sum(plain.get(i, 0.0) * v for i, v in plain_features(texts[r.doc_id]).items()) + plain.get(bias, 0.0)
        assert math.isclose(r.score, 1 / (1 + math.exp(-total)), rel_tol=1e-4)


def test_vectors_of_few_texts_are_held_at_once():
    """An executor holds workers of other stages too; a batch of ten thousand long texts must not add all its vectors."""
    texts = [f"some words {i} and {i % 7} more" for i in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000)), pa.array([0, 1] * 500), pa.array(texts)], names=["doc_id", "label", "text"])
    parts = list(quality._vectors([batch]))
    assert max(p.num_rows for p in parts) <= 256
    rows = [r for p in parts for r in p.to_pylist()]
    assert [r["doc_id"] for r in rows] == list(range(1000))
    for r, text in zip(rows, texts):
        index, values = quality.features(text)
        assert r["index"] == index.tolist() and np.allclose(r["values"], values)
