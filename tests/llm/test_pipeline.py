from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np

import __spark_entry__ as entry_points
import corpus_pipeline
from scholarmill.llm import pii, queries
from tests.conftest import CHECK
from tests.llm.test_packing import reference
from tests.llm.test_pii import plain as spans_of
from tests.llm.test_neartext import near_pairs


def test_stages_one_by_one(spark, tmp_path):
    docs = queries.table(spark, CHECK, "documents")
    columns, kept = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, CHECK).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        kept[name] = docs.collect()
        assert i == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    before = {r.doc_id: r for r in queries.table(spark, CHECK, "documents").collect()}

    predicted = {r.doc_id for r in queries.op3_quality(spark, CHECK).collect() if r.predicted}
    rows = kept["quality_classifier"]
    assert {r.doc_id for r in rows} == predicted and all(r == before[r.doc_id] for r in rows)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{CHECK}/labels.parquet").collect()}
    clean = {d for d, q in labels.items() if q == 1}
    assert len(clean & predicted) > 0.99 * len(clean)

    largest = {}
    for r in rows:
        largest[r.text] = max(r.doc_id, largest.get(r.text, -1))
    rows = kept["exact_dedup"]
    assert sorted(r.doc_id for r in rows) == sorted(largest.values()) and all(r == before[r.doc_id] for r in rows)

    pairs = near_pairs([(r.doc_id, r.text) for r in rows])
    gone = {r.doc_id for r in rows} - {r.doc_id for r in kept["simhash_near_dedup"]}
    near = {d for pair in pairs for d in pair}
    assert pairs and gone <= near  # whatever goes is near another text
    left = {r.doc_id for r in kept["simhash_near_dedup"]}
    assert sum(not {a, b} <= left for a, b in pairs) >= 0.9 * len(pairs)
    rows = kept["simhash_near_dedup"]
    assert all(r == before[r.doc_id] for r in rows)

    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find(spark.createDataFrame(rows)).collect()}
    after = {r.doc_id: r for r in kept["pii"]}
    assert after.keys() == {r.doc_id for r in rows}
    for r in rows:
        new = after[r.doc_id]
        assert new.text == pii.clean(r.text, spans[r.doc_id]) and new.n_chars == len(new.text)
        assert [s for s in spans[r.doc_id] if s[0] in pii.BASE] == spans_of(r.text)
        assert spans[r.doc_id] or new == r

    expected, used = [], defaultdict(int)
    for r, ids in zip(kept["pii"], reference([r.text for r in kept["pii"]])):
        ids = [*ids, 0]
        for n, a in enumerate(range(0, len(ids), 2048)):
            cut = np.array(ids[a : a + 2048], "<u4").tobytes()
            expected.append((r.doc_id, n, a, len(cut) // 4, zlib.crc32(cut)))
    rows = kept["best_fit_packing"]
    assert sorted(tuple(r)[:5] for r in rows) == sorted(expected)
    for r in rows:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048 and len(used) <= sum(used.values()) / 2048 * 1.02 + 1

    whole = entry_points.queries()["pipeline"](spark, CHECK)
    assert sorted(tuple(r)[:5] for r in whole.collect()) == sorted(expected)


def test_stages_on_odd_rows(spark, tmp_path):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text), (2, text), (2, text), (None, text + " x"), (None, None), (4, ""), (4, None), (5, "mail a.b@c.de"), (6, "tail " * 5000)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _key string, _id long, sha binary, copies int, fp long, spans int, _llm_key string, _llm_id long, _LLM_SHA binary, own_id long, Text_Sha string, new_text int"
    docs = spark.createDataFrame([(*r, None, "s", None, "k", 0, None, 1, 2, 3, "l", 4, b"5", 6, "7", 8) for r in rows], schema)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = docs.columns
        stage(spark, docs, CHECK).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        assert docs.columns == before
        assert stage(spark, docs.limit(0), CHECK).count() == 0
    found = {(r.doc_id, r.text) for r in docs.collect()}
    assert (5, "mail [EMAIL]") in found and (2, text) in found and (1, text) not in found
    assert {r._key for r in docs.collect()} == {"k"} and {r.fp for r in docs.collect()} == {2}
    assert {(r._llm_key, r._llm_id, r._LLM_SHA, r.own_id, r.Text_Sha, r.new_text) for r in docs.collect()} == {
        ("l", 4, b"5", 6, "7", 8)}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, CHECK)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), CHECK).count() == 0
