from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest

from scholarmill.llm import exact, queries
from tests.compare import assert_same, connect
from tests.conftest import SMALL


def brute(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[text or ""].append(doc)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        kept = 0
        for i in ids:
            first = i == keep and not kept
            kept += first
            out.append((i, keep, len(ids), first, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_query_same_as_sql(spark):
    assert assert_same(queries.op1_exact_dedup(spark, SMALL), connect(SMALL), queries.ORACLE["op1_exact_dedup"]) > 0


@pytest.mark.parametrize("block", [1, 3, 8192])
def test_odd_rows(spark, block):
    texts = ["", None, "a", "ab", "abc", "abcdefghij" * 3, "abcdefghij" * 3, "abcdefghij" * 3 + "k", "é", "éé", "abc"]
    rows = [*enumerate(texts), (4, "abc"), (4, "abc"), (4, "other"), (None, "abc"), (None, "x"), (None, "x")]
    docs = spark.createDataFrame([(*r, "q", 1) for r in rows], "doc_id long, text string, name string, level int")
    found = exact.exact_duplicates(docs, block).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(rows)


def test_rows_that_stay(spark):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, ""), (None, "z"), (None, "z"), (2, "b")]
    docs = spark.createDataFrame([(*r, "q", 1) for r in rows], "doc_id long, text string, sha string, copies int")
    stay = exact.drop_exact_duplicates(docs)
    assert stay.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in stay.collect()), key=repr) == sorted(
        [(2, "a"), (4, ""), (None, "z"), (2, "b")], key=repr)
    assert exact.exact_duplicates(docs.limit(0)).count() == 0
