from __future__ import annotations

import bisect
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from scholarmill.llm import packing, queries
from tests.conftest import SMALL

FILE = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "a~b ~", "x\x1cy\x1d", "It's 12 o'clock... ok,. A.b", "ÉÈ, ß. ſ K İi ǅ", "é ́x", "wor" * 40 + ".", "<|endoftext|> hi",
       "a b c\u0085d", "日本語 テスト。", "ª. º, µ. Σς ΣΣ.", "​ ﻿.", "9,9. ½."]
ODD += ["ab### CD!! é&&& x's' y'll. z''' q'T, ___ a_b_ a__ ab#.,% ab#.,%% ~a~ a~~", "~ | ` a` ^b b^ µ! ß?"]


def reference(texts):
    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    return [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


def test_ids_are_the_tokenizers(spark):
    texts = ODD + [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    coder = packing.Coder(FILE)
    for _ in range(2):
        found = [np.frombuffer(b, "<u4").tolist() for b in coder.encode(texts)]
        assert found == reference(texts)


def test_long_texts_in_segments(monkeypatch):
    monkeypatch.setattr(packing, "BATCH_CHARS", 9)
    texts = [*ODD, "one two, three. four five six seven", "no" * 30, "a " * 40]
    assert [np.frombuffer(b, "<u4").tolist() for b in packing._coded(packing.Coder(FILE), texts)] == reference(texts)


def test_small_cache(monkeypatch):
    monkeypatch.setattr(packing, "_CACHED", 3)
    coder = packing.Coder(FILE)
    texts = ["aa bb cc. dd, ee", "aa ff gg", "hh aa bb cc dd ee ff"]
    assert [np.frombuffer(b, "<u4").tolist() for b in coder.encode(texts[:2])] + [
        np.frombuffer(b, "<u4").tolist() for b in coder.encode(texts[2:])
    ] == reference(texts)


def place(counts, capacity=2048, groups=packing.GROUPS):
    """sequence -> [(offset, length)] of all pieces, with every rank checked to be placed once."""
    seen, sequences = defaultdict(list), defaultdict(list)
    for length, rank, many, first, offset in packing.plan(counts, capacity, groups).tolist():
        seen[length].extend(range(rank, rank + many))
        for s in range(first, first + many):
            sequences[s].append((offset, length))
    assert {n: sorted(r) for n, r in seen.items()} == {n: list(range(1, c + 1)) for n, c in counts.items()}
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(sequences) == list(range(len(sequences)))
    return sequences


@pytest.mark.parametrize("seed", range(6))
def test_plan(seed):
    rng = random.Random(seed)
    draw = [lambda: rng.randint(1, 2048), lambda: min(2048, 1 + int(rng.expovariate(1 / 300))), lambda: 2048,
            lambda: rng.choice([700, 701, 1300, 30]), lambda: rng.randint(1, 40), lambda: rng.randint(1000, 1100)][seed]
    counts = Counter(draw() for _ in range(5000))
    used = len(place(counts))
    room = []  # best fit, one piece after the other, longest first
    for n in sorted(counts.elements(), reverse=True):
        at = bisect.bisect_left(room, n)
        left = room.pop(at) - n if at < len(room) else 2048 - n
        bisect.insort(room, left)
    assert used <= len(room) * 1.005 + 1


def test_plan_of_little():
    assert len(packing.plan({})) == 0
    assert len(place({5: 1})) == 1
    assert len(place({1: 3, 2048: 2})) == 3


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    expected = []
    for d, ids in zip(docs, reference([d.text for d in docs])):
        ids = ids + [0]
        for n, a in enumerate(range(0, len(ids), 2048)):
            cut = np.array(ids[a : a + 2048], "<u4").tobytes()
            expected.append((d.doc_id, n, a, len(cut) // 4, zlib.crc32(cut)))
    rows = queries.op10_packing(spark, SMALL).collect()
    assert sorted(tuple(r)[:5] for r in rows) == sorted(expected)
    used = defaultdict(list)
    for r in rows:
        used[r.sequence_id].append((r.offset, r.length))
    for s in used.values():
        s.sort()
        assert [o for o, _ in s] == [sum(n for _, n in s[:i]) for i in range(len(s))]
        assert sum(n for _, n in s) <= 2048
    assert len(used) <= -(-sum(r.length for r in rows) // 2048) * 1.02 + 1


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 3), (1, None, 4), (None, "a b", 5), (2, "", 6), (2, "x " * 9000, 7)], "doc_id long, text string, length int"
    )
    rows = packing.pack_documents(docs, FILE).collect()
    assert sorted((r.doc_id or 0, r.piece, r.length) for r in rows) == [
        (0, 0, 3), (1, 0, 1), (1, 0, 1), (2, 0, 1), (2, 0, 2048), (2, 1, 2048), (2, 2, 2048), (2, 3, 2048), (2, 4, 809)]
    assert packing.pack_documents(docs.limit(0), FILE).count() == 0
    with_ids = packing.pieces(docs, FILE, 100, with_ids=True).collect()
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in with_ids)


def test_words_are_not_looked_at_one_by_one():
    """A million occurrences of a few words cost no Python step each; odd words and spaces keep their ids."""
    coder = packing.Coder(FILE)
    looked = []
    coder._whole, coder._letters = (lambda f: lambda x: looked.extend([x] if isinstance(x, str) else x) or f(x))(coder._whole), (
        lambda f: lambda x: looked.extend(x) or list(f(x)))(coder._letters)
    texts = ["Word, word! ÀÉ été 日本 x1 WORD " * 40_000, "", "   ", "a\x1fb c", "w" * 300, "Straße.\xa0ﬁ İ ſ 𐐀 é"]
    found = [np.frombuffer(b, "<u4").tolist() for b in coder.encode(texts)]
    assert len(looked) < 30
    assert found == [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert max(map(len, [*coder.others.young, *coder.bases.young])) <= 64
