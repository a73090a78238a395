from __future__ import annotations

import math
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from scholarmill import session
from scholarmill.llm import lm, queries
from tests.conftest import CHECK

SPACE = dict.fromkeys(map(ord, "\t\n\v\f\r"), " ")


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in low.translate(SPACE).split(" ") if w] + [None]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def brute(rows):
    """(doc_id, held_out, n_tokens, n_known, train_tokens) -> [base_score]"""
    counts = Counter(t for d, text in rows if not held(d) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, text in rows:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)
        out.append((d, held(d), len(own), sum(counts[t] > 0 for t in own), n, base))
    return out


def same(found, expected):
    key = lambda r: (repr(r[0]), r[2], r[3], round(r[5], 4))
    found, expected = sorted(found, key=key), sorted(expected, key=key)
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    assert [r[5] for r in found] == pytest.approx([r[5] for r in expected], rel=1e-12, abs=1e-9)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{CHECK}/documents.parquet").collect()]
    found = [tuple(r) for r in queries.op8_lm_score(spark, CHECK).collect()]
    same([r[:6] for r in found], brute(rows))
    gain = sum(r[6] - r[5] for r in found if r[1]) / sum(r[2] for r in found if r[1])
    assert gain > 0.02  # over held-out texts, a token


def plain_score(automaton, words):
    """By the definition: longest context with an arc, weights of the failure arcs on the way."""
    score, history = 0.0, [lm.START]
    for w in [*words, lm.END]:
        for i in range(len(history) + 1):
            state = automaton.states.get(tuple(history[i:]))
            if state is None:
                continue
            score += math.log10(automaton.probability(state, w))
            break
        history = [*history, w][-2:]
    return score


def test_walk_and_sums():
    rng = random.Random(5)
    ids = {bytes([97 + i]): i + 2 for i in range(6)}
    texts = [rng.choices(list(ids), range(1, 7), k=rng.randint(0, 30)) for _ in range(200)]
    lines = [[lm.START, *(ids[w] for w in t), lm.END] for t in texts]
    grams = {n: Counter(tuple(x[i : i + n]) for x in lines for i in range(len(x) - n + 1)) for n in (1, 2, 3)}
    counts = [grams[1][(i,)] for i in range(8)]
    a = lm.Automaton(ids, counts, sum(counts) - counts[lm.START], 7)
    for n in (1, 2):
        for context in sorted(c for c in grams[n] if lm.END not in c and (n == 1 or grams[2][c] > 40)):
            a.add(context, grams[n][context], {g[-1]: c for g, c in grams[n + 1].items() if g[:-1] == context and c > 3})
    a.finish()
    words = [lm.END, *ids.values()]
    unknown = 1 / a.denominator
    for state in range(len(a.names)):
        rest = unknown * 10 ** a.to_root[state]
        assert sum(a.probability(state, w) for w in words) + rest == pytest.approx(1)
    for t in texts:
        numbers = [ids[w] for w in t]
        base = sum(math.log10(a.unigram[i]) for i in [*numbers, lm.END])
        assert base + a.gain(t) == pytest.approx(plain_score(a, numbers))


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_BYTES", 40)
    rows = [(i, t) for i, t in enumerate(["a b A", "", None, "c\td\n\ne", "É é", "a a a a", "x" * 3000, "\x1c \x85z", "b a"] * 3)]
    rows += [(None, "a b"), (3, "a b"), (3, "a b"), (9, "only here é")]
    docs = spark.createDataFrame([(*r, 1.0, "w") for r in rows], "doc_id long, text string, score double, words string")
    found = [tuple(r) for r in lm.score_documents(docs).collect()]
    same([r[:6] for r in found], brute(rows))
    assert lm.score_documents(docs.limit(0)).count() == 0
    alone = [r[0] for r in rows if r[0] is not None and held(r[0])]
    left = docs.where(docs.doc_id.isin(alone))
    only = lm.score_documents(left).collect()
    assert only and all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in only)


def whole(rows):
    """The automaton of all n-grams of at least LEAST occurrences, built in one place."""
    train = [tokens(t)[:-1] for d, t in rows if not held(d)]
    ids = {w.encode(): i + 2 for i, w in enumerate(sorted({w for t in train for w in t}))}
    lines = [[lm.START, *(ids[w.encode()] for w in t), lm.END] for t in train]
    grams = {n: Counter(tuple(x[i : i + n]) for x in lines for i in range(len(x) - n + 1)) for n in (1, 2, 3)}
    counts = [grams[1][i,] for i in range(len(ids) + 2)]
    a = lm.Automaton(ids, counts, sum(counts) - counts[lm.START], len(ids) + 1)
    for n in (1, 2):
        followers = {}
        for g, c in grams[n + 1].items():
            if c >= lm.LEAST:
                followers.setdefault(g[:-1], {})[g[-1]] = c
        for context in sorted(c for c in grams[n] if lm.END not in c and (n == 1 or grams[n][c] >= lm.LEAST)):
            a.add(context, grams[n][context], followers.get(context, {}))
    a.finish()
    return a


@pytest.mark.parametrize("hot", [1 << 15, 3])
def test_model_has_every_repeated_ngram(spark, monkeypatch, hot):
    monkeypatch.setattr(lm, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(lm, "HOT", hot)
    rng = random.Random(3)
    words = [a + b for a in "bdfgklmnpr" for b in "aeiou"]
    rows = [(i, " ".join(rng.choices(words, [1 / (j + 1) for j in range(50)], k=rng.randint(0, 60)))) for i in range(300)]
    # Rare beside the rest: no share of the tokens, but twice in the training documents.
    rows += [(1000 + i, f"{'ka ' * 2000}quartz vixen jumps") for i in range(20)]
    rows += [(2000 + i, "quartz vixen jumps unseen ka ba") for i in range(20)]
    a = whole(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r for r in lm.score_documents(docs).collect()}
    for d, text in rows:
        gain = found[d].score - found[d].base_score
        assert gain == pytest.approx(a.gain([w.encode() for w in tokens(text)[:-1]]), abs=1e-7)
    assert any(r.held_out for r in found.values())


def test_rare_pair_is_an_arc(spark):
    """Two occurrences among 400,000 tokens: a share of the tokens would leave them out."""
    ids = [d for d in range(400) if not held(d)]
    rows = [(d, "ka " * 1200) for d in ids] + [(5000, "quartz vixen"), (5001, "quartz vixen")]
    rows = [(d + (5 if held(d) else 0), t) for d, t in rows]
    tested = next(d for d in range(6000, 7000) if held(d))
    docs = spark.createDataFrame([*rows, (tested, "quartz vixen")], "doc_id long, text string")
    found = lm.score_documents(docs).where(f"doc_id = {tested}").first()
    assert found.score - found.base_score > 3


def test_tables_of_the_orders_before_are_gone(spark, tmp_path, monkeypatch):
    """What is left in the store for the scores is small, as is what was written on the way."""
    rng = random.Random(7)
    words = [a + b + c for a in "bdfgklmnpr" for b in "aeiou" for c in "bdfgklmnpr"]
    rows = [(i, " ".join(rng.choices(words, [1 / (j + 1) for j in range(500)], k=400))) for i in range(1500)]
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    left = sum(p.stat().st_size for p in Path(tmp_path).rglob("*.parquet"))
    assert len(list(Path(tmp_path).glob("stored-*"))) == 2  # the chunks, and the answers of the last order
    assert left < 2.2 * sum(len(t) for _, t in rows)


def test_packed_numbers_and_words():
    arrays = [np.array(a) for a in ([], [3, 255], [-1, 1 << 40], [1 << 62, -(1 << 62)], [0.1, -2.5], [70000])]
    for a, b in zip(arrays, lm._unpack(lm._pack(*arrays)), strict=True):
        assert a.tolist() == b.tolist()
    texts = ["q", "c\td\n\ne", "", " \x1c \x85Z ", "É é", "\v\f\r", "A B"]
    for start in range(3):
        found, sizes = lm._split(pa.array(texts).slice(start))
        own = [lm.words_of(t) for t in texts[start:]]
        assert found.to_pylist() == [w for o in own for w in o] and sizes.tolist() == [len(o) for o in own]
