from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from scholarmill.llm import pii, queries
from tests.conftest import CHECK

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(digits[::-1]):
        total += sum(map(int, str(int(d) * 2))) if i % 2 else int(d)
    return total % 10 == 0


def plain(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.BASE.index(s[0])))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab1.@+- ()%é_59\n", max_size=60))
def test_spans_of_odd_texts(text):
    assert pii.base_spans(text) == plain(text)


def test_long_runs_end():
    for text in ["a" * 300_000, "1" * 300_000, "a@" * 100_000, "1." * 150_000, "+1 " * 100_000, "a" * 200_000 + "@b"]:
        assert isinstance(pii.base_spans(text), list)


def test_query(spark):
    expected = {}
    for r in spark.read.parquet(f"{CHECK}/documents.parquet").collect():
        spans = plain(r.text)
        many = [sum(k == s[0] for s in spans) for k in pii.BASE]
        expected[r.doc_id] = (*many, hashlib.sha256(pii.listed(spans).encode()).hexdigest(), spans)
    rows = queries.op5_pii(spark, CHECK).collect()
    assert len(rows) == len(expected) and any(r.n_email for r in rows) and any(r.n_phone for r in rows)
    for r in rows:
        *many, digest, spans = expected[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256] == [*many, digest]
        own = [tuple(s.split(":")) for s in r.spans.split(",") if s]
        assert [(k, int(a), int(b)) for k, a, b in own if k in pii.BASE] == spans
        assert spans or not own


def corpus():
    rng = random.Random(8)
    words = [a + b + c for a in "bdfgkl" for b in "aeiou" for c in "mnrst"]
    texts = []
    for i in range(300):
        t = rng.choices(words, k=40)
        if i % 20 == 0:
            t[20] = "jo.doe@x.org"
            t[18] = "Jonathan"  # only ever near the address
            if i % 40 == 0:
                t[23] = "treasurer"
        elif i % 10 == 1:
            t[30] = "treasurer"  # elsewhere as well
        if i % 25 == 3:
            t[5] = "10.0.0.1"
        texts.append(" ".join(t))
    copied = "once mara wrote from zed@y.org about it"  # copies are no evidence
    return texts + [copied] * 12


def brute(texts):
    """Added spans by counting every pair by hand."""
    n = len(texts)
    df, entity, pair, windows, seen = defaultdict(int), defaultdict(int), defaultdict(int), defaultdict(set), []
    for t in texts:
        spans = pii.base_spans(t)
        words = [(m.start(), m.end()) for m in re.finditer(r"[^\W\d_]+", t)]
        free = [w for w in words if not any(a < w[1] and w[0] < b for _, a, b in spans)]
        for w in {t[a:b].lower() for a, b in words}:
            df[w] += 1
        near = []
        for kind, a, b in spans:
            around = [w for w in words if w[1] <= a][-8:] + [w for w in words if w[0] >= b][:8]
            around = [w for w in around if w in free]
            near += [(t[a:b], t[x:y].lower(), tuple(t[p:q] for p, q in around), x, y) for x, y in around]
        for e in {x[0] for x in near}:
            entity[e] += 1
        first = {}
        for e, w, window, _, _ in near:
            first.setdefault((e, w), window)
        for key, window in first.items():
            pair[key] += 1
            windows[key].add(window)
        seen.append(near)
    out = []
    for near in seen:
        added = {}
        for e, w, _, a, b in near:
            if len(windows[e, w]) >= pii.SUPPORT:
                d = math.log(pair[e, w] * n / (df[w] * entity[e])) / math.log(n / entity[e])
                if d >= pii.GENERALISE - 1e-12:
                    added[a, b] = max(d, added.get((a, b), 0))
        out.append(sorted(("removed" if d >= pii.REMOVE else "generalised", a, b) for (a, b), d in added.items()))
    return out


def test_terms_that_disclose(spark):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [tuple(s) for s in r.spans if s.kind in pii.ADDED] for r in pii.find(docs).collect()}
    expected = brute(texts)
    assert [sorted(found[i]) for i in range(len(texts))] == expected
    assert any("Jonathan" == texts[i][a:b] for i, e in enumerate(expected) for k, a, b in e if k == "removed")
    assert not any(expected[300:])


def test_sanitised_rows(spark):
    rows = [(1, "mail a.b@c.de now", "x", 17, 1), (2, None, "y", 0, 2), (3, "", None, 0, 3), (None, "ip 1.2.3.4!", "z", 11, 4),
            (4, "clean text", "w", 10, 5), (1, "mail a.b@c.de now", "x2", 17, 6), (1, "other +49 (30) 123-4567 é", "v", 25, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, base string, n_chars long, spans int")
    out = {r.spans: (r.doc_id, r.text, r.base, r.n_chars) for r in pii.sanitise(docs).collect()}
    assert pii.sanitise(docs).columns == docs.columns
    assert out == {
        1: (1, "mail [EMAIL] now", "x", 16), 2: (2, None, "y", 0), 3: (3, "", None, 0), 4: (None, "ip [IP]!", "z", 8),
        5: (4, "clean text", "w", 10), 6: (1, "mail [EMAIL] now", "x2", 16), 7: (1, "other [PHONE] é", "v", 15)}
    assert pii.report(docs).count() == 7
    assert pii.report(docs.limit(0)).count() == 0
    assert pii.clean("Ab cd ef", [("generalised", 0, 2), ("removed", 3, 5)]) == "[Name]  ef"


def _filler(rng, n):
    return " ".join(rng.choice("bdfgkl") + rng.choice("aeiou") + rng.choice("mnrst") for _ in range(n))


def test_terms_far_from_the_entity(spark):
    """A name in a letter's first line, the address in its signature, and the name once more after it."""
    rng = random.Random(4)
    texts = [f"Dear Wilhelmina {_filler(rng, 60)} w.k@x.org {_filler(rng, 30)} Wilhelmina" for _ in range(5)]
    texts += [_filler(rng, 90) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find(docs).collect():
        words = [texts[r.doc_id][s.start : s.end] for s in r.spans if s.kind == "removed"]
        assert words.count("Wilhelmina") == (2 if r.doc_id < 5 else 0)


def test_passages_of_one_document(spark):
    """An address in one document only, where one name stands beside it in three passages."""
    rng = random.Random(6)
    texts = ["  ".join(f"{_filler(rng, 20)} Quentin q.z@x.org {_filler(rng, 20)}" for _ in range(3))]
    texts += [_filler(rng, 90) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    (row,) = pii.find(docs).where("doc_id = 0").collect()
    assert [texts[0][s.start : s.end] for s in row.spans if s.kind == "removed"].count("Quentin") == 3


def test_free_words_as_by_all_spans():
    text = "ab a.b@c.de cd +49 (30) 123-4567 ef 1.2.3.4 gh"
    assert [m[0] for m in pii._free(text)] == ["ab", "cd", "ef", "gh"]
