from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from scholarmill.llm import alignment, queries
from tests.conftest import SMALL

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def letters():
    """Byte-level letters as the vocabulary's makers define them."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out, more = {chr(b): b for b in own}, 0
    for b in range(256):
        if b not in own:
            out[chr(256 + more)], more = b, more + 1
    return out


@pytest.fixture(scope="module")
def plain():
    """Groups of a text by comparing all ends, and no windows."""
    a, b, byte = Tokenizer.from_file(BYTES), SentencePieceProcessor(model_file=PIECES), letters()
    a.encode_special_tokens = True

    def groups(text):
        if not text:
            return []
        coded = a.encode(" " + text, add_special_tokens=False)
        side_a = [(i, bytes(byte[c] for c in t)) for i, t in zip(coded.ids, coded.tokens)]
        side_b = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            side_b.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        if any(b"".join(t for _, t in side) != whole for side in (side_a, side_b)):
            return []
        ends = []
        for side in (side_a, side_b):
            at, told = 0, []
            for i, t in side:
                at += len(t)
                told.append((at, i))
            ends.append(told)
        cuts = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
        return [tuple([i for e, i in side if low < e <= high] for side in ends) for low, high in zip([0, *cuts], cuts)]

    return groups


def expected(plain, rows):
    found = [(i, plain(t or "")) for i, t in rows]
    count = Counter((a[-1], b[-1]) for _, groups in found for a, b in groups)
    highest = Counter()
    for (_, b), n in count.items():
        highest[b] = max(highest[b], n)
    out = []
    for i, groups in found:
        links = [(a[-1], b[-1]) for a, b in groups]
        told = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                    sum(count[p] == highest[p[1]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(told.encode()).hexdigest() if told else ""))
    return sorted(out, key=lambda r: (r[0] or 0, r[1:]))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0] or 0, r[1:]))


ODD = [(1, None), (2, ""), (3, " "), (3, " "), (4, "▁ is not a space"), (5, "<|endoftext|> <s> <0x41>"), (None, "a null id"),
       (6, "日本語 🙂 \x00 é é"), (7, "  two  \n\n three   "), (8, "tabs\tand\r\nlines"), (9, "naïveté's co-op!!"), (10, "x")]


def test_query(spark, plain):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(queries.op11_alignment(spark, SMALL)) == expected(plain, docs)


def test_odd_rows_and_small_chunks(spark, plain, monkeypatch):
    pick = random.Random(4)
    words = ["the", " ", "  ", "nation", "naïve", "\n", "日本", "!!", "x1", "'s", "ﬁ"]
    rows = ODD + [(100 + n, "".join(pick.choice(words) + pick.choice(["", " "]) for _ in range(20))) for n in range(60)]
    docs = spark.createDataFrame([(*r, 1, "c") for r in rows], "doc_id long, text string, chunk int, sha string").repartition(3)
    right = expected(plain, rows)
    assert rows_of(alignment.alignment_counts(docs, BYTES, PIECES)) == right
    assert alignment.alignment_counts(docs.limit(0), BYTES, PIECES).count() == 0
    listed = {(r.doc_id, tuple((tuple(a), tuple(b)) for a, b in r.groups)) for r in alignment.align(docs, BYTES, PIECES).collect()}
    assert listed == {(i, tuple((tuple(a), tuple(b)) for a, b in plain(t or ""))) for i, t in rows}


def test_counts_do_not_depend_on_chunks(spark, plain):
    """One row a chunk, so every pair's count comes from many lists, most of them from equal rows."""
    rows = [(n, "one common line of words" if n % 3 else f"line {n} of its own words") for n in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(30)
    assert rows_of(alignment.alignment_counts(docs, BYTES, PIECES)) == expected(plain, rows)


def test_memory_is_bounded_and_begins_anew(monkeypatch):
    both = alignment.Aligner(BYTES, PIECES)
    texts = [f"some words {n} and more" for n in range(50)]

    def told():
        return [[t for t, _ in both.aligned(w)] for w in both.windows(texts)]

    before = told()
    both.forget()
    assert told() == before
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    both.forget()
    assert told() == before and len(both.young) <= 3


def test_parts_of_a_text_have_the_tokens_of_the_whole():
    both = alignment.Aligner(BYTES, PIECES)
    pick = random.Random(9)
    texts = ["a  b   c    d " * 9, "no-space" * 40, "line\n\n next \t x " * 9, " lead", "trail ", " ", "é 日 本 's 's", "a\n  x", "a \x1c x"]
    texts += ["".join(pick.choice("ab's \n\t1!é日\x1c\u3000") for _ in range(pick.randint(1, 25))) for _ in range(3000)]
    def ids(windows):
        return [np.frombuffer(b"".join(side), "<u4").tolist() for side in zip(*windows)]

    for text, windows in zip(texts, both.windows(texts)):
        a, b = ids(windows)
        assert "".join(both.units(" " + text)) == " " + text
        assert a == both.a.encode(" " + text, add_special_tokens=False).ids, repr(text)
        assert b == both.b.encode(text), repr(text)
        # Every window begins with a token that begins with a space, on both sides.
        assert all(both.space_a[w[0][0]] and both.space_b[w[1][0]] for w in ([np.frombuffer(s, "<u4") for s in w] for w in windows))
    both = alignment.Aligner(BYTES, PIECES)
    both.can_cut = False
    for text, windows in zip(texts[:20], both.windows(texts[:20])):
        assert len(windows) == 1
        assert ids(windows) == [both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)]


def test_a_text_of_some_megabytes(spark, plain):
    text = "".join(f"word{n % 977} and more, " for n in range(150_000))
    docs = spark.createDataFrame([(1, text), (2, "and more")], "doc_id long, text string")
    (one, two) = rows_of(alignment.alignment_counts(docs, BYTES, PIECES))
    assert one[3] == one[4] > 300_000 and two[1] > 0
    both = alignment.Aligner(BYTES, PIECES)
    (windows,) = both.windows([text])
    assert tuple(sum(map(len, side)) // 4 for side in zip(*windows)) == one[1:3]
