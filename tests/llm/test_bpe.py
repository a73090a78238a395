from __future__ import annotations

import base64
import hashlib

import public_tokenizers
import tiktoken

from scholarmill.llm import bpe, queries
from tests.conftest import SMALL

FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")


def plain():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(FILE, "rb"))}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pieces_encode_as_the_whole(monkeypatch):
    monkeypatch.setattr(bpe, "SEGMENT", 7)
    codec = plain()
    texts = ["", "a", "it's  a   test\n\n\tx y", " lead", "nospace" * 30, "a  b   c    d     e      f", "é 日本 語 　x's 12 3!!", "<|endoftext|> x y z", "  \n  " * 9]
    for text in texts:
        assert "".join(bpe.segments(text, 7)) == text
        assert bpe.encode_text(codec, text) == codec.encode_ordinary(text)


def test_query(spark):
    codec, expected = plain(), {}
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        ids = codec.encode_ordinary(r.text)
        expected[r.doc_id] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                              hashlib.sha256(r.text.encode()).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in queries.op4_bpe(spark, SMALL).collect()} == expected


def test_round_trip_of_odd_rows(spark):
    rows = [(1, None, "x"), (2, ""), (2, "é🙂 \x00\n"), (2, "é🙂 \x00\n"), (None, "null id"), (3, "long " * 50000)]
    docs = spark.createDataFrame([(r[0], r[1], 5) for r in rows], "doc_id long, text string, ids int")
    coded = bpe.encode(docs, FILE, public_tokenizers.PATTERN)
    back = bpe.decode(coded, FILE, public_tokenizers.PATTERN)
    key = lambda r: (r[0] or 0, r[1])
    assert sorted(((r.doc_id, bytes(r.bytes)) for r in back.collect()), key=key) == sorted(
        ((r[0], (r[1] or "").encode()) for r in rows), key=key)
    assert bpe.token_digests(docs.limit(0), FILE, public_tokenizers.PATTERN).count() == 0
    none = bpe.token_digests(docs.where("doc_id = 1"), FILE, public_tokenizers.PATTERN).first()
    assert none.n_tokens == 0 and none.ids_sha256 == none.decoded_sha256 == hashlib.sha256(b"").hexdigest()


def test_no_cut_before_separators_the_tokenizer_takes_for_marks():
    text = "ab!\x1c\x1d\x1e\x1f cd"
    assert [list(bpe.segments(text, n)) for n in range(1, 7)] == [["ab!\x1c\x1d\x1e\x1f cd"]] * 6
    assert list(bpe.segments("ab!\x1c cd ef", 2)) == ["ab!\x1c cd", " ef"]
