"""Byte-level BPE with the tiktoken library and a local rank file.

Texts are cut before encoding at places that the pattern never matches across: just before white space
that follows something else. Every match with white space begins with it, so such a cut always falls
between two matches, and the look-ahead of a white-space match sees the same run as in the whole text.
Memory is bounded by the text and its ids; no piece over ``SEGMENT`` characters meets the pattern at
once unless it has no white space.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENT = 1 << 16
# U+001C to U+001F are white space to Python, but not to the tokenizer.
_SAFE = re.compile(r"(?<=\S)(?=[^\S\x1c-\x1f])")


@cache
def encoding(rank_file: str, pattern: str):
    """The tiktoken encoding of a rank file, loaded once per Python worker."""
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def segments(text: str, size: int = SEGMENT) -> Iterator[str]:
    """``text`` in pieces that may be encoded one by one, each just over ``size`` characters."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(codec, text: str) -> list[int]:
    if len(text) <= SEGMENT:
        return codec.encode_ordinary(text)
    return [i for piece in segments(text) for i in codec.encode_ordinary(piece)]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    for batch in batches:
        for one in range(0, batch.num_rows, 256):
            part = batch.slice(one, 256)
            yield part.column(0), part.column(1)


def encode(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of every row; a null or empty text has no ids.

    Repeated rows stay repeated, other columns are ignored, an empty table gives no rows.
    """

    def run(batches):
        codec = encoding(rank_file, pattern)
        for ids, texts in _rows(batches):
            coded = pa.array([encode_text(codec, t or "") for t in texts.to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([ids, coded], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(coded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id and the raw bytes of every row of ``encode``; null ids give no bytes."""

    def run(batches):
        codec = encoding(rank_file, pattern)
        for ids, lists in _rows(batches):
            raw = pa.array([codec.decode_bytes(x or []) for x in lists.to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([ids, raw], names=["doc_id", "bytes"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def token_digests(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row: encode, then decode the ids.

    Both steps run in one pass, so that ids do not travel. Null and empty texts have no ids; their
    digests are those of nothing.
    """

    def run(batches):
        codec = encoding(rank_file, pattern)
        for ids, texts in _rows(batches):
            out = []
            for text in texts.to_pylist():
                coded = encode_text(codec, text or "")
                listed = " ".join(map(str, coded)).encode()
                back = codec.decode_bytes(coded)
                out.append((len(coded), hashlib.sha256(listed).hexdigest(), hashlib.sha256(back).hexdigest()))
            counts, listed, back = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(counts, pa.int64()), pa.array(listed), pa.array(back)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
