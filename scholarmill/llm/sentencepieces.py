"""SentencePiece encoding of merge-type models by backtracking, and decoding.

Merging joins, again and again, the neighbouring symbols whose joint piece scores best, the leftmost of
equals. Of its result two things hold: every piece in it comes out whole if its own letters are merged,
and so do any two neighbours. They hold of no other way to cut the text, because merges inside two
neighbours come in the same order with and without the rest. So a search finds the result without
merging the text: Aho-Corasick matching gives the longest piece at each place, a candidate must be
compatible with the piece before it (the two are merged anew, and the answer remembered), shorter
prefixes are tried next, and a place from which nothing leads on is marked in a bit field, so that no
place is tried twice. The way to reach a place is unique, hence the marks hold whatever came before.

Texts are cut where no piece crosses: before a space mark behind another character, and around characters that
stand in no longer piece. Most cuts are words met before, kept in a bounded cache. The library
normalises and decodes; letters without a piece become bytes as it would have them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Longest cut that is remembered, and how many cuts and pairs are.
LONGEST_CACHED, CACHED = 48, 400_000


class Codec:
    """Encoder of one model of merge type with byte fallback and without pieces of the user."""

    def __init__(self, model_file: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        self.library = lib = SentencePieceProcessor(model_file=model_file)
        everything = range(lib.get_piece_size())
        if sum(map(lib.is_byte, everything)) != 256 or any(map(lib.is_unused, everything)):
            raise ValueError("the model must have all byte pieces and no unused ones")
        plain = [i for i in everything if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
        self.ids = {lib.id_to_piece(i): i for i in plain}
        self.score = {lib.id_to_piece(i): lib.get_score(i) for i in plain}
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.begin, self.end = (np.array([i], "<u4").tobytes() for i in (lib.bos_id(), lib.eos_id()))
        letters = set("".join(self.ids))
        whole = letters | {p for p in self.ids if self.merge(p) == [p]}
        self.matcher = ahocorasick.Automaton()
        for piece in whole:
            self.matcher.add_word(piece, piece)
        self.matcher.make_automaton()
        # The longest piece that a piece begins with.
        self.shorter = {p: next((p[:n] for n in range(len(p) - 1, 0, -1) if p[:n] in whole), None) for p in whole}
        self.cuts = re.compile(self._cut_pattern(), re.DOTALL)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def _cut_pattern(self) -> str:
        joined = set("".join(p for p in self.ids if len(p) > 1))
        alone = "".join(re.escape(c) for c in "\n\t\r" if c not in joined)
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            return ".+"
        if not alone:
            return f"{MARK}+[^{MARK}]*|[^{MARK}]+"
        return f"{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+|[{alone}]"

    def merge(self, text: str) -> list[str]:
        """The definition: join the best neighbours until none have a joint piece."""
        parts, score = list(text), self.score
        while True:
            joint = [(-score[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in score]
            if not joint:
                return parts
            _, i = min(joint)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def fits(self, left: str, right: str) -> bool:
        """Do two pieces stay as they are if their letters are merged together?"""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= CACHED:
                self.pairs.clear()
            known = self.pairs[left, right] = self.merge(left + right) == [left, right]
        return known

    def search(self, text: str) -> list[str]:
        """The pieces of ``text``, by backtracking."""
        n, shorter, fits = len(text), self.shorter, self.fits
        longest: list[str] = list(text)  # a letter without a piece stands for itself
        for last, piece in self.matcher.iter(text):  # by rising end, so the longest comes last
            longest[last - len(piece) + 1] = piece
        failed = bytearray((n >> 3) + 1)
        out: list[str] = []
        at, piece = 0, longest[0] if n else None
        while at < n:
            while piece is not None:
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1 and (not out or fits(out[-1], piece)):
                    break
                piece = shorter.get(piece)
            if piece is None:
                failed[at >> 3] |= 1 << (at & 7)
                before = out.pop()
                at -= len(before)
                piece = shorter.get(before)
            else:
                out.append(piece)
                at = end
                piece = longest[at] if at < n else None
        return out

    def _coded(self, cut: str) -> bytes:
        ids: list[int] = []
        for piece in self.search(cut):
            one = self.ids.get(piece)
            if one is None:
                ids += [self.bytes[b] for b in piece.encode()]
            else:
                ids.append(one)
        return np.array(ids, "<u4").tobytes()

    def _learn(self, cut: str) -> bytes:
        if len(cut) > LONGEST_CACHED:
            return self._coded(cut)
        coded = self.old.get(cut) or self._coded(cut)
        if len(self.young) >= CACHED:
            self.old, self.young = self.young, {}
        self.young[cut] = coded
        return coded

    def encode(self, text: str) -> bytes:
        """Ids of ``text`` with begin and end, as little-endian unsigned 32-bit numbers."""
        known, learn = self.young.get, self._learn
        parts = [known(c) or learn(c) for c in self.cuts.findall(self.library.normalize(text))]
        return b"".join([self.begin, *parts, self.end])

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@cache
def codec(model_file: str) -> Codec:
    """One for each Python worker, which keeps its cache from task to task."""
    return Codec(model_file)


def _mapped(rows: DataFrame, columns: list[str], schema: str, kinds: list[pa.DataType], model_file: str, answer) -> DataFrame:
    """``answer(codec, value)`` gives the columns after doc_id for the second of ``columns``."""
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(model_file)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = zip(*(answer(code, v) for v in part.column(1).to_pylist()))
                columns = [pa.array(c, k) for c, k in zip(found, kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=names)

    chosen = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(columns[1]))
    return chosen.mapInArrow(run, schema)


def _numbers(coded: bytes) -> np.ndarray:
    return np.frombuffer(coded, "<u4")


def encode(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id and ids (array of int) of every row, begin and end ids included.

    A null or empty text has these two alone. Texts of any length are taken whole; a task holds one
    text, its ids and a byte for eight letters of its longest cut. Repeated rows stay repeated, other
    columns are ignored, an empty table gives no rows.
    """
    return _mapped(docs, ["doc_id", "text"], "doc_id long, ids array<int>", [pa.list_(pa.int32())], model_file,
                   lambda code, text: (_numbers(code.encode(text or "")).astype("<i4"),))


def decode(coded: DataFrame, model_file: str) -> DataFrame:
    """doc_id and text of every row of ``encode``; null ids give an empty text."""
    return _mapped(coded, ["doc_id", "ids"], "doc_id long, text string", [pa.string()], model_file,
                   lambda code, ids: (code.decode(ids or []),))


def token_digests(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row: encode, then decode the ids.

    Both steps run in one pass, so that ids do not travel. Rows as in ``encode``.
    """

    def answer(code: Codec, text: str | None) -> tuple[int, str, str]:
        raw = code.encode(text or "")
        back = code.decode(_numbers(raw).tolist())
        return len(raw) // 4, hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest()

    return _mapped(docs, ["doc_id", "text"], "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
                   [pa.int64(), pa.string(), pa.string()], model_file, answer)
