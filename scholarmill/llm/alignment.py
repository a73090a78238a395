"""Alignment of the tokens of two tokenizers over a corpus, by whitespace-token anchors.

A text is tokenized whole by both: byte-level BPE (A) over a space and the text, pieces (B) over the
text, before which the model sets the space itself. The libraries are asked about parts between which no
token of either crosses, and mostly about new ones. Token bytes are joined and held against the text's.
Where a token of both sides begins with a space at the same byte, and the ends before it are found to be
the same, is an anchor. Anchors split a document into windows of token ids on both sides, mostly a word
each. What a window's groups and links are depends on its ids alone, so windows are aligned once and
looked up by their ids afterwards. Windows that repeat are most of a corpus.

Counts are corpus-wide and exact. A task gathers the links of some MB of text as places in a sorted list
of the distinct pairs of ids, and stores one row for all of that: the documents, their links and the
list with counts. Lists are summed by pair in Spark, the sums with the mark of a highest count go back to every
list that has the pair, and each stored row meets its own sums. So no table of all pairs is in one place,
and texts are tokenized once.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.session import stored

#: Bytes of texts whose links share a list of pairs.
CHUNK_BYTES = 16 << 20
#: Windows of a generation of the memory; there are two.
REMEMBERED = 120_000
#: Numbered pairs of ids over which a worker begins anew with its next chunk.
PAIRS = 1 << 20
MARK = "▁"
#: Longest part of a text whose ids are remembered.
LONGEST = 48
#: From a space behind something else, or the start, to the next.
_UNIT = re.compile(r" (?:[^ ]+|(?<=\s) )*")
#: Ids of A and of B between two anchors, four bytes each.
Window = tuple[bytes, bytes]
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: The byte for each letter that byte-level vocabularies write: itself if it prints, else the next from U+0100 on.
_BYTE_OF = {chr(b): b for b in _PRINTED} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in _PRINTED)}


def _table(names: dict[int, bytes], size: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Bytes by id, their lengths, and whether they begin with a space."""
    table = [names.get(i, b"") for i in range(size)]
    return table, np.array([len(t) for t in table]), np.array([t[:1] == b" " for t in table])


class Aligner:
    """Two tokenizers and the windows seen lately."""

    def __init__(self, byte_file: str, piece_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_file)
        self.a.encode_special_tokens = True
        with open(byte_file, encoding="utf-8") as text:
            entries = json.load(text)["model"]["vocab"]
        # Entries that are not written in byte letters are special and never come from a text.
        names = {i: bytes(map(_BYTE_OF.get, t)) for t, i in entries.items() if all(c in _BYTE_OF for c in t)}
        self.bytes_a, self.length_a, self.space_a = _table(names, max(entries.values()) + 1)
        self.b = lib = SentencePieceProcessor(model_file=piece_file)
        pieces = {i: lib.id_to_piece(i) for i in range(lib.get_piece_size())}
        raw = {i: bytes([int(p[1:-1], 16)]) if lib.is_byte(i) else p.replace(MARK, " ").encode() for i, p in pieces.items()}
        self.bytes_b, self.length_b, self.space_b = _table(raw, len(pieces))
        self.can_cut = not any(MARK in p.lstrip(MARK) for p in pieces.values())
        self.sizes_a, self.sizes_b = self.length_a.tolist(), self.length_b.tolist()
        self.told = [str(i) for i in range(max(len(self.bytes_a), len(self.bytes_b)))]
        self.forget()

    def forget(self) -> None:
        self.young_units: dict[str, Window | None] = {}
        self.old_units: dict[str, Window | None] = {}
        self.young: dict[Window, tuple[str, bytes]] = {}
        self.old: dict[Window, tuple[str, bytes]] = {}
        self.pairs: dict[int, tuple[int, str]] = {}  # number and text of a << 32 | b

    def units(self, text: str) -> list[str]:
        """A text that begins with a space in parts that do so too, between which no token of either side crosses."""
        return _UNIT.findall(text) if self.can_cut else [text]

    def _coded(self, units: set[str]) -> dict[str, Window | None]:
        """Ids of both sides by unit; None if either side's bytes are not the unit's. Known ones are looked up."""
        young, old = self.young_units, self.old_units
        found = {u: young[u] for u in units & young.keys()}
        again = {u: old[u] for u in (units - found.keys()) & old.keys()}
        new = units - found.keys() - again.keys()
        # A unit that ends with white space, the last of a text, would run on into the next one.
        plain = [u for u in new if self.can_cut and MARK not in u and not u[-1].isspace()]
        again |= self._in_one(plain)
        again |= {u: self._alone(u) for u in new - again.keys()}
        young.update((u, ids) for u, ids in again.items() if len(u) <= LONGEST)
        if len(young) >= REMEMBERED:
            self.old_units, self.young_units = young, {}
        return found | again

    def _in_one(self, units: list[str]) -> dict[str, Window]:
        """Ids of units one after the other, from one text of all; none if some token crosses or bytes differ.

        Both sides must end where a unit ends, and every unit begins with a space: there are the anchors.
        """
        text = "".join(units)
        if not text:
            return {}
        whole, ends = text.encode(), np.cumsum([len(u.encode()) for u in units])
        lines, tokens, sides = [], [], []
        coded = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.b.encode(text[1:])
        for ids, table, length in zip(coded, (self.bytes_a, self.bytes_b), (self.length_a, self.length_b)):
            line = np.array(ids, "<u4")
            at = length[line].cumsum()
            cuts = np.searchsorted(at, ends)
            if cuts[-1] >= len(at) or (at[cuts] != ends).any() or b"".join([table[i] for i in ids]) != whole:
                return {}
            raw, places = line.tobytes(), [0, *(4 * cuts + 4).tolist()]
            lines.append(line)
            tokens.append(at)
            sides.append([raw[i:j] for i, j in zip(places, places[1:])])
        windows = list(zip(*sides))
        self._remember(windows, ends, lines, tokens)
        return dict(zip(units, windows))

    def _pair(self, last: int) -> tuple[int, str]:
        pair = self.pairs.get(last)
        if pair is None:
            pair = self.pairs[last] = len(self.pairs), f"{last >> 32}|{last & 0xFFFFFFFF}"
        return pair

    def _remember(self, windows: list[Window], ends: np.ndarray, lines: list[np.ndarray], tokens: list[np.ndarray]) -> None:
        """Align windows that follow each other, up to the bytes ``ends``, all at once (see ``_align``).

        ``lines`` are the ids of both sides, ``tokens`` the bytes where they end.
        """
        shared = np.intersect1d(*tokens, assume_unique=True)
        last_a, last_b = (np.searchsorted(at, shared) for at in tokens)
        every, place = np.unique(lines[0][last_a].astype(np.int64) << 32 | lines[1][last_b], return_inverse=True)
        pairs = [self._pair(p) for p in every.tolist()]
        links = np.array([n for n, _ in pairs], np.uint32)[place].tobytes()
        texts = [pairs[i][1] for i in place.tolist()]
        first_a, first_b = np.r_[0, last_a[:-1] + 1], np.r_[0, last_b[:-1] + 1]
        a, b, told = lines[0].tolist(), lines[1].tolist(), self.told
        long = np.flatnonzero((last_a > first_a) | (last_b > first_b))
        for g, i, i2, j, j2 in zip(*(c.tolist() for c in (long, first_a[long], last_a[long], first_b[long], last_b[long]))):
            texts[g] = ",".join([told[x] for x in a[i : i2 + 1]]) + "|" + ",".join([told[x] for x in b[j : j2 + 1]])
        young, start = self.young, 0
        for window, stop in zip(windows, (np.searchsorted(shared, ends) + 1).tolist()):
            young[window] = ";".join(texts[start:stop]), links[4 * start : 4 * stop]
            start = stop
        if len(young) >= REMEMBERED:
            self.old, self.young = young, {}

    def _alone(self, unit: str) -> Window | None:
        (a,) = self.a.encode_batch_fast([unit], add_special_tokens=False)
        # A last space has nothing for B to set it before.
        b = self.b.encode(unit[1:]) if len(unit) > 1 else [self.b.piece_to_id(MARK)]
        sides = [(a.ids, self.bytes_a), (b, self.bytes_b)]
        if all(b"".join([table[i] for i in ids]) == unit.encode() for ids, table in sides):
            return tuple(array("I", ids).tobytes() for ids, _ in sides)
        return None

    def windows(self, texts: list[str]) -> Iterator[list[Window]]:
        """The windows of each text; none if the text is empty or either side's bytes differ from it.

        Neither side drops anything or joins what a space behind another character parts, so the ids of a
        text are those of its units, most of which have been met before. Between two units is an anchor.
        """
        parts = [self.units(" " + t) if t else [] for t in texts]
        known = self._coded(set().union(*parts))
        for units in parts:
            found = [known[u] for u in units]
            yield [] if None in found else found

    def aligned(self, windows: list[Window]) -> Iterator[tuple[str, bytes]]:
        """The groups of each window, and the numbers of its links (four bytes each)."""
        known, align = self.young.get, self._align
        for window in windows:
            found = known(window)
            if found is None:
                found = align(window)
                known = self.young.get
            yield found

    def _align(self, window: Window) -> tuple[str, bytes]:
        """Groups are cut wherever both sides end, so two tokens end together only at the end of a group: a
        group is a link of its last ids."""
        found = self.old.get(window)
        if found is None:
            a, b = (array("I", side) for side in window)
            size_a, size_b, told = self.sizes_a, self.sizes_b, self.told
            texts, links = [], []
            i = j = ahead = j2 = 0
            for i2, one in enumerate(a, 1):
                ahead += size_a[one]
                while ahead > 0:
                    ahead -= size_b[b[j2]]
                    j2 += 1
                if ahead:
                    continue
                pair = self._pair(one << 32 | b[j2 - 1])
                links.append(pair[0])
                if i2 - i == 1 == j2 - j:
                    texts.append(pair[1])
                else:
                    texts.append(",".join([told[x] for x in a[i:i2]]) + "|" + ",".join([told[x] for x in b[j:j2]]))
                i, j = i2, j2
            found = ";".join(texts), array("I", links).tobytes()
        if len(self.young) >= REMEMBERED:
            self.old, self.young = self.young, {}
        self.young[window] = found
        return found


@cache
def aligner(byte_file: str, piece_file: str) -> Aligner:
    """One for each Python worker, which keeps its windows from task to task."""
    return Aligner(byte_file, piece_file)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Rows in lists of some texts, so that a few MB are tokenized at once; a longer text is alone."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            if ids and size + len(text) > 1 << 20:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
        if ids:
            yield ids, texts


def _uncollected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, with cyclic garbage collection off until the last: the memory has no cycles, but walking
    it again and again would take a fifth of the time."""
    gc.disable()
    try:
        yield from batches
    finally:
        gc.enable()


def align(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """doc_id and groups of every row: (a, b), the ids of both sides between two places where both end.

    Texts that are null or empty, or that either tokenizer does not give back byte for byte, have no
    groups. Texts of any length are taken whole. Repeated rows stay repeated, other columns are ignored,
    an empty table gives no rows.
    """
    kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def run(batches):
        both = aligner(byte_file, piece_file)
        for ids, texts in _batches(batches):
            out = []
            for windows in both.windows(texts):
                groups = (g.split("|") for text, _ in both.aligned(windows) for g in text.split(";"))
                out.append([{s: list(map(int, ids.split(","))) for s, ids in zip("ab", g)} for g in groups])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, kind)], names=["doc_id", "groups"])

    return _texts(docs).mapInArrow(run, "doc_id long, groups array<struct<a: array<int>, b: array<int>>>")


_CHUNK = ("chunk long, doc_id array<long>, n_a array<long>, n_b array<long>, n_links array<long>, sha array<string>, "
          "links binary, pairs array<long>, counts array<long>")
_KINDS = [pa.int64(), *[pa.list_(pa.int64())] * 4, pa.list_(pa.string()), pa.binary(), *[pa.list_(pa.int64())] * 2]


def _pack(numbers: np.ndarray) -> bytes:
    """Whole numbers below 2^32, compressed byte plane by byte plane."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return pa.compress(planes, codec="zstd", asbytes=True)


def _unpack(data: bytes, length: int) -> np.ndarray:
    raw = pa.decompress(data, decompressed_size=4 * length, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, length).T).view("<u4").ravel()


def chunks(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """Rows of aligned documents, some MB of text each: counts and digests by document, all links, and
    the distinct pairs of ids with the number of links of each. ``links`` are places in ``pairs``."""
    names = [c.split(" ")[0] for c in _CHUNK.split(", ")]

    def run(batches):
        both = aligner(byte_file, piece_file)
        number, size = TaskContext.get().partitionId() << 33, 0
        rows: list[tuple] = []
        lines: list[np.ndarray] = []

        def row() -> pa.RecordBatch:
            every, pairs = np.concatenate(lines), np.fromiter(both.pairs, np.int64, len(both.pairs))
            counts = np.bincount(every, minlength=len(pairs))
            order = np.argsort(pairs)
            order = order[counts[order] > 0]
            place = np.zeros(len(pairs), np.int64)
            place[order] = np.arange(len(order))
            if len(pairs) > PAIRS:
                both.forget()
            values = [number, *map(list, zip(*rows)), _pack(place[every]), pairs[order], counts[order]]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, _KINDS)], names=names)

        for ids, texts in _batches(_uncollected(batches)):
            for doc_id, text, windows in zip(ids, texts, both.windows(texts)):
                groups, links = zip(*both.aligned(windows)) if windows else ((), ())
                sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
                lines.append(np.frombuffer(b"".join(links), np.uint32))
                n_a, n_b = (sum(map(len, side)) // 4 for side in zip(*windows)) if windows else (0, 0)
                rows.append((doc_id, n_a, n_b, len(lines[-1]), sha))
                size += len(text)
                if size > CHUNK_BYTES:
                    yield row()
                    number, size, rows, lines = number + 1, 0, [], []
        if rows:
            yield row()

    return _texts(docs).mapInArrow(run, _CHUNK)


def pair_counts(chunked: DataFrame) -> DataFrame:
    """a, b, count (links of the two ids in the corpus) and best: is it the highest count of this b?"""
    listed = chunked.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p")).select("p.pairs", "p.counts")
    summed = listed.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("count"))
    told = summed.select(
        F.shiftright("pair", 32).cast("int").alias("a"),
        F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("b"),
        "count",
    )
    highest = told.groupBy("b").agg(F.max("count").alias("highest"))
    return told.join(highest, "b").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))


def alignment_counts(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    A link's count is the number of links of its two ids in all rows; ``n_best`` are links whose count is
    the highest of their B id, ``count_sum`` adds up the counts. The digest is of "a1,a2|b1;a3|b2,b3", the
    ids of all groups. Rows as in ``align``; those without groups have zeros and an empty digest.
    Repeated rows all count.
    """
    done = stored(chunks(docs, byte_file, piece_file))
    sums = pair_counts(done).select(
        (F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")).alias("pair"), "count", "best"
    )
    wanted = done.select(F.col("chunk").alias("asks"), F.explode("pairs").alias("pair"))
    answers = wanted.join(sums, "pair").select("asks", "pair", "count", "best")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right["pair"].to_numpy())  # as the row's own list is sorted
        count, best = right["count"].to_numpy()[order], right["best"].to_numpy()[order]
        get = {c: left[c].combine_chunks().flatten() for c in ("doc_id", "n_a", "n_b", "n_links", "sha")}
        size = get["n_links"].to_numpy()
        links = _unpack(left["links"][0].as_py(), int(size.sum()))
        ends = np.cumsum(size)

        def summed(values: np.ndarray) -> pa.Array:
            total = np.concatenate([[0], np.cumsum(values[links], dtype=np.int64)])
            return pa.array(total[ends] - total[ends - size])

        columns = [get["doc_id"], get["n_a"], get["n_b"], get["n_links"], get["n_links"], summed(best), summed(count), get["sha"]]
        return pa.Table.from_arrays(columns, names=names)

    whole = done.select("chunk", "doc_id", "n_a", "n_b", "n_links", "sha", "links")
    return whole.groupBy("chunk").cogroup(answers.groupBy("asks")).applyInArrow(run, schema)
