"""Packing token pieces into sequences by linear grouping.

Lengths are whole numbers up to the capacity, so the plan needs only how many pieces have each length:
a table whose size the capacity bounds. On it, large lengths are put in groups of equal cardinality and
rounded up to their group's largest; patterns of few sizes that fill a sequence best are chosen and used
as often as the groups allow; the actual pieces take the places in order of length; small pieces go,
largest first, where they fit best. The plan is a list of intervals: pieces of one length, by their rank
within that length, in consecutive sequences at one offset. Ranks are drawn by a distributed sort, and
every piece looks up its own place.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import accumulate
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.operators.positions import with_positions
from scholarmill.session import stored

CAPACITY = 2048
END = b"\0\0\0\0"
#: Lengths over this part of the capacity are large.
LARGE = 1 / 8
GROUPS = 256

# --- tokens ---------------------------------------------------------------------------------------

#: White space to a split at white space but not to the tokenizer.
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_SPACE = re.compile("[ \t\n\r]")
_LONGEST_CACHED = 64
#: Characters of text whose words are held at once.
BATCH_CHARS = 8_000_000
#: Words of a generation of a cache; there are two.
_CACHED = 200_000
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: How byte-level tokenizers write a byte: itself if it prints, else the next letter from U+0100 on.
_BYTE_NAMES = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in _PRINTED)}
#: The same as a table, but for the space between words.
_NAMED = np.array([b if b == 32 else _BYTE_NAMES.get(b, b) for b in range(256)], "<u2")


class Recent:
    """A bounded cache of two generations. What is asked for again lives on; the rest goes with its own."""

    def __init__(self):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def unknown(self, words: set[str]) -> set[str]:
        """Those of ``words`` that are not held; the others are ``young`` until the next call."""
        if len(self.young) > _CACHED:
            self.old, self.young = self.young, {}
        rest = words.difference(self.young)
        again = rest.intersection(self.old)
        self.young.update((w, self.old[w]) for w in again)
        return rest - again


def _gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Parts of ``flat``, one after the other."""
    ends = np.cumsum(sizes)
    return flat[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


class Coder:
    """Ids of texts by a tokenizer that drops white space and never merges across it.

    A text's ids are those of its white-space separated parts. Arrow splits many texts and finds their
    distinct parts; only these are looked at one by one, and what the bounded caches do not hold goes
    through the tokenizer, many at once. A part of plain letters with marks behind it is split like the
    tokenizer does: the letters, and all marks as one.

    Lower-cased letters are one word to the tokenizer's splitter. They skip it: a second tokenizer with
    the same merges, which splits at spaces only, takes their bytes in the form the splitter would pass
    on, and a word ends with the token that bears the end-of-word suffix. Everything else goes through
    the tokenizer as it is.
    """

    def __init__(self, file: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = True
        with open(file, encoding="utf-8") as text:
            plain = json.load(text)
        plain |= {"normalizer": None, "pre_tokenizer": None, "added_tokens": []}
        self.words = Tokenizer.from_str(json.dumps(plain))
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary, suffix = plain["model"]["vocab"], plain["model"]["end_of_word_suffix"]
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.bases, self.others = Recent(), Recent()

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _letters(self, words: list[str]) -> Iterator[bytes]:
        """Ids of lower-cased words of letters."""
        for i in range(0, len(words), 10_000):
            raw = np.frombuffer(" ".join(words[i : i + 10_000]).encode(), np.uint8)
            named = _NAMED[raw].tobytes().decode("utf-16-le")
            (coded,) = self.words.encode_batch_fast([named], add_special_tokens=False)
            ids = np.asarray(coded.ids, "<u4")
            ends = ((np.flatnonzero(self.ends_word[ids]) + 1) * 4).tolist()
            raw = ids.tobytes()
            yield from [raw[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def _all(self, words: pa.Array, held: Recent, learn) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the distinct words in one array, and where those of each of ``words`` start and how many they are."""
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = list(held.unknown(set(distinct)))
        held.young.update(zip(new, learn(new)))
        ids = [held.young[w] for w in distinct]
        for w in new:
            if len(w) > _LONGEST_CACHED:
                del held.young[w]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        at = coded.indices.to_numpy()
        return np.frombuffer(b"".join(ids), "<u4"), (np.cumsum(sizes) - sizes)[at], sizes[at]

    def _parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some distinct parts in a row, and how many each has."""
        offsets = np.frombuffer(parts.buffers()[1], np.int32)[parts.offset : parts.offset + len(parts) + 1]
        # Up to U+00FF, whose bytes end at 0xC3, lower-casing is letter by letter, and nothing composes or decomposes.
        high = np.r_[0, np.cumsum(np.frombuffer(parts.buffers()[2] or b"", np.uint8)[: offsets[-1]] > 0xC3)][offsets]
        whole = pc.utf8_lower(parts)
        low = pc.ascii_rtrim(whole, characters=punctuation)
        simple = (high[1:] == high[:-1]) & pc.utf8_is_alpha(low).to_numpy(False) & (np.diff(offsets) <= _LONGEST_CACHED)
        at = np.flatnonzero(simple)
        whole, low = whole.take(pa.array(at)), low.take(pa.array(at))
        marked = np.flatnonzero((pc.binary_length(low).to_numpy() < pc.binary_length(whole).to_numpy()))
        some = pa.array(marked)
        marks = pa.array([w[len(b) :] for w, b in zip(whole.take(some).to_pylist(), low.take(some).to_pylist())], pa.string())
        rest = np.flatnonzero(~simple)

        def wholes(words):
            return [self._whole(w) for w in words]

        starts, sizes = np.zeros((2, 2, len(parts)), np.int64)
        base, starts[0, at], sizes[0, at] = self._all(low, self.bases, self._letters)
        other, found, size = self._all(pa.concat_arrays([parts.take(pa.array(rest)), marks]), self.others, wholes)
        starts[0, rest], sizes[0, rest] = found[: len(rest)] + len(base), size[: len(rest)]
        starts[1, at[marked]], sizes[1, at[marked]] = found[len(rest) :] + len(base), size[len(rest) :]
        flat = np.concatenate([base, other])
        return _gathered(flat, starts.T.ravel(), sizes.T.ravel()), sizes.sum(axis=0)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        odd = [bool(_ODD_SPACE.search(t)) for t in texts]
        split = pc.utf8_split_whitespace(pa.array(["" if o else t for o, t in zip(odd, texts)], pa.string()))
        coded = split.flatten().dictionary_encode()
        ids, sizes = self._parts(coded.dictionary)
        at = coded.indices.to_numpy()
        own = sizes[at]
        data = _gathered(ids, (np.cumsum(sizes) - sizes)[at], own).tobytes()
        words = np.r_[0, np.cumsum(split.value_lengths().to_numpy())]
        ends = (4 * np.r_[0, np.cumsum(own)][words]).tolist()
        for o, text, a, b in zip(odd, texts, ends, ends[1:]):
            yield self._whole(text) if o else data[a:b]


@cache
def coder(file: str) -> Coder:
    """One for each Python worker, which keeps its cache from task to task."""
    return Coder(file)


def _segments(text: str) -> Iterator[str]:
    """A text in pieces of bounded length, cut at white space, whose ids follow each other."""
    start = 0
    while len(text) - start > BATCH_CHARS:
        cut = _SPACE.search(text, start + BATCH_CHARS)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def _coded(code: Coder, texts: list[str]) -> list[bytes]:
    """Ids of each text; no more than about ``BATCH_CHARS`` are split into words at once."""
    out: list[list[bytes]] = [[] for _ in texts]
    some: list[tuple[int, str]] = []
    size = 0

    def flush():
        for (row, _), ids in zip(some, code.encode([s for _, s in some])):
            out[row].append(ids)

    for row, text in enumerate(texts):
        for segment in _segments(text):
            some.append((row, segment))
            size += len(segment)
            if size > BATCH_CHARS:
                flush()
                some, size = [], 0
    flush()
    return [b"".join(parts) for parts in out]


def pieces(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids as bytes) of every piece of every row.

    A document is its ids and an end id 0; only one longer than ``capacity`` is cut. A null text is
    empty and has the end id alone. Texts of any length are cut at white space before they are tokenized.
    Repeated rows stay repeated, other columns are ignored, an empty table gives no rows.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * with_ids]
    width = 4 * capacity

    def run(batches):
        code = coder(tokenizer_file)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                ids, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                rows = []
                for doc, coded in zip(ids, _coded(code, [t or "" for t in texts])):
                    coded += END
                    for n, a in enumerate(range(0, len(coded), width)):
                        cut = coded[a : a + width]
                        rows.append((doc, n, n * capacity, len(cut) // 4, zlib.crc32(cut), *[cut] * with_ids))
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        pa.default_memory_pool().release_unused()  # the worker stays for other stages

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


# --- the plan -------------------------------------------------------------------------------------


class Runs:
    """Sequences of the same content: consecutive numbers, and slots in the order of their offsets.

    A slot is (length, shift): the piece in sequence s has rank s + shift among those of its length.
    """

    def __init__(self, capacity: int):
        self.free: dict[int, list] = defaultdict(list)
        self.capacity = capacity
        self.used = 0

    def put(self, first: int, count: int, left: int, slots: tuple) -> None:
        if count:
            self.free[left].append((first, count, left, slots))

    def new(self, count: int) -> int:
        self.used += count
        return self.used - count


def _best_fill(room: int, sizes: list[int], counts: list[int]) -> list[int]:
    """How many of each size fill ``room`` most; a subset-sum over bits, undone from its largest sum."""
    limit = (1 << (room + 1)) - 1
    stages, reach = [], 1
    for size, count in zip(sizes, counts):
        stages.append(reach)
        for _ in range(min(count, room // size)):
            more = reach | (reach << size) & limit
            if more == reach:
                break
            reach = more
    total, used = reach.bit_length() - 1, [0] * len(sizes)
    for at in reversed(range(len(sizes))):
        while not stages[at] >> total & 1:
            total -= sizes[at]
            used[at] += 1
    return used


def _large(runs: Runs, lengths: list[int], counts: dict[int, int], groups: int) -> None:
    """Pack pieces of ``lengths`` (falling) by patterns over rounded sizes."""
    ends = list(accumulate(counts[n] for n in lengths))
    starts = [0, *ends[:-1]]
    total = ends[-1] if ends else 0
    cuts = sorted({total * g // groups for g in range(groups)}) if total else []
    bounds: dict[int, list[int]] = {}
    for a, b in zip(cuts, [*cuts[1:], total]):
        size = lengths[bisect_right(starts, a) - 1]
        old = bounds.get(size)
        bounds[size] = [old[0] if old else a, b]  # groups of one size are one
    sizes = sorted(bounds)  # rising, so that what is undone last, the small, is used least
    left = [bounds[s][1] - bounds[s][0] for s in sizes]
    at = [bounds[s][0] for s in sizes]
    while any(left):
        top = max(i for i, n in enumerate(left) if n)
        rest = left.copy()
        rest[top] -= 1
        used = _best_fill(runs.capacity - sizes[top], sizes, rest)
        used[top] += 1
        times = min(left[i] // u for i, u in enumerate(used) if u)
        first, slots = runs.new(times), []
        for i in reversed(range(len(sizes))):
            for _ in range(used[i]):
                slots.append(at[i])
                at[i] += times
                left[i] -= times
        # Actual pieces in the places of rounded ones: cut where some slot's length changes.
        turns = {0, times}
        for s in slots:
            turns.update(b - s for b in starts[bisect_right(starts, s) : bisect_left(starts, s + times)])
        turns = sorted(turns)
        for a, b in zip(turns, turns[1:]):
            own = [bisect_right(starts, s + a) - 1 for s in slots]
            held = tuple((lengths[k], s + 1 - starts[k] - first) for k, s in zip(own, slots))
            runs.put(first + a, b - a, runs.capacity - sum(n for n, _ in held), held)


def _small(runs: Runs, length: int, count: int) -> None:
    """Put ``count`` pieces of ``length`` where the least room is left over."""
    rank = 1
    rooms = iter(sorted(r for r in runs.free if r >= length and runs.free[r]))
    room = next(rooms, None)
    while count:
        while room is not None and not runs.free[room]:
            room = next(rooms, None)
        if room is None:
            each = runs.capacity // length
            full, rest = divmod(count, each)
            for times, k in ((full, each), (1, rest)):
                if times and k:
                    first = runs.new(times)
                    slots = tuple((length, rank + i * times - first) for i in range(k))
                    runs.put(first, times, runs.capacity - k * length, slots)
                    rank += k * times
            return
        first, many, left, slots = runs.free[room].pop()
        each = min(room // length, count)
        times = min(many, count // each)
        more = tuple((length, rank + i * times - first) for i in range(each))
        runs.put(first + times, many - times, left, slots)
        runs.put(first, times, left - each * length, slots + more)
        rank, count = rank + each * times, count - each * times


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> np.ndarray:
    """Rows (length, first rank, pieces, first sequence, offset) that place every piece, sorted.

    ``counts`` has the number of pieces of each length from 1 to ``capacity``; the number of rows
    depends on the lengths, not on the number of pieces.
    """
    lengths = sorted(counts, reverse=True)
    edge = capacity * LARGE
    runs = Runs(capacity)
    _large(runs, [n for n in lengths if n > edge], counts, groups)
    for n in lengths:
        if n <= edge:
            _small(runs, n, counts[n])
    rows = []
    for some in runs.free.values():
        for first, many, _, slots in some:
            offset = 0
            for length, shift in slots:
                rows.append((length, first + shift, many, first, offset))
                offset += length
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(items: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """``items`` (with ``length`` from 1 to ``capacity``) with sequence_id and offset.

    Sequences are numbered from 0; offsets run from 0 without gaps. Equal items go to any of the
    places for their length. An empty table gives no rows.
    """
    unique = [c for c in ("doc_id", "piece", "start", "ids_crc32") if c in items.columns]
    # The sort looks at its input twice, once for the ranges; stored, texts are tokenized once.
    ranked = stored(with_positions(stored(items), ["length"], [F.col(c) for c in unique], "rank"))
    # One row per length: the capacity bounds what comes to the driver.
    counts = {r["length"]: r["count"] for r in ranked.groupBy("length").count().collect()}
    table = plan(counts, capacity, groups)
    shared = items.sparkSession.sparkContext.broadcast(table)
    fields = [*ranked.schema.fields]

    def run(batches):
        rows = shared.value
        key = rows[:, 0] << 44 | rows[:, 1]
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            at = np.searchsorted(key, length << 44 | rank, side="right") - 1
            sequence = rows[at, 3] + rank - rows[at, 1]
            columns = [c for c, f in zip(batch.columns, fields) if f.name != "rank"]
            names = [f.name for f in fields if f.name != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(rows[at, 4])], names=[*names, "sequence_id", "offset"]
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields if f.name != "rank")
    return ranked.mapInArrow(run, schema + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every row of ``docs`` with its sequence and offset; see ``pieces`` and ``pack``.

    Columns but doc_id and text are ignored, so their names do not matter.
    """
    return pack(pieces(docs, tokenizer_file, capacity), capacity)
