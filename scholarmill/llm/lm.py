"""Language-model scores by a weighted backoff automaton.

Counting. Documents are stored once in chunks of a few MB of text, as places in the chunk's own list of
words. Every chunk sends its distinct words, with their training counts, to fixed hash buckets; a bucket
sums its own words and answers each request with sums and numbers. So each chunk is scored with the
exact count of each of its words and no table of all words is ever in one place.

The automaton. Every word of the training documents is a context, and so is every n-gram that occurs
``LEAST`` times; a context has an arc for each word that follows it as often. The threshold is a number,
not a share, so the automaton grows with the input. Arcs carry discounted log-probabilities; a failure
arc leads to the longest shorter context with the weight of what the discounts left over; the root has
the add-one unigram of every word. Probabilities of a state sum to 1.

It is never in one place. Words are numbered by bucket and place in it, n-grams of each order likewise,
so an n-gram is the number of its context and of its last word. Order by order, a chunk sends its
distinct n-grams with their training counts to the bucket of their context, each context once and last
words as steps, and gets back their sums, their numbers and the context's failure weight. The chunk is
then written with the answers, and the tables before it are deleted. An n-gram of which some part is no arc cannot be one
and is not sent. Contexts with more than ``HOT`` occurrences are dealt out by last word as well, and
their failure weights, one number each, are put together from partial sums.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.llm.common import doc_hash
from scholarmill.session import discard, stored

HELD_OUT = (7, 2)  # crc32(doc_id as text) mod 7 is 2
ORDER = 3
#: Occurrences in training documents from which an n-gram is an arc, and a context of the next order.
LEAST = 2
DISCOUNT = 0.5
CHUNK_BYTES = 5 << 20
#: Buckets of words and of n-grams: so many at least, and one for so many training tokens.
GRAM_BUCKETS, GRAM_TOKENS = 64, 1 << 20
#: Occurrences over which a context's n-grams are dealt to several buckets.
HOT = 1 << 15
END, START = 0, 1  # numbers of the end and start marks; words follow


def words_of(text: str) -> list[bytes]:
    """Words between space, tab, line feed, vertical tab, form feed, carriage return; A-Z lowered."""
    return text.encode("utf-8", "surrogatepass").lower().split()


# --- counts ---------------------------------------------------------------------------------------


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers, whole ones in as few bytes as the largest takes, compressed byte plane by byte plane."""
    planes, head = [], [len(arrays)]
    for a in arrays:
        if a.dtype.kind == "f":
            kind, width = 2, 8
        else:
            kind, most = 0, 0
            a = a.astype("<i8")
            if len(a):
                if a.min() < 0:
                    kind, a = 1, (a << 1) ^ (a >> 63)
                most = int(a.view("<u8").max())
            width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4 if most < 1 << 32 else 8
            a = a.astype(f"<u{width}")
        head += [kind << 8 | width, len(a)]
        planes.append(np.ascontiguousarray(a).view(np.uint8).reshape(-1, width).T.tobytes())
    raw = b"".join(planes)
    body = pa.compress(raw, codec="zstd", asbytes=True) if raw else b""
    return np.array(head, "<i8").tobytes() + body


def _unpack(data: bytes) -> list[np.ndarray]:
    """The arrays, as long or double."""
    n = 2 * int(np.frombuffer(data, "<i8", 1)[0])
    head = np.frombuffer(data, "<i8", n, 8).tolist()
    sizes = [(kind & 255) * length for kind, length in zip(head[::2], head[1::2])]
    raw = pa.decompress(data[8 + 8 * n :], decompressed_size=sum(sizes), codec="zstd", asbytes=True) if any(sizes) else b""
    out, start = [], 0
    for kind, length, size in zip(head[::2], head[1::2], sizes):
        width = kind & 255
        part = np.ascontiguousarray(np.frombuffer(raw, np.uint8, size, start).reshape(width, length).T)
        start += size
        if kind >> 8 == 2:
            out.append(part.view("<f8").ravel())
            continue
        a = part.view(f"<u{width}").ravel().astype("<u8")
        out.append(((a >> 1) ^ -(a & 1)).view("<i8") if kind >> 8 else a.view("<i8"))
    return out


def _steps(a: np.ndarray) -> np.ndarray:
    return np.diff(a, prepend=0)


_CODED = ("chunk long, doc_id array<long>, held array<boolean>, size array<long>, line binary, "
          "words binary, times binary, deal binary, trained long, documents long")
_STATE = "chunk long, doc_id array<long>, held array<boolean>, size array<long>, line binary, known binary, answers array<binary>"
_KINDS = {
    "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64(),
    "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_()), "array<binary>": pa.list_(pa.binary()),
}
_REQUEST = "bucket int, chunk long, data binary"
_WORDS = "bucket int, chunk long, words binary, times binary"
_REPLY = "chunk long, bucket int, length long, data binary"


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = zip(*(c.split(" ") for c in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, k in zip(zip(*rows), kinds)], names=list(names))


def _split(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts (A-Z lowered, as bytes), and their number in each text."""
    whole = text.take(pa.array(np.arange(len(text))))  # Arrow lowers a slice by the offsets of the array it is cut from
    parts = pc.ascii_split_whitespace(pc.ascii_lower(whole.cast(pa.large_string())))
    words, sizes = parts.flatten(), pc.list_value_length(parts).to_numpy()
    some = pc.binary_length(words).to_numpy() > 0
    if not some.all():
        words = words.filter(pa.array(some))
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[some], minlength=len(sizes))
    return words.cast(pa.large_binary()), sizes.astype(np.int64)


def _chunked(docs: DataFrame) -> DataFrame:
    """One row a chunk: its documents, as places in the chunk's own list of words, sorted by CRC-32.

    ``times`` are the words' training counts, ``deal`` their CRC-32; START and END are places 1 and 0
    and words follow. ``trained`` and ``documents`` are the training tokens (ends too) and documents.
    """
    divisor, rest = HELD_OUT
    most = CHUNK_BYTES
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.pmod(doc_hash(), F.lit(divisor)) == rest).alias("held_out"),
        F.coalesce("text", F.lit("")).alias("text"),
    )

    def send(chunk: int, parts: list[tuple]) -> pa.RecordBatch:
        doc_id, held = (pa.chunked_array([p[i] for p in parts]).to_pylist() for i in (0, 1))
        size = np.concatenate([p[3] for p in parts]) + 2
        coded = pa.chunked_array([p[2] for p in parts]).combine_chunks().dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        words = coded.dictionary.to_pylist()
        deal = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
        order = np.argsort(deal, kind="stable")
        moved = np.empty(len(words), np.int64)
        moved[order] = np.arange(2, len(words) + 2)
        line = np.full(int(size.sum()), -1, np.int64)
        ends = np.cumsum(size)
        line[ends - size], line[ends - 1] = START, END
        line[line < 0] = moved[coded.indices.to_numpy()]
        train = ~np.array(held, bool)
        times = np.bincount(line[np.repeat(train, size)], minlength=len(words) + 2)[2:]
        return _batch(_CODED, [(
            chunk, doc_id, held, size.tolist(), _pack(line), b"\n".join([words[i] for i in order.tolist()]), _pack(times),
            _pack(_steps(deal[order])), int((size[train] - 1).sum()), int(train.sum()),
        )])

    def run(batches):
        chunk, read, parts = TaskContext.get().partitionId() << 33, 0, []
        for batch in batches:
            text = batch.column(2)
            until, start = np.cumsum(pc.binary_length(text).to_numpy().astype(np.int64)), 0
            while start < len(until):
                before = until[start - 1] if start else 0
                end = min(int(np.searchsorted(until, before + most - read, "right")) + 1, len(until))
                parts.append((*(batch.column(i).slice(start, end - start) for i in (0, 1)), *_split(text.slice(start, end - start))))
                read += int(until[end - 1] - before)
                start = end
                if read > most:
                    yield send(chunk, parts)
                    chunk, read, parts = chunk + 1, 0, []
        if parts:
            yield send(chunk, parts)

    return stored(rows.mapInArrow(run, _CODED))


def _requests(buckets: int):
    """Rows (bucket, chunk, words, times): the words of each chunk, dealt to buckets."""

    def run(batches):
        for batch in batches:
            for chunk, words, times, deal in zip(*(c.to_pylist() for c in batch.columns)):
                (counts,), (steps,) = _unpack(times), _unpack(deal)
                if not len(counts):
                    continue
                own, bucket = words.split(b"\n"), np.cumsum(steps) * buckets >> 32
                yield _batch(_WORDS, [
                    (int(bucket[a]), chunk, b"\n".join(own[a:b]), _pack(counts[a:b])) for a, b in _runs(bucket)
                ])

    return run


def _runs(bucket: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where each bucket's part of the sorted ``bucket`` starts and ends."""
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]).tolist() if len(bucket) else []
    return zip(starts, [*starts[1:], len(bucket)])


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """For rows sorted by their first column, the bucket: each bucket with the rest of its rows."""
    bucket, held = None, []
    for batch in batches:
        for now, *rest in zip(*(c.to_pylist() for c in batch.columns)):
            if now != bucket:
                if held:
                    yield bucket, held
                bucket, held = now, []
            held.append(rest)
    if held:
        yield bucket, held


def _number(buckets: int):
    """For requests sorted by bucket: the sums and numbers of the words, a row a request.

    Words of held-out documents alone have no count and are not in the model: their number is -1.
    Frequent words have the small numbers of a bucket. One more row (chunk null) has the number of the
    bucket's words as its length.
    """

    def run(batches):
        for bucket, held in _held(batches):
            total: dict[bytes, int] = {}
            get = total.get
            for _, words, times in held:
                for w, c in zip(words.split(b"\n"), _unpack(times)[0].tolist()):
                    total[w] = get(w, 0) + c
            known = sorted((-c, w) for w, c in total.items() if c)
            place = {w: 2 + bucket + buckets * i for i, (_, w) in enumerate(known)}
            yield _batch(_REPLY, [(None, bucket, len(known), b"")])
            for chunk, words, _ in held:
                own = words.split(b"\n")
                counts = np.array([total[w] for w in own], np.int64)
                ids = np.array([place.get(w, -1) for w in own], np.int64)
                yield _batch(_REPLY, [(chunk, bucket, len(own), _pack(counts, ids))])

    return run


# --- the automaton --------------------------------------------------------------------------------


class Automaton:
    """The definition of the model, in one place. States are contexts, 0 is the root.

    Weights are base-10 logarithms. ``score_documents`` gives the same scores from parts.
    """

    def __init__(self, ids: dict[bytes, int], counts: list[int], tokens: int, kinds: int):
        self.ids = ids
        self.denominator = tokens + kinds + 1
        self.unigram = [(c + 1) / self.denominator for c in counts]
        self.unigram[START] = 0.0
        self.states: dict[tuple[int, ...], int] = {(): 0}
        self.arcs: list[dict[int, float]] = [{}]
        self.back = [0.0]
        self.failure = [0]
        self.names: list[tuple[int, ...]] = [()]
        self.memo: dict[tuple[int, int], tuple[float, int]] = {}

    def probability(self, state: int, word: int) -> float:
        weight = 1.0
        while state:
            if word in self.arcs[state]:
                return weight * self.arcs[state][word]
            weight *= self.back[state]
            state = self.failure[state]
        return weight * self.unigram[word]

    def add(self, context: tuple[int, ...], total: int, followers: dict[int, int]) -> None:
        """A state for a context seen ``total`` times. Shorter contexts come first."""
        shorter = next(self.states[context[i:]] for i in range(1, len(context) + 1) if context[i:] in self.states)
        arcs = {w: (n - DISCOUNT) / total for w, n in followers.items()}
        rest = 1 - sum(self.probability(shorter, w) for w in arcs)
        self.states[context] = len(self.names)
        self.names.append(context)
        self.arcs.append(arcs)
        self.failure.append(shorter)
        self.back.append(max(1 - sum(arcs.values()), 1e-12) / max(rest, 1e-12) if arcs else 1.0)

    def finish(self) -> None:
        """What a word without arcs costs from each state, and where the walk begins."""
        self.to_root = [0.0] * len(self.names)
        for s in range(1, len(self.names)):
            self.to_root[s] = math.log10(self.back[s]) + self.to_root[self.failure[s]]
        self.start = self.states.get((START,), 0)

    def step(self, state: int, word: int) -> tuple[float, int]:
        """Weight of a frequent word beyond its unigram, and the state behind it."""
        if (state, word) not in self.memo:
            gain = math.log10(self.probability(state, word) / self.unigram[word])
            name = (*self.names[state], word)
            after = next(self.states[name[i:]] for i in range(len(name) + 1) if name[i:] in self.states)
            self.memo[state, word] = gain, after
        return self.memo[state, word]

    def gain(self, words: list[bytes]) -> float:
        """log10 of the model's probability over the unigram's, for words and the end."""
        total, state = 0.0, self.start
        get, step, to_root = self.ids.get, self.step, self.to_root
        for w in words:
            number = get(w)
            if number is None:
                if state:
                    total += to_root[state]
                    state = 0
            else:
                more, state = step(state, number)
                total += more
        return total + step(state, END)[0]


# --- the automaton in parts ----------------------------------------------------------------------


def _words_known(row: dict, replies: list[bytes], documents: int) -> dict:
    """A coded chunk with the counts and numbers of its words, which it is then written in, by number.

    Words that are not in the model are one place, the last, of count 0 and number -1.
    """
    (line,), answers = _unpack(row["line"]), [_unpack(r) for r in replies]
    counts, ids = (np.concatenate([first, *(a[i] for a in answers)]) for i, first in ((0, [documents] * 2), (1, [END, START])))
    ids = np.where(counts > 0, ids, -1)
    ids[[END, START]] = END, START
    order = np.argsort(ids, kind="stable")
    order = order[ids[order] >= 0]
    moved = np.full(len(ids), len(order), np.int64)
    moved[order] = np.arange(len(order))
    return row | {"line": _pack(moved[line]), "known": _pack(counts[order], _steps(ids[order])), "answers": []}


class _Chunk:
    """One chunk's n-grams, order by order, with what the buckets have answered so far.

    ``at`` are its tokens but the start marks, as places in ``line``; ``word`` their places in the
    chunk's words. For the last order done: ``p`` is each token's probability, ``gram`` the place of
    its n-gram among the chunk's (-1 for none), ``n`` and ``total`` the n-grams' and contexts' counts,
    ``ids`` the n-grams' numbers.
    """

    def __init__(self, row: dict, model: tuple):
        tokens, documents, kinds, self.buckets, self.hot = model
        self.denominator = tokens + kinds + 1
        self.doc_id, self.held, self.size = row["doc_id"], np.array(row["held"], bool), np.array(row["size"], np.int64)
        (self.line,), (counts, steps) = _unpack(row["line"]), _unpack(row["known"])
        counts, self.words = np.append(counts, 0), np.append(np.cumsum(steps), -1)
        self.at = np.flatnonzero(self.line != START)
        self.word = self.line[self.at]
        self.train = np.repeat(~self.held, self.size)[self.at]
        # Order 1: every word of the model is a context, the start mark too.
        self.n, self.ids, self.total = counts, np.where(counts > 0, self.words, -1), np.zeros_like(counts)
        self.gram = self.word
        self.base = self.p = (counts[self.word] + 1) / self.denominator
        self.order = 1
        for answer in row["answers"]:
            self.ask()
            self.take(*_unpack(answer))

    def ask(self) -> None:
        """The distinct n-grams of the next order, sorted by bucket, context and last word."""
        before = np.full(len(self.line), -1, np.int64)
        before[self.at] = self.gram
        if self.order == 1:
            before[self.line == START] = START
        context = before[self.at - 1]
        numbers = np.append(self.ids, -1)  # the last for tokens without an n-gram, -1
        self.good = numbers[context] >= 0
        # Only an n-gram whose end is an arc of the order before can be one.
        may = (numbers[self.gram] >= 0)[self.good]
        width = len(self.words) + 1
        keys = context[self.good] * width + np.where(may, self.word[self.good], width - 1)
        del before, context
        order = np.argsort(keys)
        keys = keys[order]
        new = np.r_[True, keys[1:] != keys[:-1]] if len(keys) else np.zeros(0, bool)
        place = np.empty(len(keys), np.int64)
        place[order] = np.cumsum(new) - 1
        found, first = keys[new], order[new]
        del keys, order, new
        times = np.bincount(place[(self.train[self.good] & may)], minlength=len(found))
        of, last, end = found // width, found % width, self.gram[self.good][first]
        none = last == width - 1
        last = np.where(none, -1, np.append(self.words, -1)[last])
        # By bucket, in which contexts and last words stay sorted; each run of a context is a group.
        bucket = self._bucket(self.ids[of], last, self.n[of])
        by = np.argsort(bucket.astype(np.uint16) if self.buckets < 1 << 16 else bucket, kind="stable")
        moved = np.empty(len(by), np.int64)
        moved[by] = np.arange(len(by))
        self.place, of, end, self.none = moved[place], of[by], end[by], none[by]
        self.last, self.times, self.bucket = last[by], times[by], bucket[by]
        self.new_total, self.context = self.n[of], self.ids[of]
        self.lower_n, self.lower_total = self.n[end], self.total[end]
        start = np.r_[True, (of[1:] != of[:-1]) | (self.bucket[1:] != self.bucket[:-1])] if len(of) else np.zeros(0, bool)
        self.group, self.first = np.cumsum(start) - 1, np.flatnonzero(start)

    def _bucket(self, context: np.ndarray, last: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Words are dealt anew; the n-grams of a longer context stay where the context was numbered."""
        odd, shift, buckets = np.uint64(0x9E3779B97F4A7C15), np.uint64(32), np.uint64(self.buckets)
        key = context.astype(np.uint64) * odd
        bucket = (key >> shift) % buckets if self.order == 1 else context.astype(np.uint64) % buckets
        hot = total > self.hot
        bucket[hot] = (((key[hot] ^ last[hot].astype(np.uint64)) * odd) >> shift) % buckets
        return bucket.astype(np.int64)

    def requests(self) -> Iterator[tuple[int, bytes]]:
        """To each bucket: its contexts once, with followers and counts, and the n-grams of each."""
        real = ~self.none
        step = _steps(self.last)
        step[self.first] = self.last[self.first]
        followers = np.bincount(self.group[real], minlength=len(self.first))
        for a, b in _runs(self.bucket):
            g = slice(int(self.group[a]), int(self.group[b - 1]) + 1)
            first, own = self.first[g], np.arange(a, b)[real[a:b]]
            lower = (self.lower_n, self.lower_total)[: self.order]
            yield int(self.bucket[a]), _pack(
                _steps(self.context[first]), followers[g], self.new_total[first],
                step[own], self.times[own], *(c[own] for c in lower),
            )

    def gather(self, replies: list[bytes], hot: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
        """The buckets' answers, by bucket, as one, with the failure weights of hot contexts."""
        parts = [_unpack(r) for r in replies]
        n, ids, has, back = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, t)
                             for i, t in enumerate((np.int64, np.int64, np.int64, float)))
        if len(parts):
            # Numbers are steps from bucket to bucket as within one.
            lengths = [len(p[1]) for p in parts]
            sums = [np.cumsum(p[1]) for p in parts]
            ids = _steps(np.concatenate(sums)) if sum(lengths) else ids
        if len(hot[0]):
            context = self.context[self.first]
            at = np.minimum(np.searchsorted(hot[0], context), len(hot[0]) - 1)
            is_hot = hot[0][at] == context
            weight = np.ones(len(has))
            weight[has > 0] = back
            weight[is_hot] = hot[1][at[is_hot]]
            has = (has > 0) | is_hot
            back = weight[has]
        return [n, ids, has.astype(np.int64), back]

    def take(self, n: np.ndarray, steps: np.ndarray, has: np.ndarray, back: np.ndarray) -> None:
        """Take the answers in: probabilities of the order asked for last."""
        count, weight = np.zeros(len(self.none), np.int64), np.ones(len(self.first))
        count[~self.none] = n
        weight[has > 0] = back
        arc, ids = count > 0, np.full(len(count), -1, np.int64)
        if len(steps):
            ids[arc] = np.cumsum(steps)
        p, gram = self.p.copy(), np.full(len(self.at), -1, np.int64)
        arcs = (count - DISCOUNT) / np.maximum(self.new_total, 1)
        p[self.good] = np.where(arc[self.place], arcs[self.place], weight[self.group][self.place] * self.p[self.good])
        gram[self.good] = self.place
        self.p, self.gram, self.n, self.ids, self.total = p, gram, count, ids, self.new_total
        self.order += 1


def _failure(arcs: np.ndarray, lower: np.ndarray) -> np.ndarray:
    return np.maximum(1 - arcs, 1e-12) / np.maximum(1 - lower, 1e-12)


def _answer(order: int, model: tuple):
    """For rows sorted by bucket: its requests' sums, numbers and failure weights, a row a request.

    One more row (chunk null) has the partial sums of the bucket's contexts over ``HOT``. A bucket's
    n-grams are bounded by ``GRAM_TOKENS`` and ``HOT`` on average. Numbers are not sent for the last order.
    """
    tokens, _, kinds, buckets, most = model
    denominator, last_order = tokens + kinds + 1, ORDER

    def solve(bucket: int, held: list[tuple[int, bytes]]) -> Iterator[tuple]:
        parts = [_unpack(data) for _, data in held]
        context = np.concatenate([np.cumsum(p[0]) for p in parts])
        followers, total, step, times, *below = (np.concatenate(c) for c in list(zip(*parts))[1:])
        groups, entries = [len(p[0]) for p in parts], [len(p[3]) for p in parts]
        parts.clear()
        # Last words are steps within a group, whose first is whole.
        last = np.cumsum(step)
        start = (np.cumsum(followers) - followers)[followers > 0]
        last -= np.repeat(np.where(start > 0, last[start - 1], 0), followers[followers > 0])
        known, some, rank = np.unique(context, return_index=True, return_inverse=True)
        keys = np.repeat(rank, followers) * (int(last.max(initial=0)) + 1) + last
        by = np.argsort(keys)
        keys = keys[by]
        new = np.r_[True, keys[1:] != keys[:-1]] if len(keys) else np.zeros(0, bool)
        place = np.empty(len(by), np.int64)
        place[by] = np.cumsum(new) - 1
        first = by[new]
        n = np.bincount(place, weights=times, minlength=len(first)).astype(np.int64)
        arc = n >= LEAST
        ids = np.where(arc, bucket + buckets * (np.cumsum(arc) - 1), -1)
        at = first[arc]
        of = np.repeat(rank, followers)[at]
        total = total[some]
        if order == 2:
            lower = (below[0][at] + 1) / denominator
        else:
            lower = (below[0][at] - DISCOUNT) / below[1][at]
        arcs = np.bincount(of, weights=(n[arc] - DISCOUNT) / total[of], minlength=len(known))
        below = np.bincount(of, weights=lower, minlength=len(known))
        has = np.bincount(of, minlength=len(known)) > 0
        many = has & (total > most)
        yield (None, bucket, int(many.sum()), _pack(known[many], arcs[many], below[many]))
        has &= ~many
        back = _failure(arcs, below)
        n = np.where(arc, n, 0)
        g = e = 0
        for (chunk, _), n_groups, n_entries in zip(held, groups, entries):
            mine, own = rank[g : g + n_groups], place[e : e + n_entries]
            g, e = g + n_groups, e + n_entries
            number = _steps(ids[own][arc[own]]) if order < last_order else np.zeros(0, np.int64)
            yield chunk, bucket, 0, _pack(n[own], number, has[mine], back[mine][has[mine]])

    def run(batches):
        for bucket, held in _held(batches):
            yield _batch(_REPLY, list(solve(bucket, held)))

    return run


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column(0).to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in _unpack(data)], names=["context", "arcs", "lower"])


def _hot(answers: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Contexts over ``HOT`` that have arcs, sorted, and their failure weights: at most tokens / HOT."""
    rows = answers.where("chunk IS NULL AND length > 0").select("data").mapInArrow(
        _partial, "context long, arcs double, lower double"
    )
    found = rows.groupBy("context").agg(F.sum("arcs").alias("arcs"), F.sum("lower").alias("lower")).orderBy("context").collect()
    arcs, lower = (np.array([r[c] for r in found], float) for c in ("arcs", "lower"))
    return np.array([r["context"] for r in found], np.int64), _failure(arcs, lower)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch.column(k)[i].as_py() for k, c in enumerate(batch.schema.names)}


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[bytes]]]:
    """For rows sorted by (chunk, bucket), the chunk itself first: each chunk with its answers by bucket."""
    row, replies = None, []
    for batch in batches:
        names = batch.schema.names
        bucket, data = (batch.column(names.index(c)).to_pylist() for c in ("bucket", "data"))
        for i, k in enumerate(bucket):
            if k is not None:
                replies.append(data[i])
                continue
            if row is not None:
                yield row, replies
            row, replies = {c: batch.column(names.index(c))[i].as_py() for c in names}, []
    if row is not None:
        yield row, replies


def _state(row: dict) -> pa.RecordBatch:
    return _batch(_STATE, [tuple(row[c.split(" ")[0]] for c in _STATE.split(", "))])


def _with_words(documents: int):
    def run(batches):
        for row, replies in _answered(batches):
            yield _state(_words_known(row, replies, documents))

    return run


def _with_answers(model: tuple, shared):
    def told(row: dict, replies: list[bytes]) -> bytes:
        chunk = _Chunk(row, model)
        chunk.ask()
        return _pack(*chunk.gather(replies, shared.value))

    def run(batches):
        for row, replies in _answered(batches):
            yield _state(row | {"answers": [*row["answers"], told(row, replies)]})

    return run


def _ask(model: tuple):
    def asked(row: dict) -> list[tuple]:
        chunk = _Chunk(row, model)
        chunk.ask()
        return [(bucket, row["chunk"], data) for bucket, data in chunk.requests()]

    def run(batches):
        for row in _rows(batches):
            if sent := asked(row):
                yield _batch(_REQUEST, sent)

    return run


def _score(model: tuple, shared):
    """Scores of every document, from its chunk with all answers."""

    def scores(row: dict, replies: list[bytes]) -> list[tuple]:
        chunk = _Chunk(row, model)
        chunk.ask()
        chunk.take(*chunk.gather(replies, shared.value))
        ends = np.cumsum(chunk.size - 1)
        base, score = np.log10(chunk.base), np.log10(chunk.p)
        known = np.r_[0, np.cumsum(chunk.base * chunk.denominator > 1.5)]
        return [
            (doc_id, held, b - a, int(known[b] - known[a]), math.fsum(base[a:b]), math.fsum(score[a:b]))
            for doc_id, held, a, b in zip(chunk.doc_id, chunk.held.tolist(), (ends - chunk.size + 1).tolist(), ends.tolist())
        ]

    def run(batches):
        for row, replies in _answered(batches):
            yield _batch(_SCORES, scores(row, replies))

    return run


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _met(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    """Chunks with the answers to each, sorted by chunk and bucket, the chunk first."""
    none = F.lit(None)
    rows = chunks.select(none.cast("int").alias("bucket"), none.cast("binary").alias("data"), "*")
    more = answers.where("chunk IS NOT NULL").select(
        "bucket", "data", "chunk", *[none.cast(f.dataType).alias(f.name) for f in chunks.schema.fields if f.name != "chunk"]
    )
    return rows.unionByName(more).repartition("chunk").sortWithinPartitions("chunk", F.col("bucket").asc_nulls_first())


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Learns from rows with crc32(doc_id as text) mod 7 other than 2; a null doc_id counts as empty text
    there. A null text is empty and has the end token alone. Repeated rows count as often as they
    occur. A very long text is in one chunk, which is that much larger. Other columns are ignored, an empty
    table gives no rows. With nothing to learn from, every
    token has probability 1 over (0 + 0 + 1).
    """
    spark = docs.sparkSession

    def by_bucket(requests: DataFrame, answer) -> DataFrame:
        return stored(requests.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(answer, _REPLY))

    chunked = _chunked(docs)
    sums = chunked.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("trained", "documents")]).first()
    tokens, documents = int(sums[0]), int(sums[1])
    buckets = max(GRAM_BUCKETS, tokens // GRAM_TOKENS)
    asked = chunked.select("chunk", "words", "times", "deal").mapInArrow(_requests(buckets), _WORDS)
    answers = by_bucket(asked, _number(buckets))
    words = answers.where("chunk IS NULL").agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    model = (tokens, documents, int(words) + (documents > 0), buckets, HOT)
    # Each step's tables are deleted once the next table of chunks, which holds what they say, is written.
    coded = chunked.drop("words", "times", "deal", "trained", "documents")
    chunks = stored(_met(coded, answers).mapInArrow(_with_words(documents), _STATE))
    discard(chunked, answers)
    for order in range(2, ORDER + 1):
        answers = by_bucket(chunks.mapInArrow(_ask(model), _REQUEST), _answer(order, model))
        shared = spark.sparkContext.broadcast(_hot(answers))
        if order < ORDER:
            before = chunks
            chunks = stored(_met(before, answers).mapInArrow(_with_answers(model, shared), _STATE))
            discard(before, answers)
    scored = _met(chunks, answers).mapInArrow(_score(model, shared), _SCORES)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
