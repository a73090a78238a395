"""Near-duplicate texts: several SimHash fingerprints, met in the middle, and every pair verified.

One fingerprint of many bits rarely differs by only a few between texts that are four fifths alike, so a
text has ``BANDS`` independent ones of ``BITS`` bits over its five-word shingles. Two texts are candidates
if in some band their fingerprints share a variant with at most one flipped bit, that is, if they are at
most two bits apart there. Of the texts of one shared variant the first is the candidate of the others,
so candidates grow with the texts and not with the pairs. Those whose bands together differ too much are
dropped, and of the others the Jaccard similarity of the shingle sets is computed: only verified pairs are
links. The bands are worked off in rounds, a few first: they connect most of a group, and in the other bands only
texts that are not yet connected are candidates, so a group costs a few pairs a text though its members share
hundreds of variants. Within a round, too, each text meets one candidate and then those that are not yet connected
meet. Two texts at 0.8 are a candidate in nine cases of ten, closer ones more often.

Equal fingerprints of a band are put together first, and what is dealt by the first bits of variants is
one row for each distinct fingerprint, with as many buckets as the number of texts asks for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarmill.llm.common import keep_rows, text_sha
from scholarmill.llm.simhash import SEED, _coinciding, _masks, _word_lists, components
from scholarmill.session import stored

SHINGLE, SIMILAR = 5, 0.8
BANDS, BITS = 24, 32
#: The bands after the last of each round.
ROUNDS = (3, BANDS)
_LONGS = BANDS * BITS // 64
#: Distinct fingerprints of a band in one bucket, on average.
PER_BUCKET = 1 << 15
#: Variants held at once in a task.
VARIANTS = 1 << 21
#: Share of differing bits over all bands from which a candidate is not looked at: what two texts of 0.8
#: and of like length differ by, and four standard deviations more.
_ANGLE = math.acos(2 * SIMILAR / (1 + SIMILAR)) / math.pi
FAR = _ANGLE + 4 * math.sqrt(_ANGLE * (1 - _ANGLE) / (BANDS * BITS))


def shingle_hashes(text: str, k: int = SHINGLE) -> np.ndarray:
    """Distinct XXH64 hashes of a text's word k-grams, sorted; words as in ``simhash``.

    With fewer than k words the whole sequence is the one shingle, also without any word.
    """
    carry: list[bytes] = []
    found: list[np.ndarray] = []
    digest = xxhash.xxh64_digest
    for more in _word_lists(text.encode("utf-8", "surrogatepass").lower()):
        words = carry + more
        if len(words) >= k:
            joined = b" ".join(words)
            ends = np.fromiter(accumulate(map(len, words)), np.int64, len(words)) + np.arange(len(words))
            spans = zip([0, *(ends[:-k] + 1).tolist()], ends[k - 1 :].tolist())
            raw = b"".join([digest(joined[a:b], SEED) for a, b in spans])
            found.append(np.unique(np.frombuffer(raw, ">u8").astype(np.uint64)))
        carry = words[-(k - 1) :]
    if not found:
        return np.array([xxhash.xxh64_intdigest(b" ".join(carry), SEED)], np.uint64)
    return np.unique(np.concatenate(found))


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """``_LONGS`` independent numbers for every hash."""
    x = hashes + np.arange(1, _LONGS + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """Majority bits of all bands, as ``_LONGS`` numbers."""
    ones = np.zeros((_LONGS, 64), np.int64)
    for at in range(0, len(hashes), 1 << 14):
        mixed = _mixed(hashes[at : at + (1 << 14)])
        bits = np.unpackbits(mixed.view(np.uint8).reshape(_LONGS, -1, 8), axis=2)
        ones += bits.sum(axis=1, dtype=np.uint16)
    return np.packbits(2 * ones > len(hashes), axis=1).view(">u8").ravel().astype(np.uint64)


def _marked(docs: DataFrame) -> DataFrame:
    """doc_id, sha (SHA-256 of the text) and the fingerprint (array of long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [wide_fingerprint(shingle_hashes(t.as_py())).view(np.int64) for t in batch.column(2)]
            fps = pa.array(found, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], fps], names=["doc_id", "sha", "fps"])

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_sha().alias("sha"), F.coalesce("text", F.lit("")).alias("text")
    )
    return rows.mapInArrow(run, "doc_id long, sha binary, fps array<long>")


def _candidates(route_bits: int):
    """For rows (bucket, value, n, root) sorted by bucket: candidate pairs (a, b), a < b, of different roots.

    A text without links has root -1.
    """
    low = BITS - route_bits

    def solve(bucket: np.ndarray, value: np.ndarray, n: np.ndarray, root: np.ndarray) -> Iterator[pa.RecordBatch]:
        prefix = (bucket & ((1 << route_bits) - 1)).astype(np.uint64)
        left = 1 - np.bitwise_count((value >> np.uint64(low)) ^ prefix).astype(np.int64)
        # The bucket in front keeps the variants of different buckets apart.
        base = (value & np.uint64((1 << low) - 1)) | (bucket.astype(np.uint64) << np.uint64(low))
        root = np.where(root < 0, n, root)
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        sizes = np.add.reduceat(1 + left * low, starts)
        for first, last in _some(sizes):
            at = slice(starts[first], starts[last] if last < len(starts) else len(bucket))
            shared, owner = _coinciding(n[at], base[at], left[at], low)
            if len(shared):
                yield from _linked(shared, n[at][owner], root[at][owner])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy() for c in batch.columns]
            held.append((columns[0], columns[1].view(np.uint64), *columns[2:]))
            size += batch.num_rows
            last = columns[0][-1]
            if size >= 1 << 17 and held[0][0][0] != last:
                rows = [np.concatenate(c) for c in zip(*held)]
                cut = np.searchsorted(rows[0], last)
                yield from solve(*(c[:cut] for c in rows))
                held, size = [tuple(c[cut:] for c in rows)], len(rows[0]) - cut
        if held:
            yield from solve(*(np.concatenate(c) for c in zip(*held)))

    return run


def _some(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Consecutive groups of about ``VARIANTS`` in all, or one that is larger by itself."""
    first, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > VARIANTS:
            yield first, i
            first, total = i, 0
        total += size
    yield first, len(sizes)


def _linked(shared: np.ndarray, n: np.ndarray, root: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Pairs of the first text of each variant with the others of another root."""
    order = np.lexsort((n, shared))
    shared, n, root = shared[order], n[order], root[order]
    new = np.r_[True, shared[1:] != shared[:-1]]
    first = np.maximum.accumulate(np.where(new, np.arange(len(n)), 0))
    pairs = np.stack([n[first], n])
    pairs = np.unique(pairs[:, root[first] != root], axis=1)
    yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])


def _banded(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(n, band, value) of ``texts`` (n, fps), and the first text and number of each (band, value)."""
    half = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.struct(
            b.alias("band"),
            F.get("fps", (b / 2).cast("int")).alias("long"),
        ),
    )
    bands = texts.select("n", F.explode(half).alias("h")).select(
        "n", F.col("h.band").alias("band"),
        F.expr(f"(h.long >> ({BITS} * (h.band % 2))) & {(1 << BITS) - 1}L").alias("value"),
    )
    bands = stored(bands)
    return bands, stored(bands.groupBy("band", "value").agg(F.min("n").alias("n"), F.count("*").alias("times")))


def _between(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs (a, b) that ``found`` (node, root) does not connect."""
    root_a = found.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    root_b = found.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    both = pairs.join(root_a, "a", "left").join(root_b, "b", "left")
    return both.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def candidates(bands: DataFrame, first: DataFrame, found: DataFrame, route_bits: int) -> DataFrame:
    """Distinct pairs (a, b) that are worth comparing and that ``found`` (node, root) does not connect."""
    # Equal fingerprints of a band: the first text stands for all, and each of the others is its candidate.
    again = first.where("times > 1").select("band", "value", F.col("n").alias("a"))
    equal = bands.join(again, ["band", "value"]).where("n > a").select("a", F.col("n").alias("b")).distinct()

    prefix = F.shiftright("value", BITS - route_bits)
    masks = [int(m) for m in _masks(route_bits, 1)]
    rooted = first.join(found.withColumnRenamed("node", "n"), "n", "left").withColumn("root", F.coalesce("root", F.lit(-1)))
    flipped = rooted.select(
        "band", "value", "n", "root", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("mask")
    )
    bucket = F.shiftleft(F.col("band").cast("long"), route_bits).bitwiseOR(prefix.bitwiseXOR(F.col("mask")))
    routed = flipped.select(bucket.alias("bucket"), "value", "n", "root")
    met = routed.repartition("bucket").sortWithinPartitions("bucket")
    return met.mapInArrow(_candidates(route_bits), "a long, b long").unionByName(_between(equal, found)).distinct()


def _apart(one: str, two: str) -> Column:
    return F.aggregate(F.zip_with(one, two, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def _hashed(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """n and the shingle hashes of the texts in ``wanted`` (n, sha)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = [shingle_hashes(t.as_py()).view(np.int64) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(pa.int64()))], names=["n", "hashes"])

    texts = docs.select(text_sha().alias("sha"), F.coalesce("text", F.lit("")).alias("text"))
    # Of equal texts one will do; rows of other texts do not travel beyond the join.
    mine = texts.join(wanted, "sha").groupBy("n").agg(F.first("text").alias("text"))
    return mine.mapInArrow(run, "n long, hashes array<long>")


def _verified(docs: DataFrame, texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose shingle sets are alike."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("n")).distinct()
    hashed = stored(_hashed(docs, texts.join(nodes, "n").select("n", "sha")))
    one = hashed.select(F.col("n").alias("a"), F.col("hashes").alias("hashes_a"))
    two = hashed.select(F.col("n").alias("b"), F.col("hashes").alias("hashes_b"))
    both = F.size(F.array_intersect("hashes_a", "hashes_b"))
    alike = both >= SIMILAR * (F.size("hashes_a") + F.size("hashes_b") - both)
    return pairs.join(one, "a").join(two, "b").where(alike).select("a", "b")


def _close(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) that are not too far apart over all bands."""
    one = texts.select(F.col("n").alias("a"), F.col("fps").alias("fps_a"))
    two = texts.select(F.col("n").alias("b"), F.col("fps").alias("fps_b"))
    near = pairs.join(one, "a").join(two, "b").where(_apart("fps_a", "fps_b") <= FAR * BANDS * BITS)
    return stored(near.select("a", "b"))


def near_pairs(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """Verified pairs (a, b) of numbers of ``texts`` (n, sha, fps) that connect what all of them would."""
    bands, first = _banded(texts.select("n", "fps"))
    route_bits = max(1, min(24, math.ceil(math.log2(max(2, first.count() / BANDS / PER_BUCKET)))))
    linked = docs.sparkSession.createDataFrame([], "a long, b long")
    start = 0
    for end in ROUNDS:
        found = components(linked)
        now = F.col("band").between(start, end - 1)
        pairs = stored(candidates(bands.where(now), first.where(now), found, route_bits))
        close = _close(texts, pairs)
        one_each = stored(close.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
        linked = stored(linked.unionByName(_verified(docs, texts, one_each)))
        # Of the others only those between texts that these links do not connect yet.
        left = _between(close, components(linked))
        tried = one_each.select(F.col("a").alias("tried_a"), F.col("b").alias("tried_b"))
        new = stored(left.join(tried, (F.col("a") == F.col("tried_a")) & (F.col("b") == F.col("tried_b")), "left_anti"))
        linked = stored(linked.unionByName(_verified(docs, texts, new)))
        start = end
    return linked


def _grouped(docs: DataFrame) -> DataFrame:
    """Distinct rows doc_id, sha, copies with the root of their group."""
    marked = stored(_marked(docs))
    distinct = marked.groupBy("sha").agg(F.first("fps").alias("fps"))
    texts = stored(distinct.withColumn("n", F.monotonically_increasing_id()))
    found = components(near_pairs(docs, texts))
    rooted = texts.select("sha", "n").join(found.withColumnRenamed("node", "n"), "n", "left")
    rooted = stored(rooted.select("sha", F.coalesce("root", "n").alias("root")))
    rows = marked.groupBy("doc_id", "sha").agg(F.count("*").alias("copies"))
    return rows.join(rooted, "sha")


def near_texts(docs: DataFrame) -> DataFrame:
    """doc_id, copies (rows with this doc_id and text) and component_id of every distinct row of ``docs``.

    Links are pairs whose sets of five-word shingles have a Jaccard similarity of 0.8 or more; equal texts
    are linked. component_id is the smallest doc_id that is not null among all rows reachable by links that
    were found (null if there is none). Null texts are empty; texts without words are equal to each other.
    Texts of any length are taken whole. Other columns are ignored, an empty table gives no rows.
    """
    rows = stored(_grouped(docs))
    named = rows.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rows.join(stored(named), "root").select("doc_id", "copies", "component_id")


def drop_near_texts(docs: DataFrame) -> DataFrame:
    """One row of each group of ``near_texts``, with all columns, whatever their names: the smallest doc_id.

    A null doc_id comes after all others. Ties go to the smallest SHA-256 of the text; of rows that are
    equal in both, one stays. An empty table gives no rows.
    """
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "sha", "copies")
    best = _grouped(docs).groupBy("root").agg(F.min(place).alias("best"))
    return keep_rows(docs, best.select("best.doc_id", "best.sha", "best.copies"))
