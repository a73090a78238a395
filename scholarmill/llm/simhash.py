"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most ``radius`` bits apart have a common variant within half the radius of each, and
any two fingerprints that share such a variant are at most ``radius`` apart. So every distinct
fingerprint stands for all of its variants (2,081 with 64 bits and half radius 2), and variants that
coincide are links.

The shuffle deals variants by their first ``ROUTE_BITS`` bits. A fingerprint goes once to each value
that some of its variants begin with (79 with 12 bits), with the flips that are left for the other
bits; the variants themselves are written out only inside the task that owns their prefix, where equal
ones meet. Prefixes with many fingerprints are worked off in parts by further bits, so memory is bounded
by the fingerprints of one prefix plus a fixed number of variants. From each task only a spanning forest
of its links leaves, never all pairs of a group; connected components join the forests.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.llm.common import keep_rows, text_sha
from scholarmill.session import stored

BITS = 64
RADIUS = 4
SHINGLE = 4
SEED = 42
ROUTE_BITS = 12
#: Variants held at once in a task.
VARIANTS = 1 << 21
#: Bytes of text split into words at once.
CHUNK = 1 << 20
_SPACE = b" \t\n\x0b\x0c\r"


def _word_lists(data: bytes) -> Iterator[list[bytes]]:
    """The words of ``data`` in lists of bounded size, cut between words."""
    start, n = 0, len(data)
    while n - start > CHUNK:
        cut = start + CHUNK
        while cut < n and data[cut] not in _SPACE:
            cut += 1
        yield data[start:cut].split()
        start = cut
    yield data[start:].split()


def simhash(text: str, k: int = SHINGLE) -> int:
    """64 majority bits over the XXH64 hashes of all word k-grams; 0 without words.

    Only A-Z are lowered; words are separated by space, tab, line feed, vertical tab, form feed and
    carriage return. With fewer than k words the whole sequence is the one shingle.
    """
    ones, total = np.zeros(BITS, np.int64), 0
    carry: list[bytes] = []
    digest = xxhash.xxh64_digest
    for more in _word_lists(text.encode("utf-8", "surrogatepass").lower()):
        words = carry + more
        if len(words) >= k:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = [0, *(ends[:-1] + 1).tolist()]
            found = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1 :].tolist())]
            bits = np.unpackbits(np.frombuffer(b"".join(found), np.uint8)).reshape(-1, BITS)
            ones += bits.sum(axis=0, dtype=np.int64)
            total += len(found)
        carry = words[-(k - 1) :]
    if not total:
        if not carry:
            return 0
        return int.from_bytes(digest(b" ".join(carry), SEED), "big")
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id, sha (SHA-256 of the text) and fp (the 64 bits as a long) of every row."""

    def run(batches):
        for batch in batches:
            found = [simhash(t.as_py(), k) for t in batch.column(2)]
            fp = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], fp], names=["doc_id", "sha", "fp"])

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_sha().alias("sha"), F.coalesce("text", F.lit("")).alias("text")
    )
    return rows.mapInArrow(run, "doc_id long, sha binary, fp long")


def _masks(bits: int, flips: int) -> np.ndarray:
    """All masks over the low ``bits`` bits with at most ``flips`` ones."""
    return np.array(
        [sum(1 << b for b in at) for n in range(min(flips, bits) + 1) for at in combinations(range(bits), n)],
        np.uint64,
    )


def _coinciding(fp: np.ndarray, base: np.ndarray, left: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray]:
    """Variants that several of ``fp`` share: the variants, sorted, and the places of their owners."""
    parts = [(np.flatnonzero(left == r), _masks(low, r)) for r in np.unique(left)]
    values = np.concatenate([(base[at][:, None] ^ masks).ravel() for at, masks in parts])
    ordered = np.sort(values)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return twice, np.zeros(0, np.int64)
    shift, odd = np.uint64(BITS - 20), np.uint64(0x9E3779B97F4A7C15)
    seen = np.zeros(1 << 20, bool)
    seen[(twice * odd) >> shift] = True
    at = np.flatnonzero(seen[(values * odd) >> shift])
    at = at[twice[np.minimum(np.searchsorted(twice, values[at]), len(twice) - 1)] == values[at]]
    owner = np.concatenate([np.repeat(rows, len(masks)) for rows, masks in parts])[at]
    order = np.argsort(values[at], kind="stable")
    return values[at][order], owner[order]


def _forest(fp: np.ndarray, shared: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (smallest of the group, member) that connect all fingerprints sharing variants."""
    nodes, member = np.unique(fp[owner], return_inverse=True)
    starts = np.flatnonzero(np.r_[True, shared[1:] != shared[:-1]])
    sizes = np.diff(np.r_[starts, len(shared)])
    label = np.arange(len(nodes))
    while True:
        least = np.minimum.reduceat(label[member], starts)
        new = label.copy()
        np.minimum.at(new, member, np.repeat(least, sizes))
        new = new[new]
        if (new == label).all():
            break
        label = new
    child = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[label[child]], nodes[child]


def _solve(fp, base, left, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Forests over the variants whose first ``depth`` bits are those of ``base``.

    ``left`` flips remain for the other bits. Too many variants for one go are split by the next bits.
    """
    low = BITS - depth
    counts = np.array([1, 1 + low, 1 + low + low * (low - 1) // 2])[left]
    if counts.sum() > VARIANTS and low > 8 and len(fp) > 1:
        shift = np.uint64(low - 4)
        own = (base >> shift) & np.uint64(15)
        for value in range(16):
            flips = np.bitwise_count(own ^ np.uint64(value)).astype(np.int64)
            at = np.flatnonzero(flips <= left)
            if len(at) > 1:
                moved = base[at] ^ ((own[at] ^ np.uint64(value)) << shift)
                yield from _solve(fp[at], moved, left[at] - flips[at], depth + 4)
        return
    shared, owner = _coinciding(fp, base, left, low)
    if len(shared):
        yield _forest(fp, shared, owner)


def _runs(weights: np.ndarray, limit: int) -> Iterator[slice]:
    """Consecutive groups of ``weights`` that sum to ``limit`` or are one element."""
    start, total = 0, 0
    for i, w in enumerate(weights.tolist()):
        if total and total + w > limit:
            yield slice(start, i)
            start, total = i, 0
        total += w
    if len(weights):
        yield slice(start, len(weights))


def _match(route_bits: int, half: int):
    low = BITS - route_bits
    size = np.array([1, 1 + low, 1 + low + low * (low - 1) // 2])

    def solve(fp: np.ndarray, bucket: np.ndarray) -> Iterator[pa.RecordBatch]:
        """All of some buckets, in the order of buckets."""
        shift = np.uint64(low)
        value = bucket.astype(np.uint64)
        flips = np.bitwise_count((fp >> shift) ^ value).astype(np.int64)
        base, left = (fp & np.uint64((1 << low) - 1)) | (value << shift), half - flips
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        ends = np.r_[starts[1:], len(bucket)]
        for some in _runs(np.add.reduceat(size[left], starts), VARIANTS):
            at = slice(starts[some][0], ends[some][-1])
            for a, b in _solve(fp[at], base[at], left[at], route_bits):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fps, buckets, held, last = [], [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            fp = batch.column(0).to_numpy().view(np.uint64)
            bucket = batch.column(1).to_numpy()
            last = bucket[-1]
            fps.append(fp)
            buckets.append(bucket)
            held += len(fp)
            if held >= 1 << 17 and buckets[0][0] != last:
                fp, bucket = np.concatenate(fps), np.concatenate(buckets)
                cut = np.searchsorted(bucket, last)
                yield from solve(fp[:cut], bucket[:cut])
                fps, buckets, held = [fp[cut:]], [bucket[cut:]], len(fp) - cut
        if held:
            yield from solve(np.concatenate(fps), np.concatenate(buckets))

    return run


def links(distinct: DataFrame, radius: int = RADIUS, route_bits: int = ROUTE_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` whose components are those of all pairs at
    most ``radius`` bits apart. ``radius`` is 2 or 4 (an odd one has no middle)."""
    half = radius // 2
    masks = [int(m) for m in _masks(route_bits, half)]
    first = F.shiftrightunsigned("fp", BITS - route_bits).cast("int")
    flipped = distinct.select("fp", F.explode(F.array(*[F.lit(m) for m in masks])).alias("mask"))
    routed = flipped.select("fp", first.bitwiseXOR(F.col("mask")).alias("bucket"))
    met = routed.repartition("bucket").sortWithinPartitions("bucket")
    return met.mapInArrow(_match(route_bits, half), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node it is connected with) of every node of ``edges`` but roots.

    Alternating large-star and small-star steps; each round's links are written to the shared folder,
    which cuts the lineage. Nothing is collected but a count and a checksum.
    """
    edges = stored(edges.where("a <> b").distinct())
    before = None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("b"), F.col("m").alias("a"))
        # Small star: every node points at its smaller neighbours; it and they move to the smallest.
        down = large.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
        lowest = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(lowest, "u").where("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))
            .unionByName(lowest.select(F.col("m").alias("a"), F.col("u").alias("b")))
            .distinct()
        )
        edges = stored(small)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        before = now


def _grouped(docs: DataFrame, radius: int, k: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, sha, fp), and fp with root and component_id."""
    marked = stored(fingerprints(docs, k))
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(links(distinct.select("fp"), radius))
    rooted = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    # Stored tables on both sides of a join: adaptive execution splits hot keys of plain shuffles.
    groups = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    return marked, stored(rooted.join(groups, "root").select("fp", "root", "component_id"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, k: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    Null texts count as empty; texts without words have fingerprint 0, which links like any other.
    Repeated rows stay repeated. component_id is the smallest doc_id that is not null among all rows
    reachable by links (null if there is none). Very long texts are hashed whole, in pieces of bounded
    size. Other columns are ignored; an empty table gives no rows.
    """
    marked, named = _grouped(docs, radius, k)
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, radius: int = RADIUS, k: int = SHINGLE) -> DataFrame:
    """One row of each component of ``docs``, with all columns: the one with the smallest doc_id.

    A null doc_id comes after all others. Ties go to the smallest SHA-256 of the text; of rows that
    are equal in both, one stays. Null, empty and very long texts as in ``near_duplicates``. Columns may
    have any names; an empty table gives no rows.
    """
    marked, named = _grouped(docs, radius, k)
    rows = marked.groupBy("doc_id", "sha", "fp").agg(F.count("*").alias("copies"))
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "sha", "copies")
    best = rows.join(named, "fp").groupBy("root").agg(F.min(place).alias("best"))
    return keep_rows(docs, best.select("best.doc_id", "best.sha", "best.copies"))
