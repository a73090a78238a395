"""Quality classifier: logistic regression over hashed word n-grams, trained by follow the regularised leader.

A word is a run of letters, of digits or of other marks. Words and pairs of adjacent words are hashed
into ``DIMENSIONS`` weights, and repetitions of a word into two of them; a text is the vector of log(1 + count), scaled to length 1. Training runs
FTRL-proximal updates over a bounded sample of the labelled rows (``SAMPLE``, drawn by a hash of doc_id
from all of them), and a score is one sparse dot product. The model is a fixed number of weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmill.llm.common import doc_hash
from scholarmill.session import stored

DIMENSIONS = 1 << 18
#: Labelled rows that the model is fitted on, at most.
SAMPLE = 20_000
EPOCHS = 5
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.1, 1e-4
HELD_OUT = (3, 1)  # crc32(doc_id as text) mod 3 is 1
#: Bytes of a text hashed at once.
CHUNK = 1 << 20
#: Texts whose vectors are held at once.
ROWS = 256

_LETTER, _DIGIT, _MARK, _SPACE = 1, 2, 3, 0
_KIND = np.full(256, _MARK, np.uint8)
_KIND[np.arange(128, 256)] = _LETTER
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[np.arange(48, 58)] = _DIGIT
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_ODD = np.uint64(0x9E3779B97F4A7C15)
_POWER = np.uint64(0x100000001B3)
_SHIFT = np.uint64(64 - DIMENSIONS.bit_length() + 1)


def _hash_words(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word of some bytes, in order."""
    kind = _KIND[data]
    starts = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1]])
    sizes = np.diff(np.r_[starts, len(data)])
    powers = np.cumprod(np.full(int(sizes.max()), _POWER))
    place = np.arange(len(data)) - np.repeat(starts, sizes)
    sums = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * powers[place], starts)
    sums ^= sums >> np.uint64(29)
    return (sums * _ODD)[kind[starts] != _SPACE]


def _pieces(text: str) -> Iterator[np.ndarray]:
    data = text.encode("utf-8", "surrogatepass")
    start = 0
    while start < len(data):
        cut = start + CHUNK
        while cut < len(data) and _KIND[data[cut]] != _SPACE:
            cut += 1
        yield np.frombuffer(data, np.uint8, min(cut, len(data)) - start, start)
        start = cut


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a text; none for a text without words."""
    found, last = [], np.zeros(0, np.uint64)
    for piece in _pieces(text):
        words = np.r_[last, _hash_words(piece)]
        new = len(words) - len(last)
        if not new:
            continue
        pairs = words[:-1] * np.uint64(3) + words[1:]
        # Any word repeated, at once or after one other, shares a weight besides its own.
        again = np.zeros(int((words[1:] == words[:-1])[-new:].sum()), np.uint64)
        after_one = np.ones(int((words[2:] == words[:-2])[-new:].sum()), np.uint64)
        found += [words[len(last) :] >> _SHIFT, (pairs[-new:] * _ODD) >> _SHIFT, again, after_one]
        last = words[-2:]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0)
    index, counts = np.unique(np.concatenate(found).astype(np.int64), return_counts=True)
    values = np.log1p(counts)
    return index, values / max(np.linalg.norm(values), 1e-12)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, label, index and values of rows (doc_id, label, text); vectors of ``ROWS`` texts are held at once."""
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            found = [(i.astype(np.int32), v.astype(np.float32)) for i, v in (features(t.as_py()) for t in batch.column(2))]
            index = pa.array([i for i, _ in found], pa.list_(pa.int32()))
            values = pa.array([v for _, v in found], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], index, values], names=["doc_id", "label", "index", "values"])


class Ftrl:
    """FTRL-proximal with per-coordinate rates. The last weight is the bias, which is not regularised."""

    def __init__(self, size: int = DIMENSIONS):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.bias = size

    def weights(self, index: np.ndarray) -> np.ndarray:
        z, n = self.z[index], self.n[index]
        l1 = np.where(index == self.bias, 0.0, L1)
        w = -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    def update(self, index: np.ndarray, values: np.ndarray, label: int) -> None:
        index, values = np.r_[index, self.bias], np.r_[values, 1.0]
        w = self.weights(index)
        g = (1 / (1 + np.exp(-np.clip(w @ values, -35, 35))) - label) * values
        sigma = (np.sqrt(self.n[index] + g * g) - np.sqrt(self.n[index])) / ALPHA
        self.z[index] += g - sigma * w
        self.n[index] += g * g


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The model: rows (index, weight) of the weights that are not 0, at most ``DIMENSIONS`` + 1.

    Learns from labels 0 and 1 of rows that are not held out. The sample has the first ``sample`` of
    them in the order of a hash of doc_id; of a repeated doc_id the text that sorts first counts. No
    labelled row gives no weight.
    """
    divisor, rest = HELD_OUT
    drawn = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (F.pmod(doc_hash(), F.lit(divisor)) != rest))
        .distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # The sample's size is a parameter, so it may be broadcast.
    rows = texts.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))

    sparse = rows.select("doc_id", "label", "text").mapInArrow(
        _vectors, "doc_id long, label int, index array<int>, values array<float>"
    )

    def train(batches):
        held = [b for b in batches if b.num_rows]
        model = Ftrl()
        for _ in range(EPOCHS):
            for batch in held:
                labels, index, values = batch.column(1), batch.column(2), batch.column(3)
                for i in range(batch.num_rows):
                    model.update(index[i].values.to_numpy(), values[i].values.to_numpy().astype(float), labels[i].as_py())
        w = model.weights(np.arange(DIMENSIONS + 1))
        kept = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(kept.astype("int32")), pa.array(w[kept])], names=["index", "weight"])

    # One task: the updates follow each other, over as many rows as the sample may have.
    one = sparse.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "label")
    return stored(one.mapInArrow(train, "index int, weight double"))


def _weights(model: DataFrame):
    """The model as a broadcast vector: DIMENSIONS + 1 numbers."""
    weights = np.zeros(DIMENSIONS + 1, np.float32)
    for row in model.collect():
        weights[row["index"]] = row["weight"]
    return model.sparkSession.sparkContext.broadcast(weights)


def score(docs: DataFrame, model: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; a text without words has the bias's score."""
    shared = _weights(model)
    divisor, rest = HELD_OUT

    def run(batches):
        w = shared.value
        for batch in batches:
            out = np.array([float(w[i] @ v) for i, v in (features(t.as_py()) for t in batch.column(2))])
            sums = np.clip(out + w[DIMENSIONS], -35, 35).astype(float)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(1 / (1 + np.exp(-sums)))], names=["doc_id", "held_out", "score"]
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.pmod(doc_hash(), F.lit(divisor)) == rest).alias("held_out"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    held_out: crc32(doc_id as text) mod 3 is 1 (a null doc_id is empty text); these rows' labels are
    not learned. Null texts are empty, texts of any length are scored whole. Without labels every score
    is 0.5. Repeated rows stay repeated, other columns are ignored, an empty table gives no rows.
    """
    return score(docs, fit(docs, labels, sample))


def drop_rejected(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that are predicted 1, with all their columns, whatever their names.

    Null texts are empty, texts of any length are scored whole. Without labels every row stays. Repeated
    rows are decided alike and stay repeated, ties (score 0.5) stay, an empty table gives no rows.
    """
    shared = _weights(fit(docs, labels, sample))

    @F.pandas_udf("boolean")
    def accepted(texts):
        w = shared.value
        return texts.map(lambda t: bool(sum(w[i] @ v for i, v in [features(t)]) + w[DIMENSIONS] >= 0))

    return docs.where(accepted(F.coalesce("text", F.lit(""))))
