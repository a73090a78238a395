"""Exact nearest vectors by cells.

Every vector lies in the cell of its nearest centre; a cell knows its radius, the largest distance from
its centre to one of its vectors. A query first looks into the cell whose centre is nearest, which bounds
how far its k-th neighbour can be. By the triangle inequality no vector of a cell is nearer than the
distance to its centre less its radius, so all cells that begin behind the bound are left out, and the
answer is exact. How many are left depends on how far the vectors cluster; the answer does not.

The centres come from a bounded sample and are the only thing that the driver holds. Cells with many
vectors, or many queries, are worked off in parts, so none of them is one task's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scholarmill.session import stored

#: Cells, vectors that the centres are fitted on, and rounds of fitting.
CELLS, SAMPLE, ROUNDS = 64, 10_000, 8
#: Vectors and queries of a part of a cell.
PER_PART, QUERIES_PER_PART = 1 << 16, 1 << 12
#: Similarities are compared to so many digits.
DIGITS = 6

VECTORS = "vec_id bigint, embedding array<float>, part bigint, cell int"
SHAPES = "cell int, centre array<double>, radius double, vectors bigint"
FOUND = "qid bigint, vec_id bigint, sim double"


def _directed(name: str):
    return F.coalesce(F.exists(F.col(name), lambda x: x != 0), F.lit(False))


def _unit(rows: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(v, "float64") for v in rows])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_centres(vectors: DataFrame, cells: int = CELLS, sample: int = SAMPLE) -> np.ndarray:
    """Unit centres by k-means on the ``sample`` vectors (vec_id, embedding) whose ids hash lowest."""
    some = vectors.where(_directed("embedding")).select("embedding").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample)
    rows = some.toPandas()
    if not len(rows):
        return np.empty((0, 0))
    x = _unit(rows["embedding"])
    centres, far = [x[0]], 2 - 2 * x @ x[0]
    while len(centres) < cells and far.max() > 1e-9:  # the point farthest from all centres so far
        centres.append(x[int(far.argmax())])
        far = np.minimum(far, 2 - 2 * x @ centres[-1])
    centres = np.array(centres)
    for _ in range(ROUNDS):
        near = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 1e-12, sums / np.maximum(size, 1e-12), centres)
    return centres


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * x @ centres.T, 0))


def build_cells(vectors: DataFrame, path: str, cells: int = CELLS, sample: int = SAMPLE, per_part: int = PER_PART) -> None:
    """Write every vector with a direction to its cell, and the cells' centres, radii and sizes."""
    centres = fit_centres(vectors, cells, sample)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                d = _distances(_unit(batch["embedding"]), centres)
                cell = d.argmin(axis=1)
                yield batch.assign(cell=cell.astype("int32"), away=d[np.arange(len(d)), cell])

    known = vectors.where(_directed("embedding")).select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<float>"))
    placed = stored(known.mapInPandas(place, "vec_id bigint, embedding array<float>, cell int, away double"))
    sizes = placed.groupBy("cell").agg(F.max("away").alias("radius"), F.count("*").alias("vectors"))
    at = F.create_map(*[x for i, c in enumerate(centres) for x in (F.lit(i), F.array(*map(F.lit, c.tolist())))]) if len(centres) else None
    centre = at[F.col("cell")] if at is not None else F.array().cast("array<double>")
    sizes.select("cell", centre.alias("centre"), "radius", "vectors").write.parquet(f"{path}/shapes")
    parts = vectors.sparkSession.read.schema(SHAPES).parquet(f"{path}/shapes").select(
        "cell", F.ceil(F.col("vectors") / per_part).alias("parts")
    )
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts")).alias("part")
    rows = placed.join(F.broadcast(parts), "cell").select("vec_id", "embedding", part, "cell")  # a row a cell
    rows.repartitionByRange("cell", "part", "vec_id").write.partitionBy("cell").parquet(f"{path}/vectors")


class VectorCells:
    """Stored cells."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.vectors = spark.read.schema(VECTORS).parquet(f"{path}/vectors")
        # One row a cell, whose number ``build_cells`` was given.
        self.shapes = spark.read.schema(SHAPES).parquet(f"{path}/shapes").orderBy("cell").collect()
        self.parts: dict[int, int] = {}

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        """The ``k`` vectors most similar to each query (qid, vector) by cosine, ties by id: qid, vec_id, sim, rk.

        The same rows as ``vector_topk``. qids are unique; queries without direction are left out.
        """
        place = Window.partitionBy("qid").orderBy(F.desc("sim"), "vec_id")

        def first(found: DataFrame) -> DataFrame:
            return found.withColumn("rk", F.row_number().over(place).cast("bigint")).where(F.col("rk") <= k)

        if not self.shapes:
            return first(self.spark.createDataFrame([], FOUND))
        asked = queries.where(_directed("vector")).select(
            F.col("qid").cast("bigint").alias("qid"), F.col("vector").cast("array<double>").alias("vector")
        )
        nearest = stored(self._cells_of(asked.withColumn("least", F.lit(None).cast("double")).withColumn("done", F.lit(-1))))
        near = stored(first(self._best(nearest, k)))
        bound = near.where(F.col("rk") == k).select("qid", F.col("sim").alias("least"))
        left = nearest.select("qid", "vector", F.col("cell").alias("done")).join(bound, "qid", "left")
        more = self._cells_of(left.select("qid", "vector", F.coalesce("least", F.lit(-2.0)).alias("least"), "done"))
        return first(near.drop("rk").unionByName(self._best(stored(more), k)))

    def _cells_of(self, asked: DataFrame) -> DataFrame:
        """(qid, vector, cell): the nearest cell where ``least`` is null; else all but ``done`` that can hold better."""
        centres = np.array([s.centre for s in self.shapes])
        radii, cells = np.array([s.radius for s in self.shapes]), np.array([s.cell for s in self.shapes], "int32")
        margin = 2 * 10.0**-DIGITS

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if not len(batch):
                    continue
                d = _distances(_unit(batch["vector"]), centres)
                least = batch["least"].to_numpy("float64")
                best = 1 - np.maximum(d - radii, 0) ** 2 / 2  # no vector of the cell is more similar
                wanted = (best >= least[:, None] - margin) & (cells != batch["done"].to_numpy()[:, None])
                first = np.isnan(least)
                wanted[first] = np.arange(len(cells)) == d[first].argmin(axis=1)[:, None]
                i, j = np.nonzero(wanted)
                yield batch[["qid", "vector"]].iloc[i].assign(cell=cells[j])

        return asked.mapInPandas(run, "qid bigint, vector array<double>, cell int")

    def _best(self, wanted: DataFrame, k: int) -> DataFrame:
        """The best ``k`` of every part of the cells for the queries that want them."""
        counts = {r["cell"]: r["count"] for r in wanted.groupBy("cell").count().collect()}  # a row a cell
        if not counts:
            return self.spark.createDataFrame([], FOUND)
        shares = {c: -(-n // QUERIES_PER_PART) for c, n in counts.items()}
        inside = self.vectors.where(F.col("cell").isin(list(counts)))
        parts = {r["cell"]: r["parts"] for r in inside.groupBy("cell").agg((F.max("part") + 1).alias("parts")).collect()}

        def number(of: dict[int, int]):
            return F.create_map(*[F.lit(int(x)).cast("int" if i % 2 == 0 else "bigint") for c, n in of.items() for i, x in enumerate((c, n))])[F.col("cell")]

        zero = F.lit(0).cast("bigint")
        share = F.pmod(F.xxhash64("qid"), number(shares)).alias("share")
        asks = wanted.select("qid", "vector", "cell", share, F.explode(F.sequence(zero, number(parts) - 1)).alias("part"))
        holds = inside.select("vec_id", "embedding", "cell", "part", F.explode(F.sequence(zero, number(shares) - 1)).alias("share"))
        key = ["cell", "part", "share"]
        digits = DIGITS

        def best(points: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            if not len(points) or not len(asked):
                return pd.DataFrame({"qid": [], "vec_id": [], "sim": []})
            x, ids, out = _unit(points["embedding"]), points["vec_id"].to_numpy(), []
            for at in range(0, len(asked), 256):
                some = asked.iloc[at : at + 256]
                sims = np.round(_unit(some["vector"]) @ x.T, digits)
                for qid, row in zip(some["qid"], sims):
                    top = np.lexsort((ids, -row))[:k]
                    out.append(pd.DataFrame({"qid": qid, "vec_id": ids[top], "sim": row[top]}))
            return pd.concat(out)

        return holds.groupBy(*key).cogroup(asks.groupBy(*key)).applyInPandas(best, FOUND)
