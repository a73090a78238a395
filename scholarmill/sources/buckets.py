"""A stored table hashed by key, of which a load rewrites only the buckets that it touches.

    data/load=N/bucket=K    rows of bucket K as load N left them
    manifest/load=N         one small file: the load that holds each bucket now, and the load's token
    layout                  the number of buckets

A load finds its buckets first, reads their rows, merges, and writes the result under its own number.
The manifest comes last, as one file, and the newest manifest is what readers go by: they see all of a
load or nothing of it, and go on reading the folders they began with until ``vacuum``. One load at a
time writes to a table.

A bucket holds distinct keys only, so its size is the number of keys over ``buckets`` whatever the skew
of what is loaded; take so many that a bucket fits a task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmill.operators.state import latest
from scholarmill.session import remove
from scholarmill.sources.folders import folders

BUCKETS = 256
LOAD, BUCKET = "load_number", "bucket_number"
_MANIFEST = f"bucket int, held_by bigint, token string, {LOAD} bigint"

#: (rows of the touched buckets, incoming rows) -> rows of the touched buckets from now on.
Merge = Callable[[DataFrame, DataFrame], DataFrame]


class BucketTable:
    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], buckets: int = BUCKETS):
        """``buckets`` is taken for a new table; one that is there keeps its own number."""
        self.spark, self.path, self.schema, self.keys = spark, path, schema, keys
        known = folders(spark, f"{path}/layout", "buckets int").first()
        self.buckets = known[0] if known else buckets
        if not known:
            one = spark.range(1).select(F.lit(buckets).alias("buckets"))
            one.write.mode("append").json(f"{path}/layout")

    @property
    def columns(self) -> list[str]:
        return T.StructType.fromDDL(self.schema).names

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _manifests(self) -> DataFrame:
        return folders(self.spark, f"{self.path}/manifest", _MANIFEST)

    def _live(self) -> tuple[int, dict[int, int]]:
        """The newest load, and which load holds each bucket: at most ``buckets`` numbers."""
        found = self._manifests()
        newest = found.agg(F.max(LOAD)).first()[0]
        if newest is None:
            return 0, {}
        rows = found.where((F.col(LOAD) == newest) & F.col("bucket").isNotNull()).collect()
        return newest, {r.bucket: r.held_by for r in rows}

    def _read(self, live: dict[int, int], only: set[int] | None = None) -> DataFrame:
        paths = [f"{self.path}/data/{LOAD}={n}/{BUCKET}={b}" for b, n in sorted(live.items()) if only is None or b in only]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self) -> DataFrame:
        """The rows after the newest load."""
        return self._read(self._live()[1])

    def rows_for(self, wanted: DataFrame) -> DataFrame:
        """The stored rows of the keys in ``wanted``; opens their buckets only."""
        touched = {r[0] for r in wanted.select(self.bucket().alias("b")).distinct().collect()}
        return self._read(self._live()[1], touched).join(wanted.select(*self.keys), self.keys, "left_semi")

    def loaded(self, token: str) -> bool:
        return not self._manifests().where(F.col("token") == token).isEmpty()

    def load(self, incoming: DataFrame, merge: Merge, token: str | None = None) -> list[int]:
        """Merge ``incoming`` into its buckets and return them.

        A load whose ``token`` is known, such as a stream's batch that is replayed, is skipped. A merge may
        drop rows; a bucket that is left empty is gone.
        """
        if token is not None and self.loaded(token):
            return []
        newest, live = self._live()
        number = newest + 1
        touched = sorted(r[0] for r in incoming.select(self.bucket().alias("b")).distinct().collect())
        if touched:
            merged = merge(self._read(live, set(touched)), incoming).select(*self.columns)
            target = f"{self.path}/data/{LOAD}={number}"
            placed = merged.withColumn(BUCKET, self.bucket()).repartition(len(touched), BUCKET)
            # A load that broke off before its manifest has left a folder that this one replaces.
            placed.write.mode("overwrite").partitionBy(BUCKET).parquet(target)
            kept = folders(self.spark, target, f"{BUCKET} int", "parquet").select(BUCKET).distinct().collect()
            live = {b: n for b, n in live.items() if b not in set(touched)} | {r[0]: number for r in kept}
        rows = [(b, n, token) for b, n in live.items()] or [(None, None, token)]
        told = self.spark.createDataFrame(rows, "bucket int, held_by bigint, token string")
        told.coalesce(1).write.mode("overwrite").json(f"{self.path}/manifest/{LOAD}={number}")
        return touched

    def upsert(self, incoming: DataFrame, order: list[str], token: str | None = None) -> list[int]:
        """Load the latest row per key, by ``order``, of what is there and what comes."""
        newest = latest(incoming.select(*self.columns), self.keys, order)
        return self.load(newest, lambda old, new: latest(old.unionByName(new), self.keys, order), token)

    def vacuum(self, keep: int = 2) -> int:
        """Delete data that none of the newest ``keep`` manifests names; returns the number of folders."""
        rows = self._manifests().select(LOAD, "bucket", "held_by").collect()  # ``buckets`` rows a manifest
        numbers = sorted({r[LOAD] for r in rows})
        held = {(r.held_by, r.bucket) for r in rows if r[LOAD] in numbers[-keep:]}
        gone = {(r.held_by, r.bucket) for r in rows if r.bucket is not None} - held
        for load, bucket in gone:
            remove(self.spark, f"{self.path}/data/{LOAD}={load}/{BUCKET}={bucket}")
        # Manifests of a row or two stay: their tokens say what has been loaded.
        for number in numbers[:-keep]:
            tokens = self._manifests().where(F.col(LOAD) == number).agg(F.max("token")).first()[0]
            empty = self.spark.createDataFrame([(None, None, tokens)], "bucket int, held_by bigint, token string")
            empty.coalesce(1).write.mode("overwrite").json(f"{self.path}/manifest/{LOAD}={number}")
        return len(gone)
