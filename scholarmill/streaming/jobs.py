"""Toggle counts, latest values, table refresh and selection state from streams."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scholarmill.operators.bookmarks import PAIR, toggle_counts
from scholarmill.operators.state import KEYS, as_toggles, fold_selection, latest
from scholarmill.session import remove, stored
from scholarmill.sources.buckets import BucketTable
from scholarmill.sources.folders import folders

RUN, VERSION = "run", "version"
BASE_RUN = 0


def run_number(spark: SparkSession, table: str, checkpoint: str) -> int:
    """The number under which a checkpoint writes to ``table``: from 1, a new one for a new checkpoint.

    It is kept in the checkpoint itself, so batches of another checkpoint, or of one that was deleted,
    never write to the same folders. One stream at a time starts on a table.
    """
    try:
        return spark.read.schema("n long").json(f"{checkpoint}/run").first()[0]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    taken = folders(spark, f"{table}/runs", "n long").agg(F.max("n")).first()[0]
    number = (taken or BASE_RUN) + 1
    one = spark.range(1).select(F.lit(number).cast("long").alias("n"))
    one.write.mode("append").json(f"{table}/runs")
    one.write.json(f"{checkpoint}/run")
    return number


def read_events(
    spark: SparkSession, folder: str, schema: str, files_per_batch: int = 1000
) -> DataFrame:
    """A stream over parquet files arriving in ``folder``."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def toggle_stream(events: DataFrame) -> DataFrame:
    """Presses per pair with the bookmark they leave; run in update or complete mode.

    Presses are counted inside each task before they reach the state, so a hot pair costs one state
    update per task and batch.
    """
    counts = toggle_counts(events)
    return counts.select(*PAIR, "n", (F.col("n") % 2 == 1).alias("is_bookmarked"))


def latest_stream(events: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last event per key; run in update or complete mode."""
    return latest(events, keys, order)


def current(spark: SparkSession, table: str, schema: str, keys: list[str], order: list[str]) -> DataFrame:
    """The latest row per key of a table that grows by one folder per run and batch."""
    rows = folders(spark, f"{table}/rows", f"{schema}, {RUN} bigint, {VERSION} bigint", "parquet")
    return latest(rows.drop(RUN, VERSION), keys, order)


def refresh(
    incoming: DataFrame,
    table: str,
    checkpoint: str,
    keys: list[str],
    order: list[str],
    trigger: dict | None = None,
) -> StreamingQuery:
    """Load a stream into ``table``, latest row per key.

    A batch is reduced to its own latest rows and written to its own folder, which a replay
    overwrites with the same rows; old rows are never rewritten. Each checkpoint writes under a run
    of its own, so a new one, or a second source, adds to the table. Read with ``current``.
    """
    run = run_number(incoming.sparkSession, table, checkpoint)

    def load(batch: DataFrame, batch_id: int) -> None:
        newest = latest(batch, keys, order)
        newest.write.mode("overwrite").parquet(f"{table}/rows/{RUN}={run}/{VERSION}={batch_id}")

    writer = incoming.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def refresh_buckets(
    incoming: DataFrame, table: BucketTable, checkpoint: str, order: list[str], trigger: dict | None = None
) -> StreamingQuery:
    """Load a stream into a table hashed by key: a batch rewrites only the buckets of its keys.

    The number of the batch is the load's token, so a replayed batch is not loaded again.
    """
    run = run_number(incoming.sparkSession, table.path, checkpoint)

    def load(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch.persist(), order, f"{run}-{batch_id}")
        batch.unpersist()

    writer = incoming.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def compact(spark: SparkSession, table: str, schema: str, keys: list[str], order: list[str],
            target: str) -> None:
    """Write the current rows to a new table, under a run that no stream has."""
    rows = current(spark, table, schema, keys, order)
    rows.write.parquet(f"{target}/rows/{RUN}={BASE_RUN}/{VERSION}=0")


# --- selection state ------------------------------------------------------------------------------

STATE = "session string, field string, enabled boolean, selected bigint, last_ord bigint"
LOG = "session string, ord bigint, kind string, field string, sub_field string"
PARTS = f"{RUN} bigint, {VERSION} bigint, bucket int"
MARKS = f"{RUN} bigint, {VERSION} bigint, whole boolean"
SNAPSHOT_EVERY = 100
BUCKETS = 256
#: Late sessions that are named in the scan of the log; more of them are only joined.
NAMED = 1000


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*KEYS), F.lit(buckets)).cast("int")


def _buckets_of(spark: SparkSession, table: str, wanted: int) -> int:
    """The number of buckets that ``table`` was begun with."""
    known = folders(spark, f"{table}/layout", "buckets int").first()
    if known:
        return known[0]
    one = spark.range(1).select(F.lit(wanted).alias("buckets"))
    one.write.mode("append").json(f"{table}/layout")
    return wanted


def _place() -> Column:
    return F.struct(RUN, VERSION)


def _at(run: int, version: int) -> Column:
    return F.struct(F.lit(run).cast("bigint").alias(RUN), F.lit(version).cast("bigint").alias(VERSION))


def _last_whole(marks: DataFrame, place: Column | None = None) -> tuple[int, int]:
    """Run and version of the newest complete snapshot (before ``place``); (0, 0) without any.

    ``marks`` has one row a batch; neither states nor log are opened to find it.
    """
    known = marks.where("whole") if place is None else marks.where(F.col("whole") & (_place() < place))
    newest = known.agg(F.max(_place()).alias("p")).first()["p"]
    return (newest[RUN], newest[VERSION]) if newest else (BASE_RUN, 0)


def _states(spark: SparkSession, table: str, since: tuple[int, int]) -> DataFrame:
    rows = folders(spark, f"{table}/state", f"{STATE}, {PARTS}", "parquet")
    # Both conditions are on folder names, so folders before the snapshot are not opened.
    return rows.where(F.col(RUN) >= since[0]).where((F.col(RUN) > since[0]) | (F.col(VERSION) >= since[1]))


def selection_state(spark: SparkSession, table: str) -> DataFrame:
    """Current selection per session and field: the last snapshot and the batches after it."""
    since = _last_whole(folders(spark, f"{table}/marks", MARKS))
    rows = latest(_states(spark, table, since).drop("bucket"), KEYS, [RUN, VERSION])
    return rows.select("session", "field", "enabled", "selected")


def selection_stream(
    toggles: DataFrame,
    table: str,
    checkpoint: str,
    trigger: dict | None = None,
    snapshot_every: int = SNAPSHOT_EVERY,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Fold a stream of toggles (session, ord, kind, field, sub_field) into ``table``.

    ``table`` keeps the log of all toggles and the states after each batch. The stored state of the
    keys in a batch is turned back into a few toggles placed before the batch's own, and the batch
    operator folds both. A hot session is thus split like in the batch job instead of passing through
    one stateful task. Where a toggle comes late, after one of the same session and field with a
    greater ``ord`` has been folded, that key alone is folded anew from its log. So the state is that
    of the whole log, however the input was cut and in whatever order it came.

    Log and states lie in buckets of the key, whose number a new table takes from ``buckets``. A batch
    opens states of the buckets that it touches, and the log only if some press is late: the buckets of
    the late keys, in files that are sorted by key, so that what holds other keys is skipped. A batch
    writes the states it changed; every ``snapshot_every`` batches it writes all states, after which
    the states before the last snapshot but one are removed. Each checkpoint writes under a run of
    its own (see ``run_number``); one stream at a time writes to a table.
    """
    scratch = hashlib.sha256(table.encode()).hexdigest()[:16]
    run = run_number(toggles.sparkSession, table, checkpoint)
    bucket = _bucket(_buckets_of(toggles.sparkSession, table, buckets))
    columns = ["session", "ord", "kind", "field", "sub_field"]

    def write(rows: DataFrame, kind: str, batch_id: int) -> None:
        path = f"{table}/{kind}/{RUN}={run}/{VERSION}={batch_id}"
        # Sorted by range, a hot key spreads over files, and each file holds a short run of keys.
        order = ["bucket", *(c for c in (*KEYS, "ord") if c in rows.columns)]
        placed = rows.withColumn("bucket", bucket).repartitionByRange(*order).sortWithinPartitions(*order)
        placed.write.mode("overwrite").partitionBy("bucket").parquet(path)

    def fold(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.select(*columns).persist()  # for its keys, its log, the sort's ranges and the fold
        touched = batch.groupBy(*KEYS).agg(F.min("ord").alias("first_ord"), F.max("ord").alias("newest_ord"))
        touched = touched.withColumn("bucket", bucket)
        opened = [r[0] for r in touched.select("bucket").distinct().collect()]  # at most ``buckets``
        write(batch, "log", batch_id)

        here = _at(run, batch_id)
        since = _last_whole(folders(spark, f"{table}/marks", MARKS), here)
        earlier = _states(spark, table, since).where(_place() < here)
        own = latest(earlier.where(F.col("bucket").isin(opened)).join(touched.select(*KEYS), KEYS, "left_semi"), KEYS, [RUN, VERSION])
        held = stored(
            touched.drop("bucket").join(own.drop(RUN, VERSION, "bucket"), KEYS, "left"), f"held-{scratch}"
        )
        late = held.where("first_ord < last_ord").select(*KEYS)
        timely = held.where("last_ord IS NOT NULL AND first_ord >= last_ord")
        presses = as_toggles(timely).select(*columns).unionByName(batch)
        reopened = [r[0] for r in late.select(bucket).distinct().collect()]
        if reopened:
            log = folders(spark, f"{table}/log", f"{LOG}, {PARTS}", "parquet").where(_place() < here)
            log = log.where(F.col("bucket").isin(reopened))
            sessions = [r[0] for r in late.select("session").distinct().limit(NAMED + 1).collect()]
            if len(sessions) <= NAMED:
                log = log.where(F.col("session").isin(sessions))
            presses = presses.unionByName(log.select(*columns).join(late, KEYS, "left_semi"))
        states = fold_selection(presses, stored_as=f"selection-{scratch}").join(
            held.select(*KEYS, F.greatest("last_ord", "newest_ord").alias("last_ord")), KEYS
        )
        whole = batch_id > 0 and batch_id % snapshot_every == 0
        if whole:
            changed = states.withColumn(RUN, F.lit(run).cast("bigint")).withColumn(VERSION, F.lit(batch_id).cast("bigint"))
            states = latest(earlier.drop("bucket").unionByName(changed), KEYS, [RUN, VERSION]).drop(RUN, VERSION)
        write(states, "state", batch_id)
        mark = spark.range(1).select(F.lit(whole).alias("whole"))
        mark.write.mode("overwrite").json(f"{table}/marks/{RUN}={run}/{VERSION}={batch_id}")
        if whole:
            _drop_states(spark, table, before=since)
        batch.unpersist()

    writer = toggles.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def _drop_states(spark: SparkSession, table: str, before: tuple[int, int]) -> None:
    """Remove the states of batches before a snapshot that is no longer the newest; the log stays."""
    marks = folders(spark, f"{table}/marks", MARKS).where(_place() < _at(*before))
    for run, version, _ in marks.select(RUN, VERSION, "whole").toLocalIterator():
        remove(spark, f"{table}/state/{RUN}={run}/{VERSION}={version}")
        remove(spark, f"{table}/marks/{RUN}={run}/{VERSION}={version}")
