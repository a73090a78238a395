"""Streams end in the same state as the batch operators, however the input is cut."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from scholarmill import schemas
from scholarmill.operators import bookmarks, state
from scholarmill.streaming import jobs
from tests.fixtures import tuples
from tests.test_state import folded, presses, replay


def in_files(spark, rows, schema, cuts, folder):
    """Write rows as one file per cut, in order, so that one file is one micro-batch."""
    size = -(-len(rows) // cuts)
    for i in range(cuts):
        part = spark.createDataFrame(rows[i * size:(i + 1) * size], schema)
        part.coalesce(1).write.mode("append").parquet(folder)
    return jobs.read_events(spark, folder, schema, files_per_batch=1)


def events_of(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet").where("event_type = 'click'")
    lab = F.get_json_object("props", "$.k").alias("lab_id")
    return tuples(events.orderBy("event_id").select(F.col("user_id").cast("string"), lab))


@pytest.mark.parametrize("cuts", [1, 4])
@pytest.mark.parametrize("mode", ["complete", "update"])
def test_toggle_stream(spark, small, tmp_path, cuts, mode):
    rows = events_of(spark, small)
    stream = in_files(spark, rows, schemas.BOOKMARKS, cuts, str(tmp_path / "in"))
    name = f"toggles_{mode}_{cuts}"
    run = jobs.toggle_stream(stream).writeStream.outputMode(mode).format("memory").queryName(name).start()
    run.processAllAvailable()
    run.stop()
    seen = spark.table(name).groupBy("user_id", "lab_id").agg(F.max("n").alias("n")).where("n % 2 = 1")
    batch = bookmarks.toggle_state(spark.createDataFrame(rows, schemas.BOOKMARKS))
    assert sorted(tuples(seen)) == sorted(tuples(batch)) and batch.count() > 50


@pytest.mark.parametrize(("cuts", "every"), [(1, 100), (3, 100), (7, 3)])
def test_selection_stream(spark, tmp_path, cuts, every):
    events = presses(cuts, 420, ["hot"] * 4 + ["a", "b"])
    stream = in_files(spark, events, schemas.TOGGLE_EVENTS, cuts, str(tmp_path / "in"))
    table = str(tmp_path / "state")
    run = jobs.selection_stream(stream, table, str(tmp_path / "cp"), {"processingTime": "0 seconds"}, every)
    run.processAllAvailable()
    run.stop()
    assert folded(jobs.selection_state(spark, table)) == replay(events)


def test_selection_stream_goes_on_after_a_restart(spark, tmp_path):
    events = presses(9, 300, ["a", "b"])
    folder, table, cp = (str(tmp_path / n) for n in ("in", "state", "cp"))
    for part in (events[:120], events[120:]):
        spark.createDataFrame(part, schemas.TOGGLE_EVENTS).coalesce(1).write.mode("append").parquet(folder)
        stream = jobs.read_events(spark, folder, schemas.TOGGLE_EVENTS, 1)
        jobs.selection_stream(stream, table, cp).awaitTermination(120)
    assert folded(jobs.selection_state(spark, table)) == replay(events)


def load_selection(spark, events, folder, table, cp, every=100):
    spark.createDataFrame(events, schemas.TOGGLE_EVENTS).coalesce(1).write.mode("append").parquet(folder)
    stream = jobs.read_events(spark, folder, schemas.TOGGLE_EVENTS, 1)
    jobs.selection_stream(stream, table, cp, snapshot_every=every).awaitTermination(180)


def test_selection_stream_with_a_new_checkpoint(spark, tmp_path):
    """A second source with its own checkpoint adds to the table, also behind a snapshot."""
    events = presses(4, 240, ["a", "b"])
    table = str(tmp_path / "state")
    for i, part in enumerate((events[:80], events[80:160], events[160:])):
        load_selection(spark, part, str(tmp_path / f"in{i}"), table, str(tmp_path / f"cp{i}"), every=1)
    assert folded(jobs.selection_state(spark, table)) == replay(events)


def test_selection_stream_with_late_presses(spark, tmp_path):
    events = presses(6, 200, ["a", "b"])
    late = events[::3]
    folder, table, cp = (str(tmp_path / n) for n in ("in", "state", "cp"))
    for part in ([e for e in events if e not in late], late[50:], late[:50]):
        load_selection(spark, part, folder, table, cp, every=2)
    assert folded(jobs.selection_state(spark, table)) == replay(events)


def test_table_keeps_its_rows(spark, tmp_path):
    """Compacting, a new checkpoint, a second source: no row is lost."""
    schema, keys, order = "id string, v bigint, ts bigint", ["id"], ["ts"]
    parts = [[("a", 1, 1), ("b", 1, 1)], [("c", 2, 2)], [("b", 3, 3)], [("d", 4, 4), ("a", 0, 0)]]
    table, small = str(tmp_path / "t"), str(tmp_path / "small")

    def load(i, target):
        folder = str(tmp_path / f"in{i}")
        spark.createDataFrame(parts[i], schema).coalesce(1).write.parquet(folder)
        jobs.refresh(jobs.read_events(spark, folder, schema), target, str(tmp_path / f"cp{i}"), keys, order).awaitTermination(120)

    assert jobs.current(spark, table, schema, keys, order).count() == 0
    load(0, table)
    load(1, table)
    jobs.compact(spark, table, schema, keys, order, small)
    load(2, small)
    load(3, small)
    assert sorted(tuples(jobs.current(spark, small, schema, keys, order))) == [("a", 1, 1), ("b", 3, 3), ("c", 2, 2), ("d", 4, 4)]
    assert sorted(tuples(jobs.current(spark, table, schema, keys, order))) == [("a", 1, 1), ("b", 1, 1), ("c", 2, 2)]


def test_refresh_and_compact(spark, tmp_path):
    rng = random.Random(2)
    schema = "id string, papers bigint, ts bigint, seq bigint"
    rows = [(f"l{rng.randint(0, 30)}", rng.randint(0, 99), rng.randint(0, 50), i) for i in range(500)]
    folder, table, cp, small = (str(tmp_path / n) for n in ("in", "t", "cp", "small"))
    keys, order = ["id"], ["ts", "seq"]
    for part in (rows[:200], rows[200:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        jobs.refresh(jobs.read_events(spark, folder, schema, 1), table, cp, keys, order).awaitTermination(120)
    batch = sorted(tuples(state.latest(spark.createDataFrame(rows, schema), keys, order)))
    assert sorted(tuples(jobs.current(spark, table, schema, keys, order))) == batch
    jobs.compact(spark, table, schema, keys, order, small)
    assert sorted(tuples(jobs.current(spark, small, schema, keys, order))) == batch


def test_latest_stream(spark, tmp_path):
    rows = [("a", 1, "x"), ("b", 5, "y"), ("a", 3, "z"), ("a", 2, "w")]
    schema = "user_id string, ts bigint, value string"
    stream = in_files(spark, rows, schema, 2, str(tmp_path / "in"))
    run = (jobs.latest_stream(stream, ["user_id"], ["ts"]).writeStream.outputMode("complete")
           .format("memory").queryName("latest_now").start())
    run.processAllAvailable()
    run.stop()
    assert sorted(tuples(spark.table("latest_now"))) == [("a", 3, "z"), ("b", 5, "y")]


def test_batches_without_late_presses_open_no_old_log(spark, tmp_path):
    """Once the log of the first batch is unreadable, presses in time go on and a late one fails."""
    events = presses(8, 160, ["a", "b"])
    folder, table, cp = (str(tmp_path / n) for n in ("in", "state", "cp"))
    load_selection(spark, events[10:80], folder, table, cp)
    for path in (tmp_path / "state" / "log").rglob("*.parquet"):
        path.write_bytes(b"not a log any more")
        path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    load_selection(spark, events[80:], folder, table, cp)
    assert folded(jobs.selection_state(spark, table)) == replay(events[10:])
    with pytest.raises(Exception, match="parquet"):
        load_selection(spark, events[:10], folder, table, cp)


def test_old_tables_keep_their_buckets(spark, tmp_path):
    events = presses(2, 90, ["a", "b"])
    folder, table, cp = (str(tmp_path / n) for n in ("in", "state", "cp"))
    for part, buckets in ((events[::2], 4), (events[1::2], 99)):
        spark.createDataFrame(part, schemas.TOGGLE_EVENTS).coalesce(1).write.mode("append").parquet(folder)
        stream = jobs.read_events(spark, folder, schemas.TOGGLE_EVENTS, 1)
        jobs.selection_stream(stream, table, cp, buckets=buckets).awaitTermination(180)
    assert folded(jobs.selection_state(spark, table)) == replay(events)
    taken = {r[0] for r in spark.read.parquet(f"{table}/log").select("bucket").distinct().collect()}
    assert taken <= set(range(4))
