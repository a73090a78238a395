"""Segments from a stream of parts are those of the batch operator, however the parts are cut."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from scholarmill.operators.conversations import message_text, transcripts
from scholarmill.streaming import jobs
from scholarmill.streaming.assembly import Assembly
from tests.fixtures import tuples

SCHEMA = "message_id string, seq bigint, text string, ts timestamp"


def parts(seed, n=300, disorder=0):
    """(message_id, seq, text, second) of a few replies, one of which is long, sent out of order."""
    pick, rows, second, seqs = random.Random(seed), [], 0, {}
    for _ in range(n):
        key = pick.choice(["hot"] * 5 + ["a", "b", f"m{second // 60}"])
        seq = seqs[key] = seqs.get(key, -1) + 1
        second += pick.randint(0, 3)
        rows.append((key, seq, pick.choice(["", "x", "yz ", f"{seq} "]), second))
    return sorted(rows, key=lambda r: r[3] + pick.randint(0, disorder))


def frame(spark, rows):
    told = spark.createDataFrame(rows, "message_id string, seq bigint, text string, s bigint")
    return told.select("message_id", "seq", "text", F.timestamp_seconds("s").alias("ts"))


def send(spark, assembly, rows, cuts, folder, name):
    """One file, and so one batch, a cut."""
    size = -(-len(rows) // cuts)
    for i in range(0, len(rows), size):
        frame(spark, rows[i : i + size]).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")
    stream = jobs.read_events(spark, f"{folder}/{name}", SCHEMA, 1)
    assembly.start(stream, f"{folder}/cp-{name}").awaitTermination(240)


@pytest.mark.parametrize(("cuts", "disorder", "delay"), [(1, 0, 60), (4, 0, 60), (9, 20, 30), (5, 60, 0)])
def test_equal_to_the_batch_for_any_cut(spark, tmp_path, cuts, disorder, delay):
    rows = parts(cuts, disorder=disorder)
    assembly = Assembly(str(tmp_path / "t"), per_segment=8, delay=delay)
    send(spark, assembly, rows, cuts, str(tmp_path), "in")
    batch = sorted(tuples(message_text(frame(spark, rows), 8)))
    assert sorted(tuples(assembly.whole(spark))) == batch
    closed = tuples(assembly.closed(spark))
    if disorder == 0 and cuts > 1:
        assert closed and set(closed) <= set(batch)  # closed with all of their parts
        assert len({r[:2] for r in closed}) == len(closed)
        assert assembly.late(spark).isEmpty()


def test_a_segment_closes_when_the_watermark_has_passed_it(spark, tmp_path):
    assembly = Assembly(str(tmp_path / "t"), per_segment=4, delay=10)
    batches = [
        [("a", 0, "one ", 0), ("a", 1, "two", 5)],
        [("b", 0, "x", 14)],  # the watermark is at 4
        [("a", 1, "two", 6), ("b", 1, "y", 17)],  # delivered again, still open; watermark 7, past a
        [("c", 0, "late", 3), ("a", 2, "late too", 2), ("b", 2, "z", 1)],  # behind; b is open, so b's is not late
        [(None, 0, "?", 20), ("d", None, "?", 20), ("d", 0, "", 20), ("d", 1, "end", 60)],
    ]
    seen = []
    for rows in batches:
        send(spark, assembly, rows, 1, str(tmp_path), "in")
        seen.append(sorted(tuples(assembly.closed(spark))))
    assert seen == [[], [], *[[("a", 0, "one two", 2)]] * 2, [("a", 0, "one two", 2), ("b", 0, "xyz", 3)]]
    late = sorted((r.message_id or "", r.seq if r.seq is not None else -1, r.text, r.reason) for r in assembly.late(spark).collect())
    assert late == [("", 0, "?", "unplaced"), ("a", 2, "late too", "late"), ("c", 0, "late", "late"), ("d", -1, "?", "unplaced")]
    everything = [r for rows in batches for r in rows]
    assert sorted(tuples(assembly.whole(spark))) == sorted(tuples(message_text(frame(spark, everything), 4)))


def test_only_open_parts_are_kept_and_a_new_checkpoint_goes_on(spark, tmp_path):
    rows = parts(3, 200)
    assembly = Assembly(str(tmp_path / "t"), per_segment=8, delay=20)
    send(spark, assembly, rows[:100], 4, str(tmp_path), "in")
    send(spark, assembly, rows[100:], 4, str(tmp_path), "more")
    assert sorted(tuples(assembly.whole(spark))) == sorted(tuples(message_text(frame(spark, rows), 8)))
    kept = [d for d, _, names in os.walk(tmp_path / "t" / "open") if any(n.endswith(".parquet") for n in names)]
    assert len(kept) == 2


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    rows = parts(5, 120)
    assembly = Assembly(str(tmp_path / "t"), per_segment=8, delay=5)
    send(spark, assembly, rows, 3, str(tmp_path), "in")
    before = sorted(tuples(assembly.whole(spark))), sorted(tuples(assembly.closed(spark)))
    size = -(-len(rows) // 3)
    last = frame(spark, rows[2 * size :]).withColumn("seq", F.col("seq"))
    assembly._fold(last, 1, 2, "again")
    assert (sorted(tuples(assembly.whole(spark))), sorted(tuples(assembly.closed(spark)))) == before


def test_transcripts_as_a_stream(spark, small, tmp_path):
    turns = spark.read.parquet(f"{small}/conversations.parquet").where("role <> 'user' OR trim(text) <> ''")
    sent = turns.withColumn("ts", F.timestamp_seconds(F.col("conv_id") * 60 + F.col("turn")))
    sent.repartitionByRange(3, "conv_id").write.parquet(str(tmp_path / "in"))
    assembly = Assembly(str(tmp_path / "t"), "conv_id", "bigint", "\n", delay=120)
    schema = "conv_id bigint, turn bigint, role string, text string, ts timestamp"
    stream = jobs.read_events(spark, str(tmp_path / "in"), schema, 1).withColumnRenamed("turn", "seq")
    line = F.concat(F.col("role"), F.lit(": "), F.when(F.col("role") == "user", F.regexp_replace("text", r"^\s+|\s+$", "")).otherwise(F.col("text")))
    assembly.start(stream, str(tmp_path / "cp"), line).awaitTermination(240)
    assert sorted(tuples(assembly.whole(spark))) == sorted(tuples(transcripts(turns)))
