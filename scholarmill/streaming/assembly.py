"""Replies and transcripts put together from a stream of their parts.

A segment is the parts of one key whose numbers fall in one run of ``per_segment``. It is open while
parts may still come and closes when the event-time watermark, the newest time seen less ``delay``, has
passed the last of its parts. Closed segments are appended, with their text, and never written again;
what is kept between batches is the parts of open segments, so the state is bounded by the delay, not by
the history. A part that is behind the watermark and whose segment is not open goes to a side table.

Every batch writes folders of its own that a replay overwrites, and reads the open parts that the batch
before has left. One stream at a time writes to a table.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scholarmill.operators.conversations import PARTS_PER_SEGMENT, assemble
from scholarmill.session import remove, stored
from scholarmill.sources.folders import folders
from scholarmill.streaming.jobs import RUN, VERSION, run_number

MARKS = f"newest bigint, {RUN} bigint, {VERSION} bigint"
LATE, UNPLACED = "late", "unplaced"


@dataclass(frozen=True)
class Assembly:
    """Where assembled segments of one kind lie, and how they are made.

    ``key`` and ``kind`` name the key column and its type; parts are (key, seq, text, ts).
    """

    table: str
    key: str = "message_id"
    kind: str = "string"
    separator: str = ""
    per_segment: int = PARTS_PER_SEGMENT
    delay: int = 600  # seconds

    @property
    def _part(self) -> str:
        return f"{self.key} {self.kind}, seq bigint, text string, ts timestamp"

    @property
    def _segment(self) -> str:
        return f"{self.key} {self.kind}, segment bigint, text string, parts array<struct<seq: bigint, text: string>>"

    def _rows(self, spark: SparkSession, name: str, schema: str) -> DataFrame:
        return folders(spark, f"{self.table}/{name}", f"{schema}, {RUN} bigint, {VERSION} bigint", "parquet")

    def closed(self, spark: SparkSession) -> DataFrame:
        """Closed segments with their text, as they were appended."""
        rows = self._rows(spark, "closed", self._segment)
        return rows.select(self.key, "segment", "text", F.size("parts").cast("bigint").alias("n_parts"))

    def late(self, spark: SparkSession) -> DataFrame:
        """Parts that came too late or have no place, with the reason."""
        return self._rows(spark, "late", f"{self._part}, reason string").drop(RUN, VERSION)

    def whole(self, spark: SparkSession) -> DataFrame:
        """Segments of everything seen so far: closed ones with their late parts, and open ones.

        The same as the batch operator gives for the same parts, however they were cut and in whatever
        order they came.
        """
        names = [self.key, "seq", "text"]
        closed = self._rows(spark, "closed", self._segment).select(self.key, F.explode("parts").alias("p"))
        parts = closed.select(self.key, "p.seq", "p.text")
        parts = parts.unionByName(self.late(spark).where(F.col("reason") == LATE).select(*names))
        last = self._last(spark)
        if last:
            parts = parts.unionByName(self._open(spark, last).select(*names))
        return assemble(parts, self.key, "seq", F.col("text"), self.separator, self.per_segment)

    def _open(self, spark: SparkSession, place: tuple[int, int, int]) -> DataFrame:
        return spark.read.schema(self._part).parquet(f"{self.table}/open/{RUN}={place[0]}/{VERSION}={place[1]}")

    def _last(self, spark: SparkSession, before: tuple[int, int] | None = None) -> tuple[int, int, int] | None:
        """Run, version and newest time of the last batch (before a place)."""
        marks = folders(spark, f"{self.table}/marks", MARKS)
        if before:
            run, version = before
            marks = marks.where((F.col(RUN) < run) | ((F.col(RUN) == run) & (F.col(VERSION) < version)))
        found = marks.agg(F.max(F.struct(RUN, VERSION, "newest")).alias("m")).first()["m"]
        return tuple(found) if found else None

    def start(self, parts: DataFrame, checkpoint: str, text: Column | None = None, trigger: dict | None = None) -> StreamingQuery:
        """Put together a stream of parts (key, seq, text, ts); empty parts are skipped.

        A part that is delivered again while its segment is open is taken once, as in the batch operator.
        Parts without key, number or time have no place and go to the side table.
        """
        run = run_number(parts.sparkSession, self.table, checkpoint)
        text = F.col("text") if text is None else text
        chosen = parts.select(
            F.col(self.key).cast(self.kind).alias(self.key), F.col("seq").cast("bigint").alias("seq"),
            text.alias("text"), F.col("ts").cast("timestamp").alias("ts"),
        )
        scratch = hashlib.sha256(self.table.encode()).hexdigest()[:16]

        def fold(batch: DataFrame, batch_id: int) -> None:
            self._fold(batch, run, batch_id, scratch)

        writer = chosen.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def _fold(self, batch: DataFrame, run: int, version: int, scratch: str) -> None:
        spark, key = batch.sparkSession, self.key
        place = f"{RUN}={run}/{VERSION}={version}"
        last = self._last(spark, (run, version))
        segment = F.floor(F.col("seq") / self.per_segment).alias("segment")
        has_place = F.col(key).isNotNull() & F.col("seq").isNotNull() & F.col("ts").isNotNull()

        came = batch.where(F.coalesce(F.length("text") > 0, F.lit(False))).select("*", segment)
        marked = came.withColumn("reason", F.when(~has_place, UNPLACED))
        if last:
            before = self._open(spark, last).select("*", segment)
            behind = F.unix_micros("ts") < last[2] - self.delay * 1_000_000
            opened = before.select(key, "segment").distinct().withColumn("is_open", F.lit(True))
            marked = marked.join(opened, [key, "segment"], "left").withColumn(
                "reason", F.coalesce("reason", F.when(behind & F.col("is_open").isNull(), LATE))
            ).drop("is_open")
        marked = stored(marked, f"came-{scratch}")
        marked.where("reason IS NOT NULL").drop("segment").write.mode("overwrite").parquet(f"{self.table}/late/{place}")

        on_time = marked.where("reason IS NULL").drop("reason")
        newest = on_time.agg(F.max(F.unix_micros("ts"))).first()[0]
        known = [n for n in (newest, last[2] if last else None) if n is not None]
        clock = max(known, default=None)
        held = on_time.unionByName(before) if last else on_time
        # One part of each number: at most ``per_segment`` rows of a segment, whatever was sent again.
        held = held.groupBy(key, "segment", "seq").agg(F.min("text").alias("text"), F.max("ts").alias("ts"))
        passed = F.lit(clock or 0) - self.delay * 1_000_000
        last_part = F.max(F.unix_micros("ts")).over(Window.partitionBy(key, "segment"))
        held = stored(held.withColumn("is_closed", last_part < passed), f"open-{scratch}")

        pieces = F.array_sort(F.collect_list(F.struct("seq", "text"))).alias("parts")
        done = held.where("is_closed").groupBy(key, "segment").agg(pieces)
        joined = F.array_join(F.transform("parts", lambda p: p["text"]), self.separator).alias("text")
        done.select(key, "segment", joined, "parts").write.mode("overwrite").parquet(f"{self.table}/closed/{place}")
        held.where("NOT is_closed").select(key, "seq", "text", "ts").write.mode("overwrite").parquet(
            f"{self.table}/open/{place}"
        )
        mark = spark.range(1).select(F.lit(clock).cast("bigint").alias("newest"))
        mark.write.mode("overwrite").json(f"{self.table}/marks/{place}")
        if last:  # a replay of this batch needs the batch before, no older one
            older = self._last(spark, last[:2])
            if older:
                remove(spark, f"{self.table}/open/{RUN}={older[0]}/{VERSION}={older[1]}")
