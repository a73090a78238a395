"""Rankings kept up to date by a feed of changed labs.

Stored are the labs as last fed and, per university and set of sub-field ids, the sums of papers and labs:
the cells from which any selection is ranked. A change takes the lab as it was out of its old cell and
puts it into its new one. So a feed costs the buckets of the labs and cells that it names, and a ranking
costs the cells, of which there are far fewer than labs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scholarmill.operators.ranking import lab_cells, rank_cells
from scholarmill.operators.state import latest
from scholarmill.session import stored
from scholarmill.sources.buckets import BUCKETS, BucketTable
from scholarmill.streaming.jobs import run_number

FEED = "id {id}, university_id {university}, paper_count bigint, research_sub_fields array<bigint>, deleted boolean, ord bigint"
CELLS = "university_id {university}, ids array<bigint>, paper_count bigint, lab_count bigint"
SUMS = ["paper_count", "lab_count"]


def cell_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What labs that were ``before`` and are ``after`` add to the cells; cells that keep their sums are left out."""
    gone = lab_cells(before).select("university_id", "ids", *((-F.col(c)).alias(c) for c in SUMS))
    return _summed(gone.unionByName(lab_cells(after))).where(" OR ".join(f"{c} <> 0" for c in SUMS))


def merge_cells(cells: DataFrame, changes: DataFrame) -> DataFrame:
    """Cells after changes; a cell without labs is gone."""
    return _summed(cells.unionByName(changes)).where("lab_count <> 0")


def _summed(cells: DataFrame) -> DataFrame:
    return cells.groupBy("university_id", "ids").agg(*(F.sum(c).alias(c) for c in SUMS))


class KeptRankings:
    """Labs and cells under one folder. ``id`` and ``university`` are the types of these keys.

    A lab without a university is in a cell that no ranking shows; missing papers count as 0 and missing
    sub-fields as none.
    """

    def __init__(self, spark: SparkSession, folder: str, id: str = "string", university: str = "string", buckets: int = BUCKETS):
        self.folder = folder
        self.labs = BucketTable(spark, f"{folder}/labs", FEED.format(id=id, university=university), ["id"], buckets)
        self.cells = BucketTable(spark, f"{folder}/cells", CELLS.format(university=university), ["university_id", "ids"], buckets)

    def apply(self, feed: DataFrame, token: str | None = None) -> None:
        """Take in changed labs (the columns of ``FEED``): new, changed or, where ``deleted``, gone.

        Of several rows of a lab the one with the largest ``ord`` holds, also against rows fed before, so a
        feed may come in any order. ``ord`` is unique per lab. Deleted labs stay stored as such. A load
        whose ``token`` is known is skipped; one that broke off between cells and labs is finished by
        applying it again with its token.
        """
        columns = self.labs.columns
        newest = latest(feed.select(*columns), ["id"], ["ord"])
        newest = newest.withColumn("deleted", F.coalesce("deleted", F.lit(False))).withColumn(
            "research_sub_fields", F.coalesce("research_sub_fields", F.array().cast("array<bigint>"))
        )
        newest = stored(newest)
        old = self.labs.rows_for(newest)
        known = old.select("id", F.col("ord").alias("known"))
        moved = stored(newest.join(known, "id", "left").where("known IS NULL OR known < ord").drop("known"))
        was = old.join(moved.select("id"), "id", "left_semi").where("NOT deleted")
        changes = stored(cell_changes(was, moved.where("NOT deleted")))
        # Cells first: until the labs are in, a second try finds the same old rows.
        self.cells.load(changes, merge_cells, token)
        self.labs.load(moved, lambda a, b: latest(a.unionByName(b), ["id"], ["ord"]), token)

    def follow(self, feed: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        """``apply`` to the batches of a stream."""
        run = run_number(feed.sparkSession, self.folder, checkpoint)

        def load(batch: DataFrame, batch_id: int) -> None:
            self.apply(batch, f"{run}-{batch_id}")

        writer = feed.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def rank(self, universities: DataFrame, selections: DataFrame, sub_fields: DataFrame, fields: DataFrame) -> DataFrame:
        """``rank_selections`` of the labs as they are now; reads cells only."""
        return rank_cells(self.cells.read(), universities, selections, sub_fields, fields)
