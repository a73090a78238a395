"""A q-gram index of names: substring search for many terms, and names that were slightly changed.

Postings hold, for every run of one to three letters, the names that have it. A term is looked up by its
rarest gram, and the few names behind that are verified, so no name is scanned; a term of one or two
letters is a gram itself. For names that differ by some edits the number of padded trigrams that both
have is counted: one edit spoils three at most, so names that share too few cannot be close.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

Q = 3
#: A name may change by one edit for so many letters, and by ``MOST_EDITS`` in all.
LETTERS_PER_EDIT, MOST_EDITS = 5, 3
_PAD = "\u0001" * (Q - 1)

NAMES = "id bigint, name string, low string"
GRAMS = "gram string, id bigint"
COUNTS = "gram string, names bigint"


def _grams(text: Column, size: int) -> Column:
    """All runs of ``size`` letters, one for each place."""
    places = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1)))
    runs = F.transform(places, lambda i: F.substr(text, i, F.lit(size)))
    return F.when(F.length(text) >= size, runs).otherwise(F.array().cast("array<string>"))


def build_names(names: DataFrame, path: str) -> None:
    """Write the index of ``names`` (id, name); rows without a name are left out. Ids are unique."""
    known = names.where("name IS NOT NULL").select(F.col("id").cast("bigint").alias("id"), "name", F.lower("name").alias("low"))
    known.write.parquet(f"{path}/names")
    spark = names.sparkSession
    low = F.col("low")
    every = F.array_distinct(F.concat(*[_grams(low, q) for q in range(1, Q + 1)]))
    grams = spark.read.schema(NAMES).parquet(f"{path}/names").select(F.explode(every).alias("gram"), "id")
    grams.repartitionByRange("gram", "id").sortWithinPartitions("gram", "id").write.parquet(f"{path}/grams")
    grams = spark.read.schema(GRAMS).parquet(f"{path}/grams")
    grams.groupBy("gram").agg(F.count("*").alias("names")).write.parquet(f"{path}/counts")


class NameIndex:
    """A stored index of names."""

    def __init__(self, spark: SparkSession, path: str):
        self.names = spark.read.schema(NAMES).parquet(f"{path}/names")
        self.grams = spark.read.schema(GRAMS).parquet(f"{path}/grams")
        self.counts = spark.read.schema(COUNTS).parquet(f"{path}/counts")

    def containing(self, terms: DataFrame) -> DataFrame:
        """(term, id, name) of every name that contains a term of ``terms`` (term), in any case.

        Null and empty terms find nothing; a repeated term is one.
        """
        asked = terms.where(F.length("term") > 0).select("term", F.lower("term").alias("low")).distinct()
        low = F.col("low")
        own = F.when(F.length(low) < Q, F.array(low)).otherwise(_grams(low, Q))
        # A gram that no name has rules its term out, so the count of a missing one is 0.
        grams = asked.select("term", "low", F.explode(F.array_distinct(own)).alias("gram"))
        counted = grams.join(self.counts, "gram", "left").fillna(0, ["names"])
        rarest = counted.groupBy("term", "low").agg(F.min_by("gram", F.struct("names", "gram")).alias("gram"), F.min("names").alias("names"))
        ids = self.grams.join(rarest.where("names > 0").select("term", F.col("low").alias("wanted"), "gram"), "gram")
        found = self.names.join(ids.select("term", "wanted", "id"), "id").where(F.col("low").contains(F.col("wanted")))
        return found.select("term", "id", "name")


def _padded(name: str) -> Column:
    return _grams(F.concat(F.lit(_PAD), F.lower(name), F.lit(_PAD)), Q)


def _numbered_grams(rows: DataFrame, name: str) -> DataFrame:
    """Padded trigrams with how often each occurs in the name."""
    grams = rows.select(name, F.explode(_padded(name)).alias("gram"))
    return grams.groupBy(name, "gram").agg(F.count("*").alias(f"n_{name}"))


def renamed(old: DataFrame, new: DataFrame, most: int = MOST_EDITS) -> DataFrame:
    """For names of ``old`` that are not in ``new``, the closest name of ``new`` that is not in ``old``.

    Both have a column ``name``. A name is close if no more edits (letters put in, taken out or changed, in
    any case) lie between than one for ``LETTERS_PER_EDIT`` letters of the old name, and ``most`` in all.
    Ties go to the name that sorts first. (old_name, new_name, edits); names without a close one have no row.
    """
    gone = old.select("name").where("name IS NOT NULL").distinct().join(new, "name", "left_anti").withColumnRenamed("name", "old_name")
    came = new.select("name").where("name IS NOT NULL").distinct().join(old, "name", "left_anti").withColumnRenamed("name", "new_name")
    edits = F.least(F.floor(F.length("old_name") / LETTERS_PER_EDIT), F.lit(most))
    shared = _numbered_grams(gone, "old_name").join(_numbered_grams(came, "new_name"), "gram")
    counted = shared.groupBy("old_name", "new_name").agg(F.sum(F.least("n_old_name", "n_new_name")).alias("shared"))
    # A padded name of n letters has n + Q - 1 grams, and an edit changes Q of them at most.
    enough = F.greatest(F.length("old_name"), F.length("new_name")) + (Q - 1) - edits * Q
    pairs = counted.where(F.col("shared") >= enough).withColumn("edits", F.levenshtein(F.lower("old_name"), F.lower("new_name")))
    close = pairs.where(F.col("edits") <= edits)
    best = Window.partitionBy("old_name").orderBy("edits", "new_name")
    return close.withColumn("rk", F.row_number().over(best)).where("rk = 1").select(
        "old_name", "new_name", F.col("edits").cast("bigint").alias("edits")
    )
