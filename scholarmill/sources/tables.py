"""The canonical relations as views over the benchmark tables.

Each part of a lab is added by its own function, so a query scans only the tables behind the columns
it uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarmill.constants import FIELDS
from scholarmill.operators.taxonomy import (
    Taxonomy,
    constant_relation,
    listed,
    research_fields,
    research_sub_fields,
)
from scholarmill.schemas import SOURCE_TABLES

MEMBERS_PER_BALANCE = 400


class Tables:
    """Parquet tables of one folder and the relations derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        reader = self.spark.read.schema(SOURCE_TABLES[name])
        return reader.parquet(f"{self.folder}/{name}.parquet")

    def universities(self) -> DataFrame:
        return self.read("nation").select(
            F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")
        )

    def fields(self) -> DataFrame:
        return research_fields(self.spark)

    def sub_fields(self) -> DataFrame:
        return research_sub_fields(self.spark)

    def taxonomy(self) -> Taxonomy:
        return listed()

    def _lab_ids(self) -> DataFrame:
        return self.read("customer").select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("department"),
            F.col("c_nationkey").alias("university_id"),
            F.when(
                F.col("c_acctbal") >= 0, F.floor(F.col("c_acctbal") / MEMBERS_PER_BALANCE)
            ).alias("lab_member_count"),
            *self._urls(),
        )

    @staticmethod
    def _urls():
        """One department has no links, one has empty links, the others have all three."""
        department = F.col("c_mktsegment")
        key = F.col("c_custkey").cast("string")

        def url(prefix: str):
            return (
                F.when(department == "BUILDING", F.lit(None).cast("string"))
                .when(department == "FURNITURE", "")
                .otherwise(F.concat(F.lit(prefix), key))
            )

        return [
            url("https://lab.example.org/").alias("lab_url"),
            url("https://scholar.google.com/citations?user=").alias("scholar_url"),
            url("https://dblp.org/pid/").alias("dblp_url"),
        ]

    def papers(self) -> DataFrame:
        """One row per paper."""
        return self.read("orders").select(
            F.col("o_custkey").alias("lab_id"),
            F.year("o_orderdate").cast("bigint").alias("year"),
            F.col("o_orderstatus").alias("status"),
        )

    def _paper_counts(self, labs: DataFrame | None = None) -> DataFrame:
        orders = self.read("orders").select(F.col("o_custkey").alias("id"))
        if labs is not None:
            orders = orders.join(labs.select("id"), "id", "left_semi")
        return orders.groupBy("id").agg(F.count("*").alias("paper_count"))

    def _sub_fields(self) -> DataFrame:
        """Distinct sub-field ids per lab. At most one id per brand, so the set is small."""
        lines = (
            self.read("lineitem")
            .where((F.col("l_quantity") >= 45) & (F.col("l_returnflag") == "A"))
            .select("l_orderkey", "l_partkey")
        )
        brands = self.read("part").select(
            "p_partkey", F.substring("p_brand", 7, 10).cast("bigint").alias("sub_field_id")
        )
        orders = self.read("orders").select("o_orderkey", "o_custkey")
        return (
            lines.join(brands, lines["l_partkey"] == brands["p_partkey"])
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            # Distinct pairs are a hash aggregate; what is left to collect is a row per lab and id.
            .select(F.col("o_custkey").alias("id"), "sub_field_id")
            .distinct()
            .groupBy("id")
            .agg(F.array_sort(F.collect_list("sub_field_id")).alias("research_sub_fields"))
        )

    def labs(
        self, papers: bool = False, sub_fields: bool = False, universities: DataFrame | None = None
    ) -> DataFrame:
        """Labs; paper counts and sub-field ids only where asked for.

        With ``universities`` only their labs, and only these labs' papers are counted.
        """
        labs = self._lab_ids()
        if universities is not None:
            wanted = universities.select(F.col("id").alias("university_id"))
            labs = labs.join(wanted, "university_id", "left_semi")
        if papers:
            counts = self._paper_counts(None if universities is None else labs)
            labs = labs.join(counts, "id", "left").withColumn(
                "paper_count", F.coalesce("paper_count", F.lit(0))
            )
        if sub_fields:
            labs = labs.join(self._sub_fields(), "id", "left").withColumn(
                "research_sub_fields",
                F.coalesce("research_sub_fields", F.array().cast("array<bigint>")),
            )
        return labs

    def lab_bridges(self, labs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(professor_research_fields, professor_sub_fields) spelled out from the id arrays."""
        field_of = self.taxonomy().by_id(2)
        rows = labs.select(
            F.col("id").alias("professor_id"), F.explode("research_sub_fields").alias("sub_field_id")
        ).withColumn("field_id", field_of[F.col("sub_field_id")])
        key = (F.col("professor_id") * 10 + F.col("field_id")).alias("id")
        lab_fields = rows.select(key, "professor_id", "field_id").distinct()
        lab_sub_fields = rows.select(key.alias("professor_research_field_id"), "sub_field_id")
        return lab_fields, lab_sub_fields

    def event_pairs(self, event_type: str) -> DataFrame:
        """(user_id, lab_id) of one kind of event."""
        return (
            self._keyed_events()
            .where(F.col("event_type") == event_type)
            .select("user_id", F.col("k").cast("bigint").alias("lab_id"))
        )

    def _keyed_events(self) -> DataFrame:
        """Events with the key of their JSON properties. As a generator, json_tuple parses a row once;
        a scalar function would be evaluated again in every filter a join derives from it."""
        return self.read("events").select(
            "user_id", "ts", "event_id", "event_type", F.json_tuple("props", "k").alias("k")
        )

    def lab_edits(self, labs: DataFrame) -> DataFrame:
        """Errors read as deletions of a lab, sign-ups as a new number of papers at another university.

        (id, university_id, paper_count, research_sub_fields, deleted, ord) of labs that are there.
        """
        events = self._keyed_events().where(F.col("event_type").isin("error", "signup"))
        edits = events.select(F.col("k").cast("bigint").alias("id"), "event_type", F.col("event_id").alias("ord"))
        return edits.join(labs.select("id", "research_sub_fields"), "id").select(
            "id",
            F.pmod(F.col("id") + F.col("ord"), F.lit(25)).cast("bigint").alias("university_id"),
            (F.col("ord") % 100).alias("paper_count"),
            "research_sub_fields",
            (F.col("event_type") == "error").alias("deleted"),
            "ord",
        )

    def bookmarks(self) -> DataFrame:
        return self.event_pairs("purchase")

    def selection_toggles(self) -> DataFrame:
        """Events read as presses in the field selector: sign-ups press a field, the rest a sub-field."""
        fields = list(FIELDS.items())
        rows = []
        for k in range(100):
            field, names = fields[k % len(fields)]
            rows.append((k, field, names[k // len(fields) % len(names)]))
        buttons = constant_relation(self.spark, rows, "k bigint, field string, button string")
        events = self._keyed_events().select(
            F.col("user_id").alias("session"),
            "ts",
            "event_id",
            F.when(F.col("event_type") == "signup", "field").otherwise("sub").alias("kind"),
            F.col("k").cast("bigint").alias("k"),
        )
        sub_field = F.when(F.col("kind") == "sub", F.col("button")).alias("sub_field")
        return events.join(buttons, "k").select("session", "ts", "event_id", "kind", "field", sub_field)
