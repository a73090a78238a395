"""From crawled pages and extracted documents to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmill.functions.rules import Rules
from scholarmill.functions.text import host_of, link_kind, page_links, page_text, page_title

CORRUPT = "_corrupt_record"
MIN_PAGE_TEXT = 500


def json_fields(rows: DataFrame, column: str, schema: str) -> DataFrame:
    """Decode a JSON column into the fields of ``schema``."""
    parsed = rows.withColumn("_json", F.from_json(column, schema))
    return parsed.select(*[c for c in rows.columns if c != column], "_json.*")


def extracted_records(rows: DataFrame, column: str, schema: str) -> DataFrame:
    """Decode a JSON column through a fixed schema and flag the rows that do not fit it."""
    typed = T.StructType.fromDDL(schema).add(CORRUPT, T.StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = rows.withColumn("_json", F.from_json(column, typed, options))
    fields = [F.col(f"_json.{f.name}") for f in typed.fields if f.name != CORRUPT]
    return parsed.select(
        *[c for c in rows.columns if c != column],
        *fields,
        F.col(f"_json.{CORRUPT}").isNotNull().alias("is_corrupt"),
    )


def cleaned_pages(pages: DataFrame) -> DataFrame:
    """Title and visible text of every page, with its size before and after."""
    return pages.select(
        "page_id",
        page_title(F.col("html")).alias("title"),
        page_text(F.col("html")).alias("text"),
        F.length("html").cast("bigint").alias("chars_before"),
    ).withColumn("chars_after", F.length("text").cast("bigint"))


def page_link_rows(pages: DataFrame) -> DataFrame:
    """Every link of every page with its kind."""
    links = pages.select(
        "page_id", host_of(F.col("url")).alias("own_host"), F.explode(page_links(F.col("html"))).alias("link")
    ).withColumn("host", host_of(F.col("link")))
    return links.select("page_id", "link", link_kind(F.col("link"), F.col("host"), F.col("own_host")).alias("kind"))


def page_rules() -> Rules:
    """Rules for a crawled page, on the columns title, text and n_links."""
    return [
        ("no_title", F.length("title") == 0),
        ("short_text", F.length("text") < MIN_PAGE_TEXT),
        ("no_links", F.col("n_links") == 0),
    ]


def measured_pages(pages: DataFrame) -> DataFrame:
    """The columns that ``page_rules`` looks at."""
    return pages.select(
        "page_id",
        page_title(F.col("html")).alias("title"),
        page_text(F.col("html")).alias("text"),
        F.size(page_links(F.col("html"))).alias("n_links"),
    )
