"""Every query by name: ``fn(spark, folder) -> DataFrame`` with flat columns.

Queries run over whole tables and for all users, labs and universities at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarmill import schemas
from scholarmill.constants import AREAS, AUTH_MESSAGE_RULES
from scholarmill.functions import collections as coll
from scholarmill.functions.labs import size_class, size_criteria, size_label, size_text
from scholarmill.functions.rules import first_failure
from scholarmill.functions.text import first_match
from scholarmill.operators import (
    bitmaps,
    bookmarks,
    cells,
    conversations,
    detail,
    grams,
    ingest,
    inverted,
    quality,
    ranking,
    search,
    state,
    taxonomy,
    trends,
)
from scholarmill.session import scratch_folder, stored
from scholarmill.sources import files
from scholarmill.sources.buckets import BucketTable
from scholarmill.sources.rankings import KeptRankings
from scholarmill.sources.relations import Relations, publish, publish_colocated
from scholarmill.sources.tables import Tables
from scholarmill.streaming import jobs
from scholarmill.streaming.assembly import Assembly

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries.
SELECTION = {"Systems": ["Computer security", "Databases"], "Theory": ["Cryptography"]}
LATER_SELECTION = {"Systems": ["Databases"], "AI": ["Machine learning"]}
ENABLED = ["AI", "Theory"]
DRILLDOWN_ENABLED = ["Theory"]
DRILLDOWN_SELECTION = {"AI": ["Machine learning"]}
SELECTIONS = [
    ("security", "Systems", "Computer security"),
    ("security", "Theory", "Cryptography"),
    ("data", "Systems", "Databases"),
    ("data", "AI", "Machine learning"),
    ("data", "AI", "The Web & information retrieval"),
    ("graphics", "Interdisciplinary Areas", "Computer graphics"),
    ("graphics", "Interdisciplinary Areas", "Visualization"),
    ("misplaced", "AI", "Databases"),
]
KEYWORDS = ["thering", "tion", "éeau", "ción", "ung"]
NAME_TERM = "nation_1"
NAME_TERMS = ["customer#00000000", "0012", "99", "7", "STOMER", "nobody", "#"]
MESSAGE_RULES = [*AUTH_MESSAGE_RULES, ("tion", "english_like"), ("ción", "spanish_like"), ("eau", "french_like")]
TOP_K = 5
LABS_PER_PAGE = 25

REGISTRY: dict[str, Query] = {}


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    REGISTRY[fn.__name__] = lambda spark, folder: fn(Tables(spark, folder))
    return fn


# ---- Rankings ----------------------------------------------------------------------------------


@query
def q_ranking_by_subfield(t: Tables) -> DataFrame:
    labs = t.labs(papers=True, sub_fields=True)
    return ranking.with_summary(ranking.rank_universities(labs, t.universities(), SELECTION, taxonomy=t.taxonomy()))


@query
def q_ranking_by_field(t: Tables) -> DataFrame:
    labs = t.labs(papers=True, sub_fields=True)
    return ranking.rank_universities(labs, t.universities(), enabled=ENABLED, taxonomy=t.taxonomy())


@query
def q_ranking_all(t: Tables) -> DataFrame:
    return ranking.rank_universities(t.labs(papers=True), t.universities())


@query
def q_ranking_multi_selection(t: Tables) -> DataFrame:
    selections = taxonomy.constant_relation(t.spark, SELECTIONS, schemas.SELECTIONS)
    labs = t.labs(papers=True, sub_fields=True)
    return ranking.rank_selections(labs, t.universities(), selections, t.sub_fields(), t.fields())


@query
def q_kept_ranking(t: Tables) -> DataFrame:
    """The rankings of all selections from kept sums, after two feeds of edits that overlap in time."""
    labs = stored(t.labs(papers=True, sub_fields=True))
    kept = KeptRankings(t.spark, scratch_folder(t.spark), "bigint", "bigint", buckets=16)
    columns = ["id", "university_id", "paper_count", "research_sub_fields"]
    kept.apply(labs.select(*columns, F.lit(False).alias("deleted"), F.lit(-1).cast("bigint").alias("ord")))
    edits = stored(t.lab_edits(labs))
    for rest in (1, 0):
        kept.apply(edits.where(F.col("ord") % 2 == rest))
    selections = taxonomy.constant_relation(t.spark, SELECTIONS, schemas.SELECTIONS)
    return kept.rank(t.universities(), selections, t.sub_fields(), t.fields())


def _wanted(t: Tables) -> DataFrame:
    """Sub-fields of the selections and of the areas, by name."""
    selections = taxonomy.constant_relation(t.spark, SELECTIONS, schemas.SELECTIONS)
    named = selections.join(taxonomy.sub_field_dim(t.sub_fields(), t.fields()), ["field", "sub_field"])
    areas = [(f"area {area}", i) for area, _, ids in AREAS for i in ids]
    listed = taxonomy.constant_relation(t.spark, areas, "selection_id string, sub_field_id bigint")
    return named.select("selection_id", "sub_field_id").unionByName(listed)


@query
def q_selection_lab_counts(t: Tables) -> DataFrame:
    index = stored(bitmaps.lab_index(t.labs(sub_fields=True), "id"))
    return bitmaps.matching_labs(index, _wanted(t))


@query
def q_selection_university_counts(t: Tables) -> DataFrame:
    index = stored(bitmaps.lab_index(t.labs(sub_fields=True), "id"))
    return bitmaps.matching_labs_by_university(index, _wanted(t))


@query
def q_ranking_refresh_diff(t: Tables) -> DataFrame:
    labs = t.labs(papers=True, sub_fields=True)
    return ranking.selection_diff(labs, t.universities(), SELECTION, LATER_SELECTION, t.taxonomy())


# ---- Labs --------------------------------------------------------------------------------------


@query
def q_professor_directory(t: Tables) -> DataFrame:
    return ranking.directory(t.labs(papers=True), t.universities())


@query
def q_field_profile(t: Tables) -> DataFrame:
    profiles = taxonomy.with_field_profile(t.labs(sub_fields=True), t.taxonomy())
    return profiles.select("id", F.explode("research_fields").alias("f")).select(
        "id",
        "f.field",
        "f.category",
        F.array_join("f.sub_fields", ", ").alias("sub_fields"),
        F.size("f.sub_fields").cast("bigint").alias("n"),
    )


@query
def q_lab_field_text(t: Tables) -> DataFrame:
    profiles = taxonomy.with_field_profile(t.labs(sub_fields=True), t.taxonomy())
    return profiles.select(
        "id",
        coll.names_text(F.col("research_fields")).alias("names_text"),
        coll.ids_text(F.col("research_sub_fields")).alias("ids_text"),
    )


@query
def q_lab_size(t: Tables) -> DataFrame:
    size = F.col("size")
    return (
        t.labs()
        .select("id", size_class(F.col("lab_member_count")).alias("size"))
        .select(
            "id",
            "size",
            size_label(size).alias("short_label"),
            size_text(size).alias("long_label"),
            size_criteria(size).alias("criteria"),
        )
    )


@query
def q_drilldown(t: Tables) -> DataFrame:
    labs = t.labs(papers=True, sub_fields=True)
    return ranking.drilldown(labs, t.universities(), DRILLDOWN_SELECTION, DRILLDOWN_ENABLED, t.taxonomy())


@query
def q_drilldown_totals(t: Tables) -> DataFrame:
    labs = t.labs(papers=True, sub_fields=True)
    return ranking.drilldown_totals(labs, t.universities(), DRILLDOWN_SELECTION, DRILLDOWN_ENABLED, t.taxonomy())


@query
def q_labs_in_university(t: Tables) -> DataFrame:
    return ranking.labs_in_university(t.labs(papers=True), t.universities())


@query
def q_university_lab_pages(t: Tables) -> DataFrame:
    labs = t.labs(papers=True, sub_fields=True)
    pages = ranking.lab_pages(labs, t.universities(), LABS_PER_PAGE, t.taxonomy())
    return pages.select(
        "university",
        "page",
        F.size("labs").cast("bigint").alias("n_labs"),
        F.aggregate("labs", F.lit(0).cast("bigint"), lambda acc, x: acc + x["paper_count"]).alias("papers"),
        F.array_join(F.transform("labs", lambda x: x["name"]), ", ").alias("lab_names"),
        F.aggregate(
            "labs", F.lit(0).cast("bigint"), lambda acc, x: acc + F.size(x["research_fields"])
        ).alias("n_fields"),
    )


@query
def q_taxonomy_flat(t: Tables) -> DataFrame:
    return taxonomy.sub_field_usage(t.labs(papers=True, sub_fields=True), t.sub_fields(), t.fields())


@query
def q_area_members(t: Tables) -> DataFrame:
    return taxonomy.area_usage(t.spark, t.labs(sub_fields=True))


@query
def q_professor_detail(t: Tables) -> DataFrame:
    lab_fields, lab_sub_fields = t.lab_bridges(t.labs(sub_fields=True))
    nested = detail.lab_detail(
        t.labs(papers=True),
        t.universities(),
        lab_fields,
        lab_sub_fields,
        t.fields(),
        t.sub_fields(),
    )
    return detail.detail_rows(nested)


# ---- Bookmarks ---------------------------------------------------------------------------------


@query
def q_user_bookmarks(t: Tables) -> DataFrame:
    found = bookmarks.bookmarked_labs(t.bookmarks(), t.labs(), t.universities())
    return found.select("user_id", "lab_id", "name", "university")


@query
def q_colocated_bookmarks(t: Tables) -> DataFrame:
    """``q_user_bookmarks`` over relations that are stored in buckets of the lab key."""
    folder = scratch_folder(t.spark)
    publish(t, f"{folder}/plain")
    prefix = f"labs_{uuid.uuid4().hex}"
    labs = publish_colocated(Relations(t.spark, f"{folder}/plain"), f"{folder}/buckets", prefix, buckets=8)
    found = bookmarks.bookmarked_labs(labs.bookmarks(), labs.labs(), labs.universities())
    return found.select(F.col("user_id").cast("bigint"), F.col("lab_id").cast("bigint"), "name", "university")


@query
def q_bookmarks_in_area(t: Tables) -> DataFrame:
    return bookmarks.bookmarks_by_area(t.bookmarks(), t.labs(sub_fields=True))


@query
def q_bookmark_counts(t: Tables) -> DataFrame:
    return bookmarks.bookmark_counts(t.bookmarks())


@query
def q_bookmark_key_lists(t: Tables) -> DataFrame:
    return bookmarks.bookmark_key_lists(t.bookmarks(), page_size=8)


@query
def q_bookmark_flags(t: Tables) -> DataFrame:
    probes = bookmarks.pairs(t.event_pairs("view"))
    return bookmarks.bookmark_flags(probes, t.bookmarks())


@query
def q_bookmark_apply_changes(t: Tables) -> DataFrame:
    return bookmarks.apply_changes(
        t.bookmarks(), inserts=t.event_pairs("signup"), deletes=t.event_pairs("error")
    )


@query
def q_toggle_state(t: Tables) -> DataFrame:
    return bookmarks.toggle_state(t.event_pairs("click"))


# ---- State -------------------------------------------------------------------------------------


def _selection_state(t: Tables) -> DataFrame:
    return state.fold_selection(t.selection_toggles(), order=("ts", "event_id"))


@query
def q_selection_state(t: Tables) -> DataFrame:
    names = state.sub_fields_of(F.col("selected"))
    return _selection_state(t).select(
        "session", "field", "enabled", F.array_join(names, ", ").alias("subs")
    )


@query
def q_selection_edits(t: Tables) -> DataFrame:
    """Every session's selection map after four edits: press one sub-field, clear one field, set
    another, count the keys."""
    chosen = _selection_state(t).where(F.col("selected") != 0)
    entry = F.struct("field", state.sub_fields_of(F.col("selected")).alias("subs"))
    maps = chosen.groupBy("session").agg(
        F.map_from_entries(F.collect_list(entry)).alias("picked")  # one entry per field
    )
    pressed = F.lit("Databases")
    toggled = coll.toggle_item(coll.items_at(F.col("picked"), F.lit("Systems")), pressed)
    edited = coll.with_entry(
        coll.without_key(F.col("picked"), F.lit("AI")), F.lit("Theory"), F.array(F.lit("Cryptography"))
    )
    return maps.select(
        "session",
        F.array_join(F.array_sort(toggled), ", ").alias("systems_after"),
        coll.contains(coll.items_at(F.col("picked"), F.lit("Systems")), pressed).alias("had_databases"),
        coll.key_count(F.col("picked")).cast("bigint").alias("n_fields"),
        F.array_join(F.array_sort(F.map_keys(edited)), ", ").alias("fields_after"),
        F.size(F.flatten(F.map_values(edited))).cast("bigint").alias("n_subs_after"),
    )


@query
def q_latest_event(t: Tables) -> DataFrame:
    events = t.read("events").select("user_id", "ts", "event_id", "event_type")
    newest = state.latest(events, ["user_id"], ["ts", "event_id"])
    return newest.select(
        "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts")
    )


# ---- Keys, rules, loading ----------------------------------------------------------------------


@query
def q_key_exists_once(t: Tables) -> DataFrame:
    targets = (
        t.read("orders")
        .where((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))
        .select(F.col("o_custkey").alias("key"))
    )
    probes = t.read("customer").select(F.col("c_custkey").alias("key"))
    return quality.exists_once(probes, targets, "key")


@query
def q_row_validation(t: Tables) -> DataFrame:
    rules = [
        ("R1", F.col("c_acctbal") < 0),
        ("R2", F.col("c_mktsegment") == "MACHINERY"),
        ("R3", F.length("c_mktsegment") < 9),
    ]
    return t.read("customer").select("c_custkey", first_failure(rules).alias("first_failure"))


@query
def q_quality_split(t: Tables) -> DataFrame:
    pages = ingest.measured_pages(t.read("pages"))
    return quality.checked(pages, ingest.page_rules()).select("page_id", "status", "reasons")


@query
def q_upsert_latest(t: Tables) -> DataFrame:
    events = t.read("events").select("user_id", "event_type", "value", "ts", "event_id")
    before = F.coalesce(F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz"), F.lit(True))
    earlier, later = events.where(before), events.where(~before)
    merged = quality.upsert(earlier, later, ["user_id", "event_type"], ["ts", "event_id"])
    return merged.select("user_id", "event_type", "value")


@query
def q_staged_load(t: Tables) -> DataFrame:
    """Events of the last days loaded over those before, in two stages; read back from the result."""
    events = t.read("events").select("user_id", "event_type", "value", "ts", "event_id")
    before = F.coalesce(F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz"), F.lit(True))
    rules = [("small", F.col("value") < 1), ("error", F.col("event_type") == "error")]
    folder = scratch_folder(t.spark)
    files.staged_load(
        t.spark, events.where(~before), rules, f"{folder}/staging", events.where(before),
        f"{folder}/final", ["user_id", "event_type"], ["ts", "event_id"],
    )
    return files.read_relation(t.spark, f"{folder}/final", events.schema).select("user_id", "event_type", "value")


@query
def q_refresh_latest(t: Tables) -> DataFrame:
    """The latest event per user and type, loaded as a stream of files into a table."""
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    folder = scratch_folder(t.spark)
    stream = jobs.read_events(t.spark, f"{t.folder}/events*.parquet", schema)
    jobs.refresh(stream, f"{folder}/table", f"{folder}/checkpoint", keys, order).awaitTermination()
    return jobs.current(t.spark, f"{folder}/table", schema, keys, order).select(*keys, "value")


@query
def q_bucketed_load(t: Tables) -> DataFrame:
    """Events loaded in three parts, the last ones first, into a table hashed by key."""
    schema = "user_id bigint, event_type string, value double, ts timestamp_ntz, event_id bigint"
    events = t.read("events").select("user_id", "event_type", "value", "ts", "event_id")
    table = BucketTable(t.spark, scratch_folder(t.spark), schema, ["user_id", "event_type"], buckets=16)
    for rest in (2, 0, 1):
        table.upsert(events.where(F.col("event_id") % 3 == rest), ["ts", "event_id"])
    return table.read().select("user_id", "event_type", "value")


@query
def q_set_rules(t: Tables) -> DataFrame:
    """Purchases staged under row rules, a key that must not repeat and a lab that must exist."""
    rows = t.read("events").where(F.col("event_type") == "purchase").select(
        "event_id", "user_id", F.get_json_object("props", "$.k").cast("bigint").alias("lab_id"), "value"
    )
    open_labs = t.labs().where("lab_member_count IS NOT NULL")
    sets = [quality.Unique("repeated", ["user_id", "lab_id"]), quality.Reference("unknown_lab", "lab_id", open_labs, "id")]
    staging = scratch_folder(t.spark)
    files.stage(rows, [("small", F.col("value") < 10)], staging, sets)
    staged = files.read_relation(
        t.spark, staging, "event_id bigint, user_id bigint, lab_id bigint, value double, reasons string, status string"
    )
    return staged.select("event_id", "status", "reasons")


@query
def q_url_sheet(t: Tables) -> DataFrame:
    """Page addresses written as a sheet and read back through its schema."""
    sheet = t.read("pages").select(F.col("page_id").cast("string").alias("lab_id"), "url")
    folder = scratch_folder(t.spark)
    sheet.write.csv(folder, header=True, mode="overwrite")
    return files.read_url_sheet(t.spark, folder)


@query
def q_stored_ranking(t: Tables) -> DataFrame:
    """The flagship over stored relations, the taxonomy's tables among them."""
    folder = scratch_folder(t.spark)
    publish(t, folder)
    return q_ranking_by_subfield(Relations(t.spark, folder))


@query
def q_paper_fallback(t: Tables) -> DataFrame:
    """Finished papers where a lab has any, all papers otherwise."""
    counts = t.papers().groupBy(F.col("lab_id").alias("id")).agg(
        F.nullif(F.count_if(F.col("status") == "F"), F.lit(0)).alias("finished"),
        F.count("*").alias("known"),
    )
    labs = t.labs().select("id").join(counts, "id", "left")
    return labs.select("id", *quality.with_fallback(F.col("finished"), F.col("known")))


# ---- Conversations -----------------------------------------------------------------------------


@query
def q_user_turns_clean(t: Tables) -> DataFrame:
    return conversations.user_turns(t.read("conversations"))


@query
def q_message_class(t: Tables) -> DataFrame:
    return t.read("conversations").select(
        "conv_id", "turn", first_match(F.col("text"), MESSAGE_RULES).alias("class")
    )


@query
def q_conversation_text(t: Tables) -> DataFrame:
    return conversations.transcripts(t.read("conversations"))


@query
def q_message_text(t: Tables) -> DataFrame:
    """Assistant turns taken as the deltas of one streamed reply per conversation."""
    chunks = t.read("conversations").where(F.col("role") == "assistant").select(
        F.col("conv_id").alias("message_id"), F.col("turn").alias("seq"), "text"
    )
    return conversations.message_text(chunks, per_segment=4)


@query
def q_message_stream(t: Tables) -> DataFrame:
    """The deltas of ``q_message_text`` as a stream of files: what has closed and what is still open."""
    turns = jobs.read_events(
        t.spark, f"{t.folder}/conversations*.parquet", "conv_id bigint, turn bigint, role string, text string", 1
    )
    sent = turns.where(F.col("role") == "assistant").select(
        F.col("conv_id").alias("message_id"), F.col("turn").alias("seq"), "text",
        F.timestamp_seconds(F.col("conv_id") * 60 + F.col("turn")).alias("ts"),
    )
    folder = scratch_folder(t.spark)
    replies = Assembly(f"{folder}/replies", kind="bigint", per_segment=4)
    replies.start(sent, f"{folder}/checkpoint").awaitTermination()
    return replies.whole(t.spark)


# ---- Ingest ------------------------------------------------------------------------------------


@query
def q_event_props(t: Tables) -> DataFrame:
    return ingest.json_fields(t.read("events").select("event_id", "props"), "props", "k bigint")


@query
def q_extract_records(t: Tables) -> DataFrame:
    rows = t.read("events").select("event_id", "props")
    return ingest.extracted_records(rows, "props", "k bigint")


@query
def q_page_text(t: Tables) -> DataFrame:
    return ingest.cleaned_pages(t.read("pages"))


@query
def q_page_links(t: Tables) -> DataFrame:
    return ingest.page_link_rows(t.read("pages"))


# ---- Search and trends -------------------------------------------------------------------------


@query
def q_keyword_search(t: Tables) -> DataFrame:
    return search.keyword_search(t.read("documents"), KEYWORDS)


@query
def q_text_search(t: Tables) -> DataFrame:
    """The best documents for every benchmark item, from an inverted index."""
    folder = scratch_folder(t.spark)
    inverted.build_index(t.read("documents"), folder)
    items = t.read("benchmark").select(F.col("item_id").alias("qid"), "text")
    return inverted.TextIndex(t.spark, folder).search(items, TOP_K)


@query
def q_name_search(t: Tables) -> DataFrame:
    found = search.named_like(t.universities(), NAME_TERM)
    return search.name_search(t.labs(papers=True, universities=found), found, NAME_TERM)


@query
def q_name_grams(t: Tables) -> DataFrame:
    """Labs whose name contains any of some terms, from an index of the names' letters."""
    folder = scratch_folder(t.spark)
    grams.build_names(t.labs().select("id", "name"), folder)
    terms = taxonomy.constant_relation(t.spark, [(term,) for term in NAME_TERMS], "term string")
    return grams.NameIndex(t.spark, folder).containing(terms).select("term", "id", "name")


@query
def q_renamed_universities(t: Tables) -> DataFrame:
    """Universities whose name has changed a little: even ids got a letter more, every fifth one is new."""
    old = t.universities()
    later = old.select(
        F.when(F.col("id") % 5 == 0, F.concat(F.lit("completely other "), F.col("id").cast("string")))
        .when(F.col("id") % 2 == 0, F.concat("name", F.lit("s")))
        .otherwise(F.col("name")).alias("name")
    )
    return grams.renamed(old, later)


@query
def q_vector_cells(t: Tables) -> DataFrame:
    """``q_vector_topk`` from cells that the triangle inequality prunes."""
    vectors, folder = t.read("embeddings"), scratch_folder(t.spark)
    cells.build_cells(vectors, folder)
    return cells.VectorCells(t.spark, folder).search(search.label_profiles(vectors), TOP_K)


@query
def q_vector_topk(t: Tables) -> DataFrame:
    vectors = t.read("embeddings")
    return search.vector_topk(vectors, search.label_profiles(vectors), TOP_K)


@query
def q_recommend(t: Tables) -> DataFrame:
    return search.recommend(t.labs(papers=True, sub_fields=True), t.bookmarks(), TOP_K, t.taxonomy())


@query
def q_compare_labs(t: Tables) -> DataFrame:
    labs = stored(t.labs(papers=True, sub_fields=True))
    placed = ranking.labs_in_university(labs, t.universities())
    return search.compare_labs(labs, search.neighbour_pairs(placed))


@query
def q_paper_trend(t: Tables) -> DataFrame:
    return trends.paper_trend(t.papers(), t.labs(sub_fields=True), t.taxonomy())
