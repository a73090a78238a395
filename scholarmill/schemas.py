"""Explicit schemas of the canonical relations."""

from __future__ import annotations

PROFESSORS = (
    "id string, name string, department string, paper_count bigint, lab_member_count bigint, "
    "lab_url string, scholar_url string, dblp_url string, university_id string, "
    "research_sub_fields array<bigint>"
)
UNIVERSITIES = "id string, name string"
RESEARCH_FIELDS = "id bigint, name string, category_id bigint"
RESEARCH_SUB_FIELDS = "id bigint, name string, field_id bigint"
PROFESSOR_RESEARCH_FIELDS = "id bigint, professor_id string, field_id bigint"
PROFESSOR_SUB_FIELDS = "professor_research_field_id bigint, sub_field_id bigint"
BOOKMARKS = "user_id string, lab_id string"
USERS = "id string, email string"
REGISTRATIONS = "email string, display_name string, password string, confirm_password string"
AREAS = "id string, name string, sub_field_ids array<bigint>"
TAXONOMY = (
    "category_id bigint, category string, field_id bigint, field string, "
    "sub_field_id bigint, sub_field string"
)
SELECTIONS = "selection_id string, field string, sub_field string"
TOGGLE_EVENTS = "session string, ord bigint, kind string, field string, sub_field string"
CHAT_CHUNKS = "message_id string, seq bigint, text string"
URL_SHEET = "lab_id string, url string"

# What a page extraction delivers, one JSON document per lab.
EXTRACTED_LAB = (
    "name string, department string, university string, lab_url string, scholar_url string, "
    "dblp_url string, paper_count bigint, lab_member_count bigint, research_sub_fields array<bigint>"
)

# Source tables. Stated here so that opening a table reads no file footers.
SOURCE_TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "benchmark": "item_id bigint, text string",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
