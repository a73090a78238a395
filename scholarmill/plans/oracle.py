"""The same queries as plain SQL for an independent engine.

Written from the definitions, not from the Spark plans: ids are unnested and joined, selections are
joined by name, toggles are replayed one by one, recommendations score every user against every lab.
"""

from __future__ import annotations

from scholarmill.constants import (
    AREAS,
    SIZE_CRITERIA,
    SIZE_LABELS,
    TRIM_CLASS,
    UNKNOWN,
    taxonomy_rows,
)
from scholarmill.functions.text import ENTITIES, REFERENCE
from scholarmill.operators import inverted
from scholarmill.plans import catalogue as cat


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _values(name: str, columns: str, rows: list[tuple]) -> str:
    def cell(v) -> str:
        return _text(v) if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {body})"


def _selection(name: str, selection: dict[str, list[str]]) -> str:
    rows = [(field, sub) for field, subs in selection.items() for sub in subs]
    return _values(name, "field, sub_field", rows)


TAXONOMY = _values(
    "taxonomy", "category_id, category, field_id, field, sub_field_id, sub_field", taxonomy_rows()
)
AREA = _values(
    "area_member", "area, area_name, sub_field_id", [(a, n, i) for a, n, ids in AREAS for i in ids]
)

LAB = """
lab AS (
  SELECT c.c_custkey AS id, c.c_name AS name, c.c_mktsegment AS department,
         n.n_name AS university, coalesce(p.n, 0) AS paper_count,
         CASE WHEN c.c_acctbal >= 0 THEN CAST(floor(c.c_acctbal / 400) AS BIGINT) END AS members
  FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey AND n.n_name <> ''
  LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) p ON p.o_custkey = c.c_custkey
)"""

LAB_SUB = """
lab_sub AS (
  SELECT DISTINCT o.o_custkey AS id, CAST(substr(p.p_brand, 7) AS BIGINT) AS sub_field_id
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey JOIN orders o ON o.o_orderkey = l.l_orderkey
  WHERE l.l_quantity >= 45 AND l.l_returnflag = 'A'
),
lab_tax AS (SELECT s.id, t.* FROM lab_sub s JOIN taxonomy t USING (sub_field_id))"""

LABS = f"{TAXONOMY}, {LAB}, {LAB_SUB}"


def _pairs(name: str, event_type: str) -> str:
    return (
        f"{name} AS (SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS lab_id "
        f"FROM events WHERE event_type = '{event_type}')"
    )


BOOKMARK = _pairs("bookmark_row", "purchase") + ", bookmark AS (SELECT DISTINCT * FROM bookmark_row)"

RANK = """
SELECT row_number() OVER (ORDER BY sum(paper_count) DESC, university) AS rnk, university,
       CAST(sum(paper_count) AS BIGINT) AS paper_count, count(*) AS lab_count
FROM {source} GROUP BY university"""


def _ranking(matching: str, name: str = "ranking") -> str:
    source = f"(SELECT * FROM lab WHERE {matching})"
    return f"{name} AS ({RANK.format(source=source)})"


def _picked(table: str) -> str:
    return f"id IN (SELECT l.id FROM lab_tax l JOIN {table} s ON s.field = l.field AND s.sub_field = l.sub_field)"


def _in_fields(fields: list[str]) -> str:
    names = ", ".join(_text(f) for f in fields)
    return f"id IN (SELECT id FROM lab_tax WHERE field IN ({names}))"


def _size_case(column: str, labels: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {_text(k)} THEN {_text(v)}" for k, v in labels.items())
    return f"CASE {column} {whens} END"


SIZE = """CASE WHEN members IS NULL OR members = 0 THEN 'unknown' WHEN members >= 20 THEN 'large'
  WHEN members >= 8 THEN 'medium' ELSE 'small' END"""

DRILL = (
    f"WITH {LABS}, {_selection('sel', cat.DRILLDOWN_SELECTION)}, "
    f"kept AS (SELECT * FROM lab WHERE {_in_fields(cat.DRILLDOWN_ENABLED)} OR {_picked('sel')})"
)

REPLAY = f"""
WITH RECURSIVE {TAXONOMY},
field_subs AS (
  SELECT field, field_id, list(sub_field ORDER BY sub_field_id) AS names FROM taxonomy GROUP BY 1, 2
),
raw AS (
  SELECT user_id AS session, ts, event_id, event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
),
press AS (
  SELECT session, f.field, f.names,
         CASE WHEN event_type = 'signup' THEN 'field' ELSE 'sub' END AS kind,
         f.names[CAST((k // 5) % len(f.names) AS BIGINT) + 1] AS sub,
         row_number() OVER (PARTITION BY session, f.field ORDER BY ts, event_id) AS rn
  FROM raw JOIN field_subs f ON f.field_id = raw.k % 5 + 1
),
step AS (
  SELECT DISTINCT session, field, CAST(0 AS BIGINT) AS rn, false AS enabled,
         CAST([] AS VARCHAR[]) AS subs FROM press
  UNION ALL
  SELECT session, field, rn,
         CASE WHEN kind = 'sub' AND len(next_subs) = 0 THEN false
              WHEN kind = 'field' THEN NOT enabled ELSE enabled END,
         next_subs
  FROM (
    SELECT s.session, s.field, p.rn, p.kind, s.enabled,
           CASE WHEN p.kind = 'field' AND s.enabled THEN CAST([] AS VARCHAR[])
                WHEN p.kind = 'field' THEN p.names
                WHEN list_contains(s.subs, p.sub) THEN list_filter(s.subs, lambda x: x <> p.sub)
                ELSE list_append(s.subs, p.sub) END AS next_subs
    FROM step s JOIN press p ON p.session = s.session AND p.field = s.field AND p.rn = s.rn + 1
  )
),
final AS (
  SELECT session, field, arg_max(enabled, rn) AS enabled, list_sort(arg_max(subs, rn)) AS subs
  FROM step GROUP BY 1, 2
)"""

NAMED = "MAP {" + ", ".join(f"{_text(n)}: {_text(c)}" for n, c in ENTITIES) + "}"


def _decoded(text: str) -> str:
    """Character references one by one: what follows an ampersand is looked at up to its semicolon."""
    name = f"regexp_extract(p, '{REFERENCE}', 1)"
    hexadecimal = f"lower(substr({name}, 1, 2)) = '#x'"
    digits = f"CASE WHEN {hexadecimal} THEN CAST('0x' || substr({name}, 3) AS INTEGER) ELSE CAST(substr({name}, 2) AS INTEGER) END"
    point = f"CASE WHEN {digits} BETWEEN 1 AND 55295 OR {digits} BETWEEN 57344 AND 1114111 THEN chr({digits}) ELSE chr(65533) END"
    character = f"CASE WHEN {name} LIKE '#%' THEN {point} ELSE {NAMED}[{name}] END"
    one = f"coalesce({character} || substr(p, length({name}) + 2), '&' || p)"
    return f"array_to_string(list_transform(string_split({text}, '&'), lambda p, i: CASE WHEN i = 1 THEN p ELSE {one} END), '')"


def _plain(markup: str) -> str:
    tag = r"""(?s)<[A-Za-z/!?](?:[^>"'']|"[^"]*"|''[^'']*'')*>|<[^>]*>"""
    decoded = _decoded(f"regexp_replace({markup}, '{tag}', ' ', 'g')")
    return f"trim(regexp_replace({decoded}, '[\\s\\x{{00a0}}]+', ' ', 'g'))"


VISIBLE = _plain(
    "regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', ' ', 'g')"
)
TITLE = _plain("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")
# Opening tags of the markup that shows, of these the ones with an href, its value without quotes, decoded.
SHOWN = r"""regexp_replace(html, '<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', ' ', 'gis')"""
TAGS = rf"""regexp_extract_all({SHOWN}, '<[A-Za-z](?:[^>"'']|"[^"]*"|''[^'']*'')*>')"""
RAW = r"""regexp_extract(t, '\shref\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1, 'i')"""
QUOTED = """CASE WHEN v[1] IN ('"', '''') THEN substr(v, 2, length(v) - 2) ELSE v END"""
LINKS = (
    f"list_transform(list_transform(list_filter(list_transform({TAGS}, lambda t: {RAW}), lambda v: v <> ''), "
    f"lambda v: {QUOTED}), lambda v: trim({_decoded('v')}, ' '))"
)
HOST = "lower(regexp_extract({}, '^(?:https?:)?//(?:[^/?#@]*@)?([^/?#:]+)', 1, 'i'))"

TRIMMED = f"regexp_replace(text, '^[{TRIM_CLASS}]+|[{TRIM_CLASS}]+\\z', '', 'g')"


def _message_class() -> str:
    whens = " ".join(f"WHEN contains(text, {_text(n)}) THEN {_text(c)}" for n, c in cat.MESSAGE_RULES)
    return f"SELECT conv_id, turn, CASE {whens} ELSE 'other' END AS class FROM conversations"


def _keywords() -> str:
    rows = _values("kw", "word", [(k.lower(),) for k in cat.KEYWORDS])
    return f"""
WITH {rows},
hit AS (
  SELECT doc_id, (length(lower(text)) - length(replace(lower(text), word, ''))) // length(word) AS n
  FROM documents, kw
)
SELECT doc_id, count(*) AS n_matched, CAST(sum(n) AS BIGINT) AS score FROM hit WHERE n > 0 GROUP BY 1"""


ORACLE: dict[str, str] = {
    "q_ranking_by_subfield": f"""
WITH {LABS}, {_selection('sel', cat.SELECTION)}, {_ranking(_picked('sel'))}
SELECT *, '총 논문 수: ' || paper_count || '편 | 연구실: ' || lab_count || '개' AS summary FROM ranking""",
    "q_ranking_by_field": f"WITH {LABS}, {_ranking(_in_fields(cat.ENABLED))} SELECT * FROM ranking",
    "q_ranking_all": f"WITH {LAB}, {_ranking('true')} SELECT * FROM ranking",
    "q_ranking_multi_selection": f"""
WITH {LABS}, {_values('sel', 'selection_id, field, sub_field', cat.SELECTIONS)},
hit AS (
  SELECT DISTINCT s.selection_id, l.id FROM lab_tax l
  JOIN sel s ON s.field = l.field AND s.sub_field = l.sub_field
),
total AS (
  SELECT selection_id, university, CAST(sum(paper_count) AS BIGINT) AS paper_count, count(*) AS lab_count
  FROM hit JOIN lab USING (id) GROUP BY 1, 2
)
SELECT selection_id,
       row_number() OVER (PARTITION BY selection_id ORDER BY paper_count DESC, university) AS rnk,
       university, paper_count, lab_count FROM total""",
    "q_ranking_refresh_diff": f"""
WITH {LABS}, {_selection('sel', cat.SELECTION)}, {_selection('sel2', cat.LATER_SELECTION)},
{_ranking(_picked('sel'), 'before')}, {_ranking(_picked('sel2'), 'later')}
SELECT b.university, b.paper_count AS old_papers, a.paper_count AS new_papers,
       CASE WHEN a.university IS NULL THEN 'dropped' WHEN a.paper_count = b.paper_count THEN 'kept'
            ELSE 'changed' END AS status
FROM before b LEFT JOIN later a USING (university)""",
    "q_professor_directory": f"""
WITH {LAB},
linked AS (
  SELECT *, CASE department WHEN 'BUILDING' THEN NULL WHEN 'FURNITURE' THEN '' ELSE 'x' END AS mark FROM lab
),
full_url AS (
  SELECT *,
    CASE mark WHEN 'x' THEN 'https://lab.example.org/' || id ELSE mark END AS lab_url,
    CASE mark WHEN 'x' THEN 'https://scholar.google.com/citations?user=' || id ELSE mark END AS scholar_url,
    CASE mark WHEN 'x' THEN 'https://dblp.org/pid/' || id ELSE mark END AS dblp_url,
    CASE WHEN members IS NULL THEN '{UNKNOWN}' ELSE members || '명' END AS member_text
  FROM linked
)
SELECT CAST(id AS VARCHAR) AS id, name, university, department, paper_count,
       coalesce(members, 0) AS lab_member_count, lab_url, scholar_url, dblp_url,
       coalesce(lab_url, '') <> '' AS has_lab_url, coalesce(scholar_url, '') <> '' AS has_scholar_url,
       coalesce(dblp_url, '') <> '' AS has_dblp_url, member_text,
       university || ' | ' || department || ' | 논문 ' || paper_count || '편 | 연구원 ' || member_text AS summary
FROM full_url""",
    "q_field_profile": f"""
WITH {LABS}
SELECT id, field, CAST(min(category_id) AS VARCHAR) AS category,
       string_agg(sub_field, ', ' ORDER BY sub_field_id) AS sub_fields, count(*) AS n
FROM lab_tax GROUP BY id, field""",
    "q_lab_field_text": f"""
WITH {LABS}
SELECT lab.id, coalesce(string_agg(sub_field, ', ' ORDER BY sub_field_id), '') AS names_text,
       coalesce(string_agg(CAST(sub_field_id AS VARCHAR), ', ' ORDER BY sub_field_id), '정보 없음') AS ids_text
FROM lab LEFT JOIN lab_tax ON lab_tax.id = lab.id GROUP BY lab.id""",
    "q_lab_size": f"""
WITH {LAB}, sized AS (SELECT id, {SIZE} AS size FROM lab)
SELECT id, size, {_size_case('size', SIZE_LABELS)} AS short_label,
       CASE size WHEN 'unknown' THEN '{UNKNOWN}'
            ELSE {_size_case('size', SIZE_LABELS)} || ' 연구실' END AS long_label,
       {_size_case('size', SIZE_CRITERIA)} AS criteria FROM sized""",
    "q_drilldown": f"{DRILL} SELECT id, name, university, paper_count, {SIZE} AS size FROM kept",
    "q_drilldown_totals": f"""{DRILL}
SELECT university, CAST(sum(paper_count) AS BIGINT) AS total_papers, count(*) AS lab_count,
       '총 논문 수: ' || CAST(sum(paper_count) AS BIGINT) || ' | 연구실: ' || count(*) || '개' AS summary
FROM kept GROUP BY university""",
    "q_labs_in_university": f"""
WITH {LAB}
SELECT university, id, paper_count,
       row_number() OVER (PARTITION BY university ORDER BY paper_count DESC, id) AS pos FROM lab""",
    "q_university_lab_pages": f"""
WITH {LABS},
placed AS (
  SELECT lab.*, (SELECT count(DISTINCT field) FROM lab_tax x WHERE x.id = lab.id) AS n_fields,
         row_number() OVER (PARTITION BY university ORDER BY paper_count DESC, id) AS pos FROM lab
)
SELECT university, CAST((pos - 1) // {cat.LABS_PER_PAGE} AS BIGINT) AS page, count(*) AS n_labs,
       CAST(sum(paper_count) AS BIGINT) AS papers, string_agg(name, ', ' ORDER BY pos) AS lab_names,
       CAST(sum(n_fields) AS BIGINT) AS n_fields
FROM placed GROUP BY 1, 2""",
    "q_taxonomy_flat": f"""
WITH {LABS}
SELECT CAST(t.category_id AS VARCHAR) AS category, t.field, t.sub_field,
       CAST(t.sub_field_id AS BIGINT) AS sub_field_id, count(lab.id) AS n_labs,
       CAST(coalesce(sum(lab.paper_count), 0) AS BIGINT) AS papers
FROM taxonomy t LEFT JOIN lab_sub s ON s.sub_field_id = t.sub_field_id LEFT JOIN lab ON lab.id = s.id
GROUP BY ALL""",
    "q_area_members": f"""
WITH {AREA}, {LABS}
SELECT a.area, a.area_name, CAST(a.sub_field_id AS BIGINT) AS sub_field_id, count(s.id) AS n_labs
FROM area_member a LEFT JOIN lab_sub s ON s.sub_field_id = a.sub_field_id GROUP BY ALL""",
    "q_professor_detail": f"""
WITH {LABS}
SELECT lab.id, lab.university, CAST(1 AS BIGINT) AS lab_count,
       CAST(min(category_id) AS VARCHAR) AS category, field,
       string_agg(sub_field, ', ' ORDER BY sub_field_id) AS sub_fields
FROM lab LEFT JOIN lab_tax ON lab_tax.id = lab.id GROUP BY lab.id, lab.university, field""",
    "q_user_bookmarks": f"""
WITH {BOOKMARK}, {LAB}
SELECT b.user_id, b.lab_id, lab.name, lab.university FROM bookmark b JOIN lab ON lab.id = b.lab_id""",
    "q_bookmarks_in_area": f"""
WITH {BOOKMARK}, {AREA}, {LABS}
SELECT DISTINCT b.user_id, a.area, b.lab_id
FROM bookmark b JOIN lab_sub s ON s.id = b.lab_id JOIN area_member a ON a.sub_field_id = s.sub_field_id""",
    "q_bookmark_counts": f"WITH {BOOKMARK} SELECT user_id, count(*) AS n FROM bookmark GROUP BY 1",
    "q_bookmark_key_lists": f"""
WITH {BOOKMARK},
placed AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY lab_id) AS pos FROM bookmark
)
SELECT user_id, CAST((pos - 1) // 8 AS BIGINT) AS page, count(*) AS n,
       string_agg(CAST(lab_id AS VARCHAR), ', ' ORDER BY lab_id) AS lab_ids
FROM placed GROUP BY 1, 2""",
    "q_bookmark_flags": f"""
WITH {BOOKMARK}, {_pairs('probe', 'view')}
SELECT DISTINCT p.user_id, p.lab_id,
       EXISTS (SELECT 1 FROM bookmark b WHERE b.user_id = p.user_id AND b.lab_id = p.lab_id) AS is_bookmarked
FROM probe p""",
    "q_bookmark_apply_changes": f"""
WITH {BOOKMARK}, {_pairs('added', 'signup')}, {_pairs('removed', 'error')}
(SELECT * FROM bookmark EXCEPT SELECT * FROM removed) UNION SELECT * FROM added""",
    "q_toggle_state": f"""
WITH {_pairs('press', 'click')}
SELECT user_id, lab_id, count(*) AS n FROM press GROUP BY 1, 2 HAVING count(*) % 2 = 1""",
    "q_selection_state": f"""{REPLAY}
SELECT session, field, enabled, array_to_string(subs, ', ') AS subs FROM final""",
    "q_selection_edits": f"""{REPLAY},
chosen AS (SELECT * FROM final WHERE len(subs) > 0),
pick AS (
  SELECT session, coalesce(max(subs) FILTER (field = 'Systems'), CAST([] AS VARCHAR[])) AS systems,
         count(*) AS n_fields,
         count(*) FILTER (field NOT IN ('AI', 'Theory')) AS n_rest,
         coalesce(sum(len(subs)) FILTER (field NOT IN ('AI', 'Theory')), 0) AS subs_rest,
         list(field) FILTER (field NOT IN ('AI', 'Theory')) AS rest
  FROM chosen GROUP BY session
)
SELECT session,
       array_to_string(list_sort(CASE WHEN list_contains(systems, 'Databases')
         THEN list_filter(systems, lambda x: x <> 'Databases')
         ELSE list_append(systems, 'Databases') END), ', ') AS systems_after,
       list_contains(systems, 'Databases') AS had_databases, n_fields,
       array_to_string(list_sort(list_append(coalesce(rest, CAST([] AS VARCHAR[])), 'Theory')), ', ')
         AS fields_after,
       CAST(subs_rest + 1 AS BIGINT) AS n_subs_after
FROM pick""",
    "q_latest_event": """
SELECT user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "q_key_exists_once": """
SELECT c_custkey AS "key",
       (SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F'
          AND o_orderpriority = '1-URGENT') = 1 AS "exists"
FROM customer""",
    "q_row_validation": """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'R1' WHEN c_mktsegment = 'MACHINERY' THEN 'R2'
  WHEN length(c_mktsegment) < 9 THEN 'R3' ELSE 'ok' END AS first_failure FROM customer""",
    "q_quality_split": f"""
WITH measured AS (
  SELECT page_id, {TITLE} AS title, {VISIBLE} AS body, len({LINKS}) AS n_links FROM pages
),
reason AS (
  SELECT page_id, concat_ws(',', CASE WHEN title = '' THEN 'no_title' END,
    CASE WHEN length(body) < 500 THEN 'short_text' END,
    CASE WHEN n_links = 0 THEN 'no_links' END) AS reasons FROM measured
)
SELECT page_id, CASE WHEN reasons = '' THEN 'valid' ELSE 'quarantine' END AS status, reasons FROM reason""",
    "q_upsert_latest": """
SELECT user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    "q_staged_load": """
WITH row_kept AS (
  SELECT *, ts IS NULL OR ts < TIMESTAMP '2024-01-10' AS earlier FROM events
)
SELECT user_id, event_type, value FROM row_kept
WHERE earlier OR (value >= 1 AND event_type <> 'error')
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    "q_refresh_latest": """
SELECT user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    "q_url_sheet": "SELECT CAST(page_id AS VARCHAR) AS lab_id, url FROM pages WHERE url <> ''",
    "q_paper_fallback": """
WITH counts AS (
  SELECT c_custkey AS id, count(o_orderkey) AS known,
         count(o_orderkey) FILTER (o_orderstatus = 'F') AS finished
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1
)
SELECT id, CASE WHEN finished > 0 THEN finished ELSE known END AS papers,
       CASE WHEN finished > 0 THEN 'primary' WHEN known > 0 THEN 'secondary' ELSE 'none' END AS source
FROM counts""",
    "q_user_turns_clean": f"""
WITH u AS (SELECT conv_id, turn, {TRIMMED} AS text FROM conversations WHERE role = 'user')
SELECT * FROM u WHERE text <> ''""",
    "q_message_class": _message_class(),
    "q_conversation_text": f"""
WITH u AS (
  SELECT conv_id, turn, role, CASE WHEN role = 'user' THEN {TRIMMED} ELSE text END AS text FROM conversations
)
SELECT conv_id, CAST(turn // 64 AS BIGINT) AS segment,
       string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS transcript, count(*) AS n_turns
FROM u WHERE role <> 'user' OR text <> '' GROUP BY 1, 2""",
    "q_message_text": """
SELECT conv_id AS message_id, CAST(turn // 4 AS BIGINT) AS segment,
       string_agg(text, '' ORDER BY turn) AS text, count(*) AS n_parts
FROM conversations WHERE role = 'assistant' AND text <> '' GROUP BY 1, 2""",
    "q_event_props": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "q_extract_records": """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       NOT json_valid(props) AS is_corrupt FROM events""",
    "q_page_text": f"""
WITH cleaned AS (
  SELECT page_id, {TITLE} AS title, {VISIBLE} AS text, CAST(length(html) AS BIGINT) AS chars_before FROM pages
)
SELECT *, CAST(length(text) AS BIGINT) AS chars_after FROM cleaned""",
    "q_page_links": f"""
WITH link_row AS (SELECT page_id, url, unnest({LINKS}) AS link FROM pages),
hosted AS (SELECT *, {HOST.format('link')} AS host, {HOST.format('url')} AS own FROM link_row)
SELECT page_id, link,
       CASE WHEN starts_with(host, 'scholar.google.') THEN 'scholar'
            WHEN host IN ('dblp.org', 'dblp.uni-trier.de') THEN 'dblp'
            WHEN NOT starts_with(link, '//') AND NOT regexp_matches(split_part(link, '/', 1), '^[A-Za-z][A-Za-z0-9+.-]*:') THEN 'home'
            WHEN host <> '' AND host = own THEN 'home' ELSE 'other' END AS kind
FROM hosted""",
    "q_keyword_search": _keywords(),
    "q_name_search": f"""
WITH {LAB}
SELECT university, CAST(sum(paper_count) AS BIGINT) AS paper_count, count(*) AS lab_count
FROM lab WHERE contains(lower(university), '{cat.NAME_TERM}') GROUP BY 1""",
    "q_vector_topk": f"""
WITH dims AS (
  SELECT label, vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings
),
mean AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS m FROM dims GROUP BY 1, 2),
profile AS (SELECT CAST(label AS BIGINT) AS qid, list(m ORDER BY i) AS v FROM mean GROUP BY 1),
scored AS (
  SELECT qid, vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), v), 6) AS sim
  FROM profile, embeddings
)
SELECT qid, vec_id, sim, row_number() OVER (PARTITION BY qid ORDER BY sim DESC, vec_id) AS rk
FROM scored QUALIFY rk <= {cat.TOP_K}""",
    "q_recommend": f"""
WITH {BOOKMARK}, {LABS},
lab_field AS (SELECT DISTINCT id, field FROM lab_tax),
interest AS (SELECT DISTINCT b.user_id, l.field FROM bookmark b JOIN lab_field l ON l.id = b.lab_id),
scored AS (
  SELECT i.user_id, l.id AS lab_id, count(*) AS score
  FROM interest i JOIN lab_field l USING (field) GROUP BY 1, 2
)
SELECT s.user_id, s.lab_id, s.score,
       row_number() OVER (PARTITION BY s.user_id ORDER BY s.score DESC, lab.paper_count DESC, s.lab_id) AS rk
FROM scored s JOIN lab ON lab.id = s.lab_id
WHERE NOT EXISTS (SELECT 1 FROM bookmark b WHERE b.user_id = s.user_id AND b.lab_id = s.lab_id)
QUALIFY rk <= {cat.TOP_K}""",
    "q_compare_labs": f"""
WITH {LABS},
placed AS (
  SELECT *, row_number() OVER (PARTITION BY university ORDER BY paper_count DESC, id) AS pos FROM lab
)
SELECT a.id AS lab_a, b.id AS lab_b, a.paper_count - b.paper_count AS paper_diff,
       a.members - b.members AS member_diff,
       (SELECT count(*) FROM lab_sub x JOIN lab_sub y USING (sub_field_id)
        WHERE x.id = a.id AND y.id = b.id) AS shared_sub_fields
FROM placed a JOIN placed b ON b.university = a.university AND b.pos = a.pos + 1""",
    "q_paper_trend": f"""
WITH {LABS},
lab_field AS (SELECT DISTINCT id, field FROM lab_tax),
total AS (
  SELECT f.field, CAST(extract(year FROM o.o_orderdate) AS BIGINT) AS year, count(*) AS papers
  FROM lab_field f JOIN orders o ON o.o_custkey = f.id GROUP BY 1, 2
),
calendar AS (
  SELECT field, unnest(generate_series(min(year), max(year))) AS year FROM total GROUP BY field
),
known AS (SELECT c.field, c.year, coalesce(t.papers, 0) AS papers FROM calendar c LEFT JOIN total t USING (field, year))
SELECT a.field, a.year, a.papers, a.papers - b.papers AS change
FROM known a LEFT JOIN known b ON b.field = a.field AND b.year = a.year - 1""",
}
ORACLE["q_stored_ranking"] = ORACLE["q_ranking_by_subfield"]
ORACLE["q_bucketed_load"] = ORACLE["q_upsert_latest"]
ORACLE["q_message_stream"] = ORACLE["q_message_text"]
ORACLE["q_colocated_bookmarks"] = ORACLE["q_user_bookmarks"]
ORACLE["q_vector_cells"] = ORACLE["q_vector_topk"]
ORACLE["q_name_grams"] = f"""
WITH {_values('wanted', 'term', [(n,) for n in cat.NAME_TERMS])}
SELECT term, c_custkey AS id, c_name AS name FROM customer, wanted WHERE contains(lower(c_name), lower(term))"""
ORACLE["q_renamed_universities"] = """
WITH later AS (
  SELECT CASE WHEN n_nationkey % 5 = 0 THEN 'completely other ' || n_nationkey
              WHEN n_nationkey % 2 = 0 THEN n_name || 's' ELSE n_name END AS name FROM nation
),
pair AS (
  SELECT n_name AS old_name, name AS new_name, levenshtein(lower(n_name), lower(name)) AS edits
  FROM nation, later WHERE n_name NOT IN (FROM later) AND name NOT IN (SELECT n_name FROM nation)
)
SELECT * FROM pair WHERE edits <= least(length(old_name) // 5, 3)
QUALIFY row_number() OVER (PARTITION BY old_name ORDER BY edits, new_name) = 1"""
ORACLE["q_kept_ranking"] = f"""
WITH {LABS}, {_values('sel', 'selection_id, field, sub_field', cat.SELECTIONS)},
edit AS (
  SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS id, event_type, event_id
  FROM events WHERE event_type IN ('error', 'signup')
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY event_id DESC) = 1
),
edited AS (
  SELECT lab.id, coalesce(n.n_name, lab.university) AS university,
         CASE WHEN e.id IS NULL THEN lab.paper_count ELSE e.event_id % 100 END AS paper_count
  FROM lab LEFT JOIN edit e USING (id) LEFT JOIN nation n ON n.n_nationkey = (e.id + e.event_id) % 25
  WHERE e.id IS NULL OR e.event_type <> 'error'
),
hit AS (
  SELECT DISTINCT s.selection_id, l.id FROM lab_tax l
  JOIN sel s ON s.field = l.field AND s.sub_field = l.sub_field
),
total AS (
  SELECT selection_id, university, CAST(sum(paper_count) AS BIGINT) AS paper_count, count(*) AS lab_count
  FROM hit JOIN edited USING (id) GROUP BY 1, 2
)
SELECT selection_id,
       row_number() OVER (PARTITION BY selection_id ORDER BY paper_count DESC, university) AS rnk,
       university, paper_count, lab_count FROM total"""
WANTED = f"""
{_values('sel', 'selection_id, field, sub_field', cat.SELECTIONS)},
wanted AS (
  SELECT selection_id, sub_field_id FROM sel JOIN taxonomy USING (field, sub_field)
  UNION ALL SELECT 'area ' || area, sub_field_id FROM area_member
)"""
ORACLE["q_selection_lab_counts"] = f"""
WITH {AREA}, {LABS}, {WANTED}
SELECT w.selection_id, count(DISTINCT s.id) AS n_labs
FROM wanted w LEFT JOIN lab_sub s ON s.sub_field_id = w.sub_field_id
  AND s.id IN (SELECT c_custkey FROM customer) GROUP BY 1"""
ORACLE["q_selection_university_counts"] = f"""
WITH {AREA}, {LABS}, {WANTED}
SELECT w.selection_id, CAST(c.c_nationkey AS VARCHAR) AS university_id, count(DISTINCT s.id) AS n_labs
FROM wanted w JOIN lab_sub s ON s.sub_field_id = w.sub_field_id JOIN customer c ON c.c_custkey = s.id GROUP BY 1, 2"""
ORACLE["q_set_rules"] = """
WITH purchase AS (
  SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS lab_id, value
  FROM events WHERE event_type = 'purchase'
),
reason AS (
  SELECT event_id, concat_ws(',', CASE WHEN value IS NULL OR value < 10 THEN 'small' END,
    CASE WHEN lab_id IS NULL OR user_id IS NULL OR count(*) OVER (PARTITION BY user_id, lab_id) > 1 THEN 'repeated' END,
    CASE WHEN lab_id IS NULL OR lab_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) THEN 'unknown_lab' END
  ) AS reasons FROM purchase
)
SELECT event_id, CASE WHEN reasons = '' THEN 'valid' ELSE 'quarantine' END AS status, reasons FROM reason"""
WORDS = "regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+')"
ORACLE["q_text_search"] = f"""
WITH word AS (SELECT doc_id, unnest({WORDS}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS times FROM word GROUP BY 1, 2),
df AS (SELECT term, count(*) AS n_docs FROM tf GROUP BY 1),
size AS (SELECT doc_id, len({WORDS}) AS length FROM documents),
total AS (SELECT count(*) AS n, avg(length) AS mean_length FROM size),
asked AS (SELECT DISTINCT item_id AS qid, unnest({WORDS}) AS term FROM benchmark),
scored AS (
  SELECT qid, doc_id, count(*) AS n_terms,
         round(sum(ln(1 + (n - n_docs + 0.5) / (n_docs + 0.5)) * times * {inverted.K1 + 1}
               / (times + {inverted.K1} * (1 - {inverted.B} + {inverted.B} * length / mean_length))), {inverted.DIGITS}) AS score
  FROM asked JOIN tf USING (term) JOIN df USING (term) JOIN size USING (doc_id), total GROUP BY 1, 2
)
SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rk FROM scored QUALIFY rk <= {cat.TOP_K}"""
