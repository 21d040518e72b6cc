"""SQL that states the expected result of each registered query over the same tables.

The SQL works from the structured columns wherever the query parses text, so it does not repeat
the parsing it checks.
"""

from __future__ import annotations

from layerloom.fixed_values import (
    AUDIT_HEADER,
    AUDIT_RULE,
    AUDIT_TITLE,
    AUDIT_TITLE_END,
    APPLIED_CONFIDENCES,
    BACKLINK_DASH,
    BACKLINK_HEADING,
    BACKLINK_HEADING_END,
    CLAIM_HEADING,
    COUNT_END,
    EVIDENCE_LEVELS,
    MYSTERY_HEADING,
    NOTE_MIDDLE,
    NOTE_PREFIX,
    NOTE_SUFFIX,
    NOTE_TITLE,
    PLACEHOLDERS,
    PREDICATE_LABELS,
    PREDICATES,
    REFERENCE_HEADING,
    UNVERIFIED,
)
from layerloom.plans.stand_ins import ANCHOR, ARC_RANGES, EVENT_VERBS, PAGE_SECTIONS, RUN, WORD_LEDGER

ORACLES: dict[str, str] = {}


def lit(value: str) -> str:
    """A SQL string; line breaks are spelled with chr(10)."""
    return "'" + value.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def case(column: str, pairs) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in pairs) + " END"


NL = "chr(10)"

OBS = f"""obs AS (
  SELECT event_id, ts, user_id, event_type, value,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
    CASE WHEN dayofyear(ts) > 300 THEN 1 ELSE 2 END::BIGINT AS edition,
    CASE WHEN dayofyear(ts) > 300 THEN dayofyear(ts) - 300 ELSE dayofyear(ts) END::BIGINT AS chapter_no,
    CASE WHEN dayofyear(ts) > 300 THEN dayofyear(ts) - 300 ELSE 5000 + dayofyear(ts) END::BIGINT AS number,
    'ch' || lpad(CAST(number AS VARCHAR), 4, '0') AS chapter,
    'user_' || user_id AS subject,
    {case("event_type", EVENT_VERBS.items())} AS verb,
    'key_' || CAST(json_extract_string(props, '$.k') AS BIGINT) AS object,
    event_id % 500 AS para
  FROM events)"""

PREDICATE_LIST = "[" + ",".join(lit(p) for p in PREDICATES) + "]"

CLAIMS = f"""{OBS}, claims AS (
  SELECT *, 'A_' || chapter || '_' || predicate || '_E_p' || user_id || '_key_' || k AS claim_id,
    event_type || ' of user ' || user_id AS title, strftime(ts, '%Y-%m-%d') AS created,
    'ME_key_' || k AS object_id,
    CASE WHEN value < 5 THEN 'weak' WHEN value < 20 THEN 'moderate' WHEN value < 100 THEN 'strong'
      ELSE 'explicit' END AS evidence_strength,
    event_type || ' seen with key ' || k AS statement,
    'E_' || chapter || '_' || subject || '_' || verb || '_' || object || '_p' || para AS observation_id,
    {case("predicate", PREDICATE_LABELS.items())} AS label
  FROM (SELECT *, {PREDICATE_LIST}[k % 7 + 1] AS predicate FROM obs))"""

MYSTERIES = """mysteries AS (
  SELECT conv_id, turn, 'ch' || CAST(5001 + conv_id % 30 AS VARCHAR) AS chapter, text AS question,
    'c' || conv_id || '_t' || turn AS title,
    'MY_ch' || CAST(5001 + conv_id % 30 AS VARCHAR) || '_c' || conv_id || '_t' || turn AS mystery_id
  FROM conversations)"""

CHAPTERS = """chapters AS (
  SELECT DISTINCT 'ch' || CAST(5000 + p_size AS VARCHAR) AS chapter FROM part)"""

GRAPH = f"WITH {CLAIMS}, {MYSTERIES}, {CHAPTERS}"

ARCS = "arcs(arc_id, lo, hi) AS (VALUES " + ", ".join(
    f"({lit(a[0])}, {a[3]}, {a[4]})" for a in ARC_RANGES
) + ")"

ENTITY_LEDGER = f"""ledger AS (
  SELECT subject AS name, 'user_' || arg_min(k, event_id) AS representative,
    CASE arg_min(event_type, event_id) WHEN 'error' THEN {lit(UNVERIFIED)}
      WHEN 'signup' THEN '表記一致' ELSE '明言' END AS confidence
  FROM obs GROUP BY subject)"""

ANCHORS = f"""anchors AS (
  SELECT page_id, url, unnest(range(1, len(targets) + 1)) AS pos, unnest(targets) AS target,
    unnest(displays) AS display
  FROM (SELECT page_id, url, regexp_extract_all(html, {lit(ANCHOR)}, 1) AS targets,
      regexp_extract_all(html, {lit(ANCHOR)}, 2) AS displays FROM pages))"""

# The links of both parts of a crawled page: its anchors, and its address in the front matter.
CITED = f"""{ANCHORS}, cited AS (
  SELECT page_id, pos, target FROM anchors UNION ALL SELECT page_id, 1, string_split(url, '#')[1] FROM pages)"""

KNOWN = """known AS (
  SELECT DISTINCT target FROM (SELECT unnest(string_split_regex(text, '\\s+')) AS target FROM benchmark)
  WHERE target <> '')"""

DOCS = """docs AS (
  SELECT doc_id, 'D_' || doc_id AS page_id, lang AS layer, source AS section,
    lang || '/' || source || '/D_' || doc_id || '.md' AS path, text, n_chars FROM documents)"""

# --- one-pass replacement, stated as replacement by private marks and then by representatives -----
# The applied names never overlap one another in a text (none begins with an ending of another),
# so marking them longest first equals the leftmost-longest single pass.
APPLIED = sorted((r for r in WORD_LEDGER if r[2] in APPLIED_CONFIDENCES), key=lambda r: -len(r[0]))
OPEN = [r for r in WORD_LEDGER if r[2] == UNVERIFIED]


def marked(text: str) -> str:
    for at, row in enumerate(APPLIED):
        text = f"replace({text}, {lit(row[0])}, chr({0xE000 + at}))"
    return text


def unmarked(text: str) -> str:
    for at, row in enumerate(APPLIED):
        text = f"replace({text}, chr({0xE000 + at}), {lit(row[1])})"
    return text


LEDGER_PAGES = f"""{DOCS}, marks AS (
  SELECT *, {marked(f"'then ' || layer || ']]' || {NL} || text || {NL}")} AS free,
    '[[the_' || doc_id || '|' AS head,
    '<!-- AUTO-GENERATED:l2ref -->' || {NL} || 'the ' || section || {NL} || '<!-- /AUTO-GENERATED:l2ref -->' AS tail
  FROM docs), done AS (
  SELECT *, head || {unmarked("free")} || tail AS body FROM marks), hits AS (
  SELECT page_id, name, representative, confidence,
    CAST(length(free) - length(replace(free, mark, '')) AS BIGINT) AS replaced, strpos(free, mark) AS first_at
  FROM marks, (VALUES {", ".join(
      f"({lit(r[0])}, {lit(r[1])}, {lit(r[2])}, chr({0xE000 + at}))" for at, r in enumerate(APPLIED)
  )}) AS names(name, representative, confidence, mark)
  WHERE contains(free, mark)), audit AS (
  SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY replaced DESC, first_at) AS seq,
    name, representative, confidence, replaced FROM hits), notes AS (
  SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY ord) AS seq, name, representative
  FROM done, (VALUES {", ".join(f"({lit(r[0])}, {lit(r[1])}, {r[3]})" for r in OPEN)})
    AS names(name, representative, ord)
  WHERE contains(body, name))"""

SECTION_TEXT = f"""section_text AS (
  SELECT done.page_id, CASE WHEN a.rows IS NULL AND n.lines IS NULL THEN '' ELSE
    {lit(AUDIT_RULE + AUDIT_TITLE + RUN + AUDIT_TITLE_END)} || {lit(chr(10) * 2 + AUDIT_HEADER)}
    || coalesce(a.rows, '') || coalesce({lit(NOTE_TITLE)} || n.lines, '') END AS section_text
  FROM done
  LEFT JOIN (SELECT page_id, string_agg('| ' || name || ' | ' || representative || ' | ' || confidence
      || ' | ' || replaced || ' |' || {NL}, '' ORDER BY seq) AS rows FROM audit GROUP BY page_id) a USING (page_id)
  LEFT JOIN (SELECT page_id, string_agg({lit(NOTE_PREFIX)} || name || {lit(NOTE_MIDDLE)} || representative
      || {lit(NOTE_SUFFIX)}, {NL} ORDER BY seq) AS lines FROM notes GROUP BY page_id) n USING (page_id))"""


def put(key: str, sql: str) -> None:
    ORACLES[key] = sql


# --- scans ---------------------------------------------------------------------------------------

put("scan_pages", f"WITH {DOCS} SELECT layer, section, path, page_id, sha256(text) AS text_sha256 FROM docs")
put("scan_facts", f"WITH {OBS} SELECT chapter, event_id, user_id, event_type, k FROM obs")
put("chapter_list", f"""WITH {OBS}
SELECT event_id, 1::BIGINT AS pos, user_id AS chapter FROM obs
UNION ALL SELECT event_id, 3, k FROM obs UNION ALL SELECT event_id, 4, para FROM obs""")
put("source_manifest", f"""WITH {DOCS} SELECT 'SRC_' || page_id AS id, page_id AS chapter,
  'raw/' || page_id || '.txt' AS local_path, 'sha256:' || sha256(text) AS checksum,
  'primary_text' AS source_type FROM docs""")
put("changed_sources", f"""WITH {DOCS} SELECT 'SRC_' || page_id AS id, 'sha256:' || sha256(text) AS checksum
FROM docs LEFT JOIN labels USING (doc_id) WHERE quality IS NULL OR (quality <> 1 AND upper(text) <> text)""")

# --- structure -----------------------------------------------------------------------------------

put("split_front_matter", f"""WITH {DOCS} SELECT page_id, layer <> 'es' AS has_front_matter,
  CASE WHEN layer = 'es' THEN '' ELSE 'id: ' || page_id || {NL} || 'source: "' || section || '"' END AS front_matter,
  md5(text) AS body_md5 FROM docs""")
put("typed_claims", f"""WITH {CLAIMS} SELECT claim_id, title, created, observation_id AS subject_id, predicate,
  object_id, 'hypothesized' AS epistemic_status, 'llm_verified' AS review_status, 'draft' AS document_status,
  chapter AS spoiler_after, evidence_strength, 'agent' AS proposed_kind, subject AS proposed_id,
  'checker_' || k AS reviewed_id, created AS reviewed_date, statement,
  '（' || event_type || '） by ' || subject AS quote,
  CAST([1, 1, 1, 2, 0][event_id % 5 + 1] AS BIGINT) AS n_locators, 'checked ' || event_id AS review_note
FROM claims""")
put("typed_references", f"""SELECT 'ME_' || page_id AS ref_id, 't' AS title, 'popular_culture' AS subtype,
  'c_ME_' || page_id AS canonical_name, 'Contemporary Culture' AS "domain", 'llm_verified' AS review_status,
  CAST(len(regexp_extract_all(html, {lit(ANCHOR)}, 1)) AS BIGINT) AS declared_count FROM pages""")
put("typed_mysteries", f"""WITH {MYSTERIES} SELECT mystery_id, title AS heading, '2026-10-21' AS created,
  'candidate' AS mystery_status, chapter AS spoiler_after, chapter AS introduced, 'a_' || conv_id AS proposed_id,
  md5(question) AS question_md5, 'turn ' || turn AS payoff_hint, 2::BIGINT AS n_quotes,
  md5(replace(question, {NL}, ' ')) AS first_quote_md5, turn + 2 AS p_end FROM mysteries""")
put("typed_episodes", f"""WITH {OBS} SELECT 'O_' || event_id || '_summary' AS episode_id, chapter,
  'ARC_01_first' AS arc, 'E_char_' || subject AS characters, 'E_term_key_' || k AS terminology,
  'E_item_user_' || k || ',E_item_key_' || para AS items, 0::BIGINT AS other_elements FROM obs""")
put("typed_entities", """SELECT 'E_char_' || c_custkey AS entity_id, c_name AS title, 'character' AS subtype,
  c_name AS canonical_name, c_mktsegment || ',n' || c_nationkey AS aliases, 'ch0001' AS first_appearance,
  'ch0002' AS spoiler_after FROM customer""")

ELEMENTS = f"""{OBS}, elements AS (
  SELECT event_id, 'O_' || event_id || '_summary' AS episode_id, chapter, 'char' AS kind, subject AS name,
    1::BIGINT AS pos FROM obs
  UNION ALL SELECT event_id, 'O_' || event_id || '_summary', chapter, 'term', 'key_' || k, 2 FROM obs
  UNION ALL SELECT event_id, 'O_' || event_id || '_summary', chapter, 'item', 'user_' || k, 3 FROM obs
  UNION ALL SELECT event_id, 'O_' || event_id || '_summary', chapter, 'item', 'key_' || para, 4 FROM obs)"""

put("episode_entities", f"""WITH {ELEMENTS} SELECT episode_id, chapter, kind, 'E_' || kind || '_' || name AS entity_id,
  pos FROM elements""")
put("extract_wikilinks", f"""WITH {ANCHORS}
SELECT page_id, 'body' AS part, pos, target, '' AS anchor, display FROM anchors
UNION ALL SELECT page_id, 'fm', 1, split_part(url, '#', 1),
  CASE WHEN contains(url, '#') THEN split_part(url, '#', 2) ELSE '' END, '' FROM pages""")
put("extract_links", f"""WITH {ANCHORS}
SELECT page_id, pos, display, target AS url, 'markdown' AS kind FROM anchors
UNION ALL SELECT page_id, pos, display, '/' || target, 'html' FROM anchors""")
put("parse_ids", f"""WITH {CLAIMS} SELECT event_id, claim_id, predicate, 'p' || user_id AS locator,
  'key_' || k AS slug, edition, chapter_no, chapter FROM claims""")
put("spo_observations", f"WITH {OBS} SELECT event_id, chapter, subject, verb, object, para FROM obs")
put("quote_locators", f"""WITH {OBS}, cited AS (
  SELECT event_id AS page_id, 1::BIGINT AS ordinal, '（' || event_type || '） by ' || subject AS text, event_id % 5 AS form, para
  FROM obs)
SELECT page_id, ordinal, text, 1::BIGINT AS locator, para AS p_start, para + [0, 2, 3, 0][form + 1] AS p_end
  FROM cited WHERE form < 4
UNION ALL SELECT page_id, ordinal, text, 2, para + 5, para + 5 FROM cited WHERE form = 3
UNION ALL SELECT page_id, ordinal, text, 0, -1, -1 FROM cited WHERE form = 4""")
put("page_sections", f"""WITH {DOCS}
SELECT page_id, 1::BIGINT AS level, page_id AS title, -1::BIGINT AS declared, md5('head') AS content_md5 FROM docs
UNION ALL SELECT page_id, 2, 'part (3 件)', 3, md5(unnest(string_split(text, {NL}))) FROM docs""")
put("generated_blocks", f"""WITH {DOCS}
SELECT page_id, 1::BIGINT AS ordinal, 'links' AS block, md5(text) AS content_md5 FROM docs
UNION ALL SELECT page_id, 2, 'auto', md5(section) FROM docs
UNION ALL SELECT page_id, 0, 'hand', md5('by hand ' || page_id || {NL} || {NL} || 'more' || {NL} || {NL}) FROM docs""")
put("predicate_labels", f"WITH {CLAIMS} SELECT event_id, predicate, label FROM claims")

# --- filters -------------------------------------------------------------------------------------

put("spoiler_gate", f"""WITH {CLAIMS} SELECT event_id, claim_id, chapter AS spoiler_after FROM claims
WHERE edition = 2 AND chapter_no <= 15""")
put("evidence_filter", f"""WITH {CLAIMS} SELECT event_id, claim_id, evidence_strength,
  CAST(list_position([{", ".join(lit(x) for x in EVIDENCE_LEVELS)}], evidence_strength) AS BIGINT) AS evidence_rank
FROM claims WHERE value >= 20""")
put("stub_pages", f"""WITH {DOCS} SELECT page_id, layer = 'es' AS has_placeholder,
  NOT contains(text, {NL}) AS is_empty FROM docs WHERE layer = 'es' OR NOT contains(text, {NL})""")
put("thin_units", """SELECT c_custkey AS unit, count(event_id) AS observed
FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY c_custkey HAVING count(event_id) < 66""")

# --- joins ---------------------------------------------------------------------------------------

put("resolve_links", f"""WITH {CITED}, {KNOWN} SELECT page_id, pos, target,
  CASE WHEN target IN (SELECT target FROM known) THEN 'ok' ELSE 'dead' END AS status FROM cited""")
put("dead_links", f"""WITH {CITED}, {KNOWN} SELECT page_id, pos, target FROM cited
WHERE target NOT IN (SELECT target FROM known)""")
# Rebuilt from the text between anchors and the anchors themselves.
put("unlink_missing", f"""WITH {ANCHORS}, {KNOWN}, shown AS (
  SELECT page_id, pos, CASE WHEN known.target IS NULL THEN display ELSE '[[' || anchors.target || '|' || display || ']]' END AS link
  FROM anchors LEFT JOIN known USING (target)),
gaps AS (
  SELECT page_id, unnest(range(0, len(parts))) AS pos, unnest(parts) AS gap
  FROM (SELECT page_id, string_split_regex(html, {lit(ANCHOR)}) AS parts FROM pages))
SELECT page_id, md5(string_agg(coalesce(link, '') || gap, '' ORDER BY pos)) AS body_md5
FROM gaps LEFT JOIN shown USING (page_id, pos) GROUP BY page_id""")
put("unlink_missing_in_layer", f"""WITH {ANCHORS}, layers AS (
  SELECT page_id, regexp_extract(url, 'example\\.([a-z]+)/', 1) AS layer FROM pages), known AS (
  SELECT DISTINCT layer, unnest(string_split_regex(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\\s+')) AS target
  FROM pages JOIN layers USING (page_id)), shown AS (
  SELECT a.page_id, pos, CASE WHEN k.target IS NULL THEN display ELSE '[[' || a.target || '|' || display || ']]' END AS link
  FROM anchors a JOIN layers l USING (page_id) LEFT JOIN known k ON k.layer = l.layer AND k.target = a.target),
gaps AS (
  SELECT page_id, unnest(range(0, len(parts))) AS pos, unnest(parts) AS gap
  FROM (SELECT page_id, string_split_regex(html, {lit(ANCHOR)}) AS parts FROM pages))
SELECT page_id, md5(string_agg(coalesce(link, '') || gap, '' ORDER BY pos)) AS body_md5
FROM gaps LEFT JOIN shown USING (page_id, pos) GROUP BY page_id""")
put("unlink_cites", f"""WITH {OBS}, {ARCS} SELECT event_id AS page_id, subject || ' ' ||
  CASE WHEN EXISTS (SELECT 1 FROM arcs WHERE number BETWEEN lo AND hi)
    THEN '[`' || chapter || '¶' || para || '`](https://pages.example.org/site/L1/episodes/' || chapter || ')'
    ELSE '`' || chapter || '¶' || para || '`' END || ' and [`' || chapter || '`](./x)' AS body FROM obs""")
put("backlinks", f"WITH {CLAIMS} SELECT object_id AS ref_id, claim_id, statement FROM claims")
put("chapter_index", f"""{GRAPH}, entries AS (
  SELECT chapter, 'claim' AS kind, claim_id AS entry_id, title, label AS tag FROM claims
  UNION ALL SELECT chapter, 'mystery', mystery_id, title, '' FROM mysteries
  UNION ALL SELECT DISTINCT chapter, 'reference', object_id, '', '' FROM claims)
SELECT * FROM entries WHERE chapter IN (SELECT chapter FROM chapters)
UNION ALL SELECT chapter, 'none', '', '', '' FROM chapters WHERE chapter NOT IN (SELECT chapter FROM entries)""")
put("arc_of_chapter", f"""WITH {OBS}, {ARCS} SELECT event_id, chapter, coalesce(arc_id, '') AS arc_id
FROM obs LEFT JOIN arcs ON number BETWEEN lo AND hi""")
put("layer_lineage", f"""WITH {DOCS} SELECT page_id,
  CASE layer WHEN 'fr' THEN lower(path) WHEN 'es' THEN 'gone/' || path ELSE path END AS normalized_from,
  CASE layer WHEN 'fr' THEN 'case' WHEN 'es' THEN 'none' ELSE 'exact' END AS match,
  CASE layer WHEN 'es' THEN '' ELSE path END AS l1_path FROM docs""")
put("resume_todo", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
put("canonical_entities", f"""WITH {OBS}, {ENTITY_LEDGER}, entities AS (
  SELECT 'char' AS kind, subject AS name FROM obs UNION SELECT 'item', 'user_' || k FROM obs)
SELECT kind, name, coalesce(representative, name) AS representative, coalesce(confidence, '') AS confidence,
  'E_' || kind || '_' || coalesce(representative, name) AS canonical_id
FROM entities LEFT JOIN (SELECT * FROM ledger WHERE confidence <> {lit(UNVERIFIED)}) USING (name)""")
put("ground_quotes", f"""WITH quotes AS (
  SELECT conv_id, turn, CASE role WHEN 'assistant' THEN turn - 1 WHEN 'system' THEN turn + 100 ELSE turn END AS lo,
    CASE role WHEN 'assistant' THEN turn - 1 WHEN 'system' THEN turn + 300 ELSE turn + 1 END AS hi,
    unnest(range(0, len(lines))) AS line, unnest(lines) AS quote
  FROM (SELECT *, string_split(text, {NL}) AS lines FROM conversations))
SELECT q.conv_id || '_' || q.turn || '_' || q.line AS quote_id, count(p.turn) AS paragraphs,
  coalesce(bool_or(contains(p.text, q.quote)), false) AS grounded
FROM quotes q LEFT JOIN conversations p ON p.conv_id = q.conv_id AND p.turn BETWEEN q.lo AND q.hi
GROUP BY q.conv_id, q.turn, q.line""")
put("kind_conflicts", f"""WITH {ELEMENTS} SELECT name, count(DISTINCT kind) AS kinds,
  string_agg(DISTINCT kind, ',' ORDER BY kind) AS kind_list, count(*) AS uses
FROM elements GROUP BY name HAVING count(DISTINCT kind) > 1""")
put("ledger_chains", f"""WITH {OBS}, {ENTITY_LEDGER}
SELECT a.name, a.representative, b.representative AS next_representative
FROM ledger a JOIN ledger b ON a.representative = b.name
WHERE a.name <> a.representative AND b.name <> b.representative""")

# --- aggregations --------------------------------------------------------------------------------

COUNTS = """counts AS (
  SELECT chapter, (SELECT count(*) FROM claims c WHERE c.chapter = x.chapter) AS claims,
    (SELECT count(*) FROM mysteries m WHERE m.chapter = x.chapter) AS mysteries,
    (SELECT count(DISTINCT object_id) FROM claims c WHERE c.chapter = x.chapter) AS refs
  FROM chapters x)"""

put("chapter_counts", f"{GRAPH}, {COUNTS} SELECT * FROM counts")
put("chapter_refs", f"WITH {CLAIMS} SELECT DISTINCT chapter, object_id AS ref_id FROM claims")
put("backlink_counts", f"""WITH {CLAIMS} SELECT object_id AS ref_id, count(*) AS backlinks,
  count(DISTINCT claim_id) AS distinct_claims FROM claims GROUP BY object_id""")
put("layer_counts", """SELECT coalesce(lang, '') AS layer, coalesce(source, '') AS section, count(*) AS pages
FROM documents GROUP BY ROLLUP (lang, source)""")
put("section_index", f"""WITH {DOCS} SELECT layer, section, page_id,
  count(*) OVER (PARTITION BY layer, section) AS pages FROM docs""")
put("entity_stats", f"""WITH {OBS} SELECT subject AS entity, edition, min(chapter_no) AS first_chapter_no,
  count(*) AS observations, count(DISTINCT chapter_no) AS chapters FROM obs GROUP BY subject, edition""")
put("claim_facets", f"""WITH {CLAIMS} SELECT coalesce(predicate, '') AS predicate,
  coalesce(evidence_strength, '') AS evidence_strength, count(*) AS claims
FROM claims GROUP BY CUBE (predicate, evidence_strength)""")
put("audit_totals", f"""WITH {LEDGER_PAGES} SELECT name, representative, confidence,
  CAST(sum(replaced) AS BIGINT) AS replaced, count(*) AS pages FROM hits GROUP BY ALL""")
put("run_summary", f"""WITH {OBS} SELECT chapter AS unit, count(*) AS runs,
  count(*) FILTER (event_type <> 'error') AS ok, count(*) FILTER (event_type = 'error') AS failed
FROM obs GROUP BY chapter""")
put("link_counters", f"""WITH {ANCHORS}, {KNOWN}, layers AS (
  SELECT page_id, regexp_extract(url, 'example\\.([a-z]+)/', 1) AS layer FROM pages)
SELECT layer, count(a.target) AS seen, count(k.target) AS kept, count(a.target) - count(k.target) AS unlinked
FROM layers LEFT JOIN anchors a USING (page_id) LEFT JOIN known k ON a.target = k.target GROUP BY layer""")

DRIFT = f"""drift AS (
  SELECT 'ME_' || page_id AS page_id, CAST(len(t) AS BIGINT) AS declared,
    CAST(len(list_filter(t, lambda x: NOT regexp_matches(x, '^[A-Z]'))) AS BIGINT) AS actual
  FROM (SELECT page_id, regexp_extract_all(html, {lit(ANCHOR)}, 1) AS t FROM pages))"""

put("count_drift", f"WITH {DRIFT} SELECT * FROM drift WHERE declared <> actual")
put("chapter_drift", f"""WITH counted AS (
  SELECT page_id, regexp_extract_all(html, {lit(ANCHOR)}, 1) AS t FROM pages), drift AS (
  SELECT page_id, CAST(len(t) AS BIGINT) AS declared_claims,
    CAST(len(list_filter(t, lambda x: NOT regexp_matches(x, '^[A-Z]'))) AS BIGINT) AS actual_claims,
    1::BIGINT AS declared_mysteries,
    CAST(len(list_filter(t, lambda x: regexp_matches(x, '^[A-Z]'))) AS BIGINT) AS actual_mysteries,
    0::BIGINT AS actual_refs FROM counted)
SELECT * FROM drift WHERE declared_claims <> actual_claims OR declared_mysteries <> actual_mysteries""")
put("heading_drift", f"""WITH {DOCS} SELECT page_id, page_id AS expected, '{{' || page_id || '}}' AS shown
FROM docs WHERE layer = 'fr'""")
put("index_drift", f"""WITH {DOCS} SELECT page_id, CAST(length(text) % 20 AS BIGINT) AS declared,
  CAST(len(string_split(text, {NL})) AS BIGINT) AS actual FROM docs
WHERE length(text) % 20 <> len(string_split(text, {NL}))""")
put("select_layer", f"WITH {DOCS} SELECT page_id, layer, section FROM docs WHERE layer = 'en' AND section = 'src1'")
put("resolve_links_in_layer", f"""WITH {CITED}, layers AS (
  SELECT page_id, regexp_extract(url, 'example\\.([a-z]+)/', 1) AS layer FROM pages), known AS (
  SELECT DISTINCT layer, unnest(string_split_regex(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\\s+')) AS target
  FROM pages JOIN layers USING (page_id))
SELECT page_id, layer, pos, target, CASE WHEN known.target IS NULL THEN 'dead' ELSE 'ok' END AS status
FROM cited JOIN layers USING (page_id) LEFT JOIN known USING (layer, target)""")
put("casefold_collisions", f"""WITH {CITED} SELECT lower(target) AS folded, count(DISTINCT target) AS spellings,
  min(target) AS first_spelling, max(target) AS last_spelling
FROM cited GROUP BY lower(target) HAVING count(DISTINCT target) > 1""")
put("chapter_gaps", f"""WITH {OBS} SELECT edition, range AS chapter_no
FROM (SELECT DISTINCT edition FROM obs), range(1, 367)
WHERE (edition, range) NOT IN (SELECT (edition, chapter_no) FROM obs)""")

SAMPLE = "sample AS (SELECT * FROM labels ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id LIMIT 50)"

put("audit_sample", f"""WITH {SAMPLE} SELECT doc_id, CAST(quality AS BIGINT) AS quality,
  CAST(toxic AS BIGINT) AS toxic FROM sample""")
put("audit_agreement", f"""WITH {SAMPLE} SELECT count(*) AS sampled, count(*) FILTER (quality = 1 - toxic) AS agreed,
  round(avg(CASE WHEN quality = 1 - toxic THEN 1.0 ELSE 0.0 END), 6) AS rate FROM sample""")
put("audit_sample_strata", """WITH placed AS (
  SELECT *, doc_id % 7 AS stratum, row_number() OVER (PARTITION BY doc_id % 7 ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) AS place,
    count(*) OVER (PARTITION BY doc_id % 7) AS rows FROM labels),
counted AS (
  SELECT stratum, any_value(rows) AS rows, count(*) AS sampled, count(*) FILTER (quality = 1 - toxic) AS agreed,
    CAST(count(*) FILTER (quality = 1 - toxic) AS DOUBLE) / count(*) AS p, CAST(count(*) AS DOUBLE) AS n FROM placed WHERE place <= 9 GROUP BY stratum)
SELECT stratum, rows, sampled, agreed, round(p, 6) AS rate,
  round((p + 3.8416 / (2 * n) - 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n), 6) AS low,
  round((p + 3.8416 / (2 * n) + 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n), 6) AS high
FROM counted""")
put("alias_groups", f"""WITH {OBS}, {ENTITY_LEDGER} SELECT representative, name,
  count(*) OVER (PARTITION BY representative) AS names FROM ledger""")
put("observation_histogram", f"""WITH {OBS}
SELECT 'verb' AS axis, verb AS value, count(*) AS observations FROM obs GROUP BY verb
UNION ALL SELECT 'subject', subject, count(*) FROM obs GROUP BY subject""")

# --- windows and order ---------------------------------------------------------------------------

put("top_quotes", f"""WITH {OBS} SELECT subject, edition, chapter, para, event_id, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY subject, edition ORDER BY chapter_no, para, event_id) AS rank FROM obs)
WHERE rank <= 2""")

TODO = """todo AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS i, count(*) OVER () AS n
  FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))"""

put("batches", f"""WITH {TODO} SELECT (i - 1) // 10 + 1 AS batch, min(doc_id) AS first, max(doc_id) AS last,
  count(*) AS units, min(doc_id) || '-' || max(doc_id) AS label FROM todo GROUP BY (i - 1) // 10""")
put("progress", f"WITH {TODO} SELECT doc_id, i, n, i || '/' || n AS label FROM todo")
put("latest_run", f"""WITH {OBS}, runs AS (
  SELECT subject AS page_id, strftime(ts, '%Y%m%dT%H%M') AS minute, k FROM obs)
SELECT page_id, minute || '_v' || k AS run, k AS version FROM (
  SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY minute DESC, k DESC) AS rn FROM runs) WHERE rn = 1""")
put("chapter_listing", f"""WITH {CLAIMS} SELECT chapter, claim_id,
  row_number() OVER (PARTITION BY chapter ORDER BY claim_id) AS position FROM claims""")
put("chapter_listing_nocase", f"""WITH {CITED} SELECT page_id, target,
  row_number() OVER (PARTITION BY page_id ORDER BY lower(target), target) AS position FROM cited""")
put("top_references", f"""WITH {CLAIMS} SELECT object_id AS ref_id, count(*) AS backlinks FROM claims
GROUP BY object_id ORDER BY backlinks DESC, ref_id LIMIT 20""")
put("log_tail", f"""WITH {DOCS}, split AS (
  SELECT page_id, text, string_split_regex(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '\\r?\\n') AS lines FROM docs)
SELECT page_id, array_to_string(lines[-4:], ' / ') AS tail, lines[-1] AS last_line, right(text, 300) AS error FROM split""")

# --- sets ----------------------------------------------------------------------------------------

put("union_layers", f"""WITH {LEDGER_PAGES}
SELECT 'l1' AS layer, page_id, md5(head || 'then ' || layer || ']]' || {NL} || text || {NL} || tail) AS body_md5 FROM done
UNION ALL SELECT 'l2', page_id, md5(body) FROM done""")
put("layer_coverage", """SELECT CASE WHEN doc_id IS NULL THEN 'only_l2' WHEN vec_id IS NULL THEN 'only_l1'
  ELSE 'both' END AS coverage, count(*) AS pages
FROM labels FULL JOIN embeddings ON doc_id = vec_id GROUP BY 1""")
put("cited_minus_existing", f"""WITH {CITED}, {KNOWN}
SELECT target FROM cited EXCEPT SELECT target FROM known""")

LIST_DRIFT = f"""{OBS}, list_drift AS (
  SELECT 'O_' || event_id || '_summary' AS episode_id,
    CASE event_type WHEN 'error' THEN 'order' WHEN 'signup' THEN 'content' ELSE 'none' END AS drift,
    CASE event_type WHEN 'signup' THEN 'E_item_key_' || para ELSE '' END AS only_listed, '' AS only_shown FROM obs)"""

put("list_drift", f"WITH {LIST_DRIFT} SELECT * FROM list_drift")

# --- rewriting -----------------------------------------------------------------------------------

put("normalize_names", f"""WITH {LEDGER_PAGES} SELECT page_id, md5(body) AS body_md5,
  CAST(length(body) AS BIGINT) AS body_chars,
  coalesce((SELECT CAST(sum(replaced) AS BIGINT) FROM hits h WHERE h.page_id = done.page_id), 0) AS replaced FROM done""")
# Names are words behind a space, so each space begins at most one, the longest word that begins what follows.
put("normalize_names_large", f"""WITH {DOCS}, words AS (
  SELECT DISTINCT w, length(w) AS n FROM (SELECT unnest(string_split(text, ' ')) AS w FROM docs)
  WHERE regexp_full_match(w, '[a-z]+')),
tokens AS (
  SELECT page_id, unnest(range(1, len(t) + 1)) AS i, unnest(t) AS token FROM (
    SELECT page_id, string_split('then ' || layer || ']]' || {NL} || text || {NL}, ' ') AS t FROM docs)),
runs AS (SELECT DISTINCT regexp_extract(token, '^[a-z]+') AS run FROM tokens),
best AS (
  SELECT run, arg_max(w, words.n) AS w FROM (SELECT run, unnest(range(1, length(run) + 1)) AS n FROM runs) r
  JOIN words ON w = substr(run, 1, r.n) WHERE words.n % 4 <> 0 GROUP BY run),
hits AS (
  SELECT page_id, i, token, CASE WHEN i > 1 THEN w END AS w
  FROM tokens LEFT JOIN best ON run = regexp_extract(token, '^[a-z]+')),
bodies AS (
  SELECT page_id, '[[the_' || doc_id || '|' || free || '<!-- AUTO-GENERATED:l2ref -->' || {NL} || 'the ' || section
    || {NL} || '<!-- /AUTO-GENERATED:l2ref -->' AS body
  FROM docs JOIN (SELECT page_id, string_agg(CASE WHEN w IS NULL THEN token
    ELSE reverse(w) || '~' || substr(token, length(w) + 1) END, ' ' ORDER BY i) AS free FROM hits GROUP BY page_id) USING (page_id)),
counted AS (SELECT page_id, w, count(*) AS c, min(i) AS first FROM hits WHERE w IS NOT NULL GROUP BY page_id, w),
audits AS (
  SELECT page_id, CAST(sum(c) AS BIGINT) AS replaced, string_agg(' ' || w || '=' || c, ',' ORDER BY c DESC, first) AS shown
  FROM counted GROUP BY page_id),
after AS (
  SELECT DISTINCT page_id, regexp_extract(token, '^[a-z]+') AS run
  FROM (SELECT page_id, unnest(string_split(body, ' ')[2:]) AS token FROM bodies)),
noted AS (
  SELECT page_id, string_agg(' ' || w, ',' ORDER BY w) AS shown FROM (
    SELECT DISTINCT page_id, w FROM (SELECT page_id, run, unnest(range(1, length(run) + 1)) AS n FROM after) a
    JOIN words ON w = substr(run, 1, a.n) WHERE words.n % 4 = 0) GROUP BY page_id)
SELECT page_id, md5(body) AS body_md5, coalesce(replaced, 0) AS replaced, md5(coalesce(audits.shown, '')) AS audit_md5,
  md5(coalesce(noted.shown, '')) AS notes_md5
FROM bodies LEFT JOIN audits USING (page_id) LEFT JOIN noted USING (page_id)""")
put("normalize_audit", f"WITH {LEDGER_PAGES} SELECT * FROM audit")
put("unresolved_notes", f"WITH {LEDGER_PAGES} SELECT * FROM notes")
put("audit_rows", f"""WITH {LEDGER_PAGES} SELECT page_id, {lit(RUN)} AS run, seq, name, representative, confidence,
  replaced FROM audit""")
put("build_layer", f"""WITH {LEDGER_PAGES}, {SECTION_TEXT} SELECT page_id, 'l2' AS layer,
  'l2/' || section || '/' || page_id || '.md' AS path, path AS normalized_from, {lit(RUN)} AS l2_run,
  md5('---' || {NL} || 'id: ' || page_id || {NL} || 'normalized_from: ' || path || {NL} || 'l2_run: ' || {lit(RUN)}
    || {NL} || '---' || {NL} || body || section_text) AS text_md5
FROM done JOIN section_text USING (page_id)""")
put("render_audit", f"WITH {LEDGER_PAGES}, {SECTION_TEXT} SELECT * FROM section_text")

SECTION_ALT = "|".join(sorted(PAGE_SECTIONS, key=len, reverse=True))
INDEXED = f"""indexed AS (
  SELECT page_id, replace(regexp_replace(html, {lit(ANCHOR)}, '[\\2](\\1/index.md)', 'g'), '<footer>',
    '[up](../the/index.md) ' || {NL}) AS t, list_filter(regexp_extract_all(html, {lit(ANCHOR)}, 1),
    lambda x: regexp_full_match(x, '{SECTION_ALT}')) AS matching FROM pages)"""
DEPTH = f"regexp_replace(t, '\\]\\(((?:{SECTION_ALT})/index\\.md)\\)', '](../../../\\1)', 'g')"

put("rewrite_links", f"""WITH {INDEXED} SELECT page_id, CAST(len(matching) AS BIGINT) AS rewritten,
  0::BIGINT AS remaining, md5({DEPTH}) AS text_md5 FROM indexed""")
put("rewrite_counters", f"""WITH {INDEXED} SELECT regexp_extract(url, 'example\\.([a-z]+)/', 1) AS layer,
  CAST(sum(len(matching)) AS BIGINT) AS rewritten, 0::BIGINT AS remaining
FROM indexed JOIN pages USING (page_id) GROUP BY 1""")
put("unwiki_fields", f"""WITH {CLAIMS} SELECT event_id, 'id: ' || claim_id || {NL} || 'subject: `' || observation_id
  || '` `' || object_id || '`' || {NL} || 'object: plain ' || k || {NL} || 'other: [[' || object_id || ']]' AS front_matter
FROM claims""")


def lines(rank: int, source: str, key: str, text: str, page: str = "chapter") -> str:
    return f"SELECT {page} AS page, {rank} AS rank, {key} AS key, {text} AS line FROM {source}"


NAV_LINES = " UNION ALL ".join(
    [
        lines(0, "counts", "''", "'---'"),
        lines(1, "counts", "''", "'title: Chapter ' || chapter"),
        lines(2, "counts", "''", "'id: nav/' || chapter"),
        lines(3, "counts", "''", "'description: 第' || chapter[3:] || '話のアナロジー ' || claims || ' 件・伏線 ' "
              "|| mysteries || ' 件・外部参照 ' || refs || ' 件'"),
        lines(4, "counts", "''", "'---'"),
        *[lines(r, "counts", "''", "''") for r in (5, 7, 11, 21, 23, 31)],
        *[lines(r, "(SELECT * FROM counts WHERE refs > 0)", "''", "''") for r in (33, 41)],
        lines(6, "counts", "''", "'# Chapter ' || chapter"),
        lines(8, "(SELECT * FROM counts WHERE chapter < 'ch5030')", "''", "'## Part of ' || chapter"),
        lines(9, "(SELECT * FROM counts WHERE chapter < 'ch5030')", "''", "''"),
        lines(10, "counts", "''", "'up from ' || chapter"),
        lines(20, "counts", "''", f"{lit(CLAIM_HEADING)} || claims || {lit(COUNT_END)}"),
        lines(22, "claims", "claim_id", "'- [[' || claim_id || '|' || title || ']] `[' || label || ']`'"),
        lines(30, "counts", "''", f"{lit(MYSTERY_HEADING)} || mysteries || {lit(COUNT_END)}"),
        lines(32, "mysteries", "mystery_id", "'- [[' || mystery_id || '|' || title || ']]'"),
        lines(40, "(SELECT * FROM counts WHERE refs > 0)", "''", f"{lit(REFERENCE_HEADING)} || refs || {lit(COUNT_END)}"),
        lines(42, "(SELECT DISTINCT chapter, object_id FROM claims)", "object_id", "'- [[' || object_id || ']]'"),
    ]
)


def numbered(page: str) -> str:
    return f"SELECT page AS {page}, row_number() OVER (PARTITION BY page ORDER BY rank, key, line) AS n, line FROM lines"


put("render_chapter", f"""{GRAPH}, {COUNTS}, lines AS (
  SELECT * FROM ({NAV_LINES}) WHERE page IN (SELECT chapter FROM chapters)) {numbered("chapter")}""")

REF_LINES = " UNION ALL ".join(
    [
        lines(0, "refs", "''", "'# ' || object", "object_id"),
        *[lines(r, "refs", "''", "''", "object_id") for r in (1, 3, 5)],
        lines(2, "refs", "''", "'What cites this.'", "object_id"),
        lines(4, "refs", "''", f"{lit(BACKLINK_HEADING)} || n || {lit(BACKLINK_HEADING_END)}", "object_id"),
        lines(6, "claims", "claim_id", f"'- [[' || claim_id || ']]' || {lit(BACKLINK_DASH)} || statement", "object_id"),
    ]
)
put("render_reference", f"""WITH {CLAIMS}, refs AS (
  SELECT object_id, object, count(*) AS n FROM claims GROUP BY object_id, object), lines AS ({REF_LINES})
{numbered("ref_id")}""")

# --- places --------------------------------------------------------------------------------------

put("locate_quotes", """WITH cut AS (
  SELECT item_id || '_' || cut AS quote_id, CASE cut WHEN 0 THEN text ELSE text[1:cut] END AS quote
  FROM benchmark, (VALUES (0), (12), (5)) AS cuts(cut)),
held AS (SELECT quote_id, quote, source AS chapter, doc_id AS para, text FROM cut JOIN documents ON contains(text, quote)),
tried AS (SELECT *, unnest(range(0, length(text) - length(quote) + 1)) AS place FROM held)
SELECT quote_id, chapter, para, place FROM tried WHERE substr(text, place + 1, length(quote)) = quote""")
put("link_sections", f"""WITH {ANCHORS}, sized AS (SELECT page_id, count(*) AS n FROM anchors GROUP BY page_id), parts AS (
  SELECT * FROM (VALUES (0, '', ''), (1, 'top', ''), (2, 'top > part', 'links'), (3, 'top > part > inner', 'links'),
    (4, 'top > part > inner', ''), (5, 'end', '')) AS p(part, path, block))
SELECT page_id, pos + part * n AS pos, target, replace(path, 'top', 'top of ' || page_id) AS path, block
FROM anchors JOIN sized USING (page_id), parts""")
put("ranges_of_units", """WITH spans AS (
  SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS low,
    min(CAST(o_orderdate AS DATE)) + CAST(CASE WHEN o_custkey % 500 = 0 THEN 400 ELSE o_custkey % 3 END AS INTEGER) AS high
  FROM orders GROUP BY o_custkey),
shipped AS (SELECT l_orderkey, CAST(l_shipdate AS DATE) AS day FROM lineitem)
SELECT CAST(o_custkey AS BIGINT) AS o_custkey, count(*) AS shipped, CAST(min(day) - DATE '1970-01-01' AS BIGINT) AS first,
  CAST(max(day) - DATE '1970-01-01' AS BIGINT) AS last, CAST(sum(l_orderkey) AS BIGINT) AS keys
FROM spans JOIN shipped ON day BETWEEN low AND high GROUP BY o_custkey""")

# --- upkeep --------------------------------------------------------------------------------------

# The stored aggregates and their deltas must give what a recount gives.
put("chapter_counts_delta", ORACLES["chapter_counts"])
put("backlinks_delta", f"""WITH {CLAIMS} SELECT object_id AS ref_id, claim_id, statement, count(*) AS uses
FROM claims GROUP BY object_id, claim_id, statement""")
put("manifest_diff", f"""WITH {DOCS}, sums AS (
  SELECT *, 'sha256:' || sha256(text) AS now, 'sha256:' || sha256(text || '.') AS dotted FROM docs)
SELECT path, 'changed' AS change, dotted AS before, now AS after FROM sums WHERE layer = 'fr'
UNION ALL SELECT path, 'added', '', now FROM sums WHERE layer = 'es' AND doc_id % 3 <> 2
UNION ALL SELECT path || '.old', 'removed', now, '' FROM sums WHERE layer = 'es' AND doc_id % 3 = 1""")
put("ledger_closure", f"""WITH RECURSIVE {OBS}, {ENTITY_LEDGER}, onward AS (SELECT * FROM ledger WHERE name <> representative), walk AS (
  SELECT name, name AS node, 0::BIGINT AS steps FROM ledger
  UNION ALL SELECT walk.name, onward.representative, steps + 1 FROM walk JOIN onward ON onward.name = walk.node
    WHERE steps <= 2 * (SELECT count(*) FROM ledger)),
ends AS (SELECT name, node, steps FROM walk WHERE node NOT IN (SELECT name FROM onward)),
loops AS (SELECT name, min(node) AS low FROM walk WHERE steps >= (SELECT count(*) FROM ledger) GROUP BY name)
SELECT ledger.name, coalesce(ends.node, loops.low) AS end_name, coalesce(ends.steps, -1) AS depth, ends.node IS NULL AS in_cycle
FROM ledger LEFT JOIN ends USING (name) LEFT JOIN loops USING (name)""")

# --- quality -------------------------------------------------------------------------------------

PLAIN = f"""{DOCS}, plain AS (SELECT *, {unmarked(marked("text"))} AS new_text FROM docs)"""

put("changed_pages", f"""WITH {PLAIN} SELECT path, md5(new_text) AS text_md5 FROM plain
WHERE layer = 'fr' OR new_text <> text""")
put("change_log", f"""WITH {PLAIN}
SELECT 'old/' || path AS path, 'T1' AS rule, 'removed' AS change, md5(text) AS before_md5, md5('') AS after_md5
  FROM plain WHERE layer = 'es'
UNION ALL SELECT path, 'T1', 'added', md5(''), md5(new_text) FROM plain WHERE layer = 'es'
UNION ALL SELECT path, 'T1', 'changed', md5(text), md5(new_text) FROM plain WHERE layer <> 'es' AND new_text <> text""")
put("change_hunks", f"WITH {PLAIN} SELECT path, md5(new_text) AS text_md5 FROM plain WHERE new_text <> text")
put("lint_findings", f"""WITH {CLAIMS}, {CITED}, {KNOWN}, {DOCS}, {DRIFT}, list_drift AS (
  SELECT 'O_' || event_id || '_summary' AS episode_id, event_type FROM obs)
SELECT 'LNK003' AS rule, 'error' AS severity, CAST(page_id AS VARCHAR) AS path, target AS detail FROM cited
  WHERE target NOT IN (SELECT target FROM known)
UNION ALL SELECT 'ID001', 'error', string_split(url, '/')[-1], CAST(page_id AS VARCHAR) FROM pages
  WHERE string_split(url, '/')[-1] <> CAST(page_id AS VARCHAR)
UNION ALL SELECT 'CNT001', 'warning', page_id, declared || '/' || actual FROM drift WHERE declared <> actual
UNION ALL SELECT 'LST001', 'warning', episode_id, CASE event_type WHEN 'error' THEN 'order' ELSE 'content' END
  FROM list_drift WHERE event_type IN ('error', 'signup')
UNION ALL SELECT 'STB001', 'info', page_id, CASE WHEN layer = 'es' THEN 'placeholder' ELSE 'empty list' END
  FROM docs WHERE layer = 'es' OR NOT contains(text, {NL})
UNION ALL SELECT 'DUP001', 'warning', object_id, claim_id || ' x' || count(*) FROM claims
  GROUP BY object_id, claim_id HAVING count(*) > 1
UNION ALL SELECT 'REF001', 'error', claim_id, 'evidence_strength=certain' FROM claims WHERE value > 200""")

SPACES = "regexp_replace(t, '[ \\t]+\\n', chr(10), 'g')"
put("fix_plan", f"""WITH {INDEXED}, plans AS (
  SELECT page_id, 'LNK-DEPTH' AS rule, 'safe' AS safety, t AS before, {DEPTH} AS after FROM indexed
  UNION ALL SELECT page_id, 'WS001', 'safe', t, {SPACES} FROM indexed
  UNION ALL SELECT page_id, 'AMP001', 'review', t, replace(t, '&amp;', '&') FROM indexed)
SELECT page_id, rule, safety, md5(before) AS before_md5, md5(after) AS after_md5 FROM plans WHERE before <> after""")
put("fix_plan_by_findings", f"""WITH {INDEXED}, plans AS (
  SELECT page_id, 'LNK-DEPTH' AS rule, 'safe' AS safety, t AS before, {DEPTH} AS after FROM indexed
  UNION ALL SELECT page_id, 'WS001', 'safe', t, {SPACES} FROM indexed
  UNION ALL SELECT page_id, 'AMP001', 'review', t, replace(t, '&amp;', '&') FROM indexed)
SELECT page_id, rule, safety, md5(before) AS before_md5, md5(after) AS after_md5 FROM plans
JOIN pages USING (page_id) WHERE before <> after AND regexp_extract(url, 'example\\.([a-z]+)/', 1) <> 'org'""")
put("apply_fixes", f"""WITH {INDEXED} SELECT page_id, md5({SPACES}) AS text_md5
FROM (SELECT page_id, {DEPTH} AS t FROM indexed)""")

# --- search --------------------------------------------------------------------------------------

WORDS = "list_filter(string_split_regex(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
INDEX = f"""tokens AS (SELECT doc_id, {WORDS.format("text")} AS w FROM documents), postings AS (
  SELECT term, doc_id, count(*) AS tf, any_value(length) AS length FROM (
    SELECT doc_id, len(w) AS length, unnest(w) AS term FROM tokens) GROUP BY term, doc_id), stats AS (
  SELECT term, count(*) AS df FROM postings GROUP BY term)"""

put("inverted_index", f"""WITH {INDEX} SELECT term, doc_id, tf, df, CAST(length AS BIGINT) AS length
FROM postings JOIN stats USING (term)""")


def bm25(queries: str) -> str:
    return f"""{INDEX}, asked AS (
  SELECT DISTINCT query_id, unnest({WORDS.format("query")}) AS term FROM ({queries})), sizes AS (
  SELECT count(*) AS n, avg(len(w)) AS mean FROM tokens WHERE len(w) > 0), scores AS (
  SELECT query_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
    / (tf + 1.2 * (0.25 + 0.75 * length / mean))), 6) AS score
  FROM asked JOIN postings USING (term) JOIN stats USING (term), sizes GROUP BY query_id, doc_id)"""


CENTROIDS = """cells AS (
  SELECT label, unnest(range(1, len(embedding) + 1)) AS place, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
centroids AS (
  SELECT query_id, list(m ORDER BY place) AS q FROM (
    SELECT CAST(label AS BIGINT) AS query_id, place, avg(v) AS m FROM cells GROUP BY label, place) GROUP BY query_id),
near AS (
  SELECT query_id, vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), q), 6) AS score
  FROM embeddings, centroids)"""


def ranked(source: str, item: str, k: int) -> str:
    return f"""(SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, {item}) AS rank
  FROM {source} QUALIFY rank <= {k})"""


put("bm25_topk", f"""WITH {bm25("SELECT item_id AS query_id, text AS query FROM benchmark")}
SELECT query_id, doc_id, score, rank FROM {ranked("scores", "doc_id", 10)}""")
put("bm25_topk_indexed", ORACLES["bm25_topk"])
put("vector_topk", f"WITH {CENTROIDS} SELECT query_id, vec_id, score, rank FROM {ranked('near', 'vec_id', 10)}")
put("vector_topk_indexed", ORACLES["vector_topk"])
put("hybrid_topk", f"""WITH {bm25("SELECT item_id AS query_id, text AS query FROM benchmark")},
{CENTROIDS}, fused AS (
  SELECT query_id, doc_id, round(sum(1.0 / (60 + rank)), 6) AS score FROM (
    SELECT query_id, doc_id, rank FROM {ranked("scores", "doc_id", 50)}
    UNION ALL SELECT query_id, vec_id, rank FROM {ranked("near", "vec_id", 50)}) GROUP BY query_id, doc_id)
SELECT query_id, doc_id, score, rank FROM {ranked("fused", "doc_id", 10)}""")
