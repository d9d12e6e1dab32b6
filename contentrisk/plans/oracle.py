"""Independent DuckDB SQL for every query that SQL can express.

The oracle shares only *data* with the Spark side: the dictionary (as a VALUES
list of flattened terms), the regular expressions of ``functions.text`` and
the fixed values of the test views. The logic (theta join docs x terms,
grouping, CASE, windows) is written separately in plain SQL, so a bug in the
Spark expression builder shows up as a mismatch.
"""

from __future__ import annotations

from contentrisk.functions.dictionary import ThreatDictionary, analysis_dictionary
from contentrisk.functions.text import (
    HTML_ENTITIES,
    SCRIPT_STYLE_RE,
    TAG_RE,
    URL_HOST_RE,
    WHITESPACE_RE,
)
from contentrisk.operators.prepare import (
    FALLBACK_A_CATEGORY,
    FALLBACK_A_WORDS,
    FALLBACK_B_CATEGORY,
    FALLBACK_B_DETECTED,
    FALLBACK_B_WORDS,
    LEGACY_FILL_CATEGORY,
    LEGACY_FILL_DETECTED,
)
from contentrisk.sources.normalize import (
    HTML_OPENINGS,
    IMAGE_FAMILIES,
    NEWS_DEFAULT_CATEGORY,
    SOCIAL_URL_PREFIX,
    UNKNOWN_AUTHOR,
    WIKI_AUTHOR,
    WIKI_SOURCE,
)
from contentrisk.sources.testdata import SLOT_SECONDS, SLOTS, TEST_AS_OF


def q(s: str | None) -> str:
    if s is None:
        return "NULL"
    return "'" + s.replace("'", "''") + "'"


def terms_cte(d: ThreatDictionary) -> str:
    rows = []
    for t in d.terms():
        ci = "true" if (t.kind == "pattern" and any(c.isupper() for c in t.term)) else "false"
        rows.append(f"({q(t.category)}, {t.cat_ord}, {q(t.kind)}, {t.term_ord}, {q(t.term)}, "
                    f"{ci}, {t.weight}, {t.sev_rank})")
    return ("terms(category, cat_ord, kind, term_ord, term, ci, weight, sev_rank) AS (VALUES\n  "
            + ",\n  ".join(rows) + ")")


def _ts(id_col: str) -> str:
    return f"(timestamp '2024-01-01' + to_seconds(({id_col} % {SLOTS}) * {SLOT_SECONDS}))"


def _match(lt: str) -> str:
    return (f"CASE WHEN t.kind = 'keyword' THEN contains({lt}, t.term) "
            f"WHEN t.ci THEN regexp_matches({lt}, t.term, 'i') "
            f"ELSE regexp_matches({lt}, t.term) END")


def html_to_text_sql(col: str) -> str:
    s = f"regexp_replace({col}, {q(SCRIPT_STYLE_RE)}, ' ', 'g')"
    s = f"regexp_replace({s}, {q(TAG_RE)}, ' ', 'g')"
    for ent, ch in HTML_ENTITIES:
        s = f"replace({s}, {q(ent)}, {q(ch)})"
    return f"trim(regexp_replace({s}, {q(WHITESPACE_RE)}, ' ', 'g'))"


def base_ctes(d: ThreatDictionary | None = None) -> str:
    d = d or analysis_dictionary()
    return f"""{terms_cte(d)},
text_raw AS (
  SELECT 'doc_' || CAST(doc_id AS VARCHAR) AS id, source, substring(text, 1, 60) AS title, text, lang,
         NULL::VARCHAR AS url, {_ts('doc_id')} AS ts,
         strftime({_ts('doc_id')}, '%Y-%m-%dT%H:%M:%S') AS timestamp,
         md5(concat_ws('||', 'doc_' || CAST(doc_id AS VARCHAR), text, source)) AS content_hash
  FROM documents),
text_hits AS (
  SELECT r.id, t.category, t.cat_ord, t.kind, t.term_ord, t.term, t.weight, t.sev_rank
  FROM (SELECT id, lower(concat_ws(' ', title, text)) AS lt FROM text_raw) r
  JOIN terms t ON {_match('r.lt')}),
text_cat AS (
  SELECT id, category, cat_ord, max(sev_rank) AS sev FROM text_hits GROUP BY id, category, cat_ord),
text_doc AS (
  SELECT id, list(category ORDER BY cat_ord) AS cats, max(sev) AS sev FROM text_cat GROUP BY id),
text_enriched AS (
  SELECT r.id, r.source, r.title, r.text, r.content_hash, r.ts AS enrichment_timestamp,
         d.id IS NOT NULL AS is_threat,
         CASE WHEN d.id IS NULL THEN 'benign' WHEN d.sev >= 3 THEN 'high'
              WHEN d.sev = 2 THEN 'medium' ELSE 'low' END AS threat_severity,
         coalesce(d.cats, []::VARCHAR[]) AS threat_categories
  FROM text_raw r LEFT JOIN text_doc d ON r.id = d.id),
images_raw AS (
  SELECT 'page_' || CAST(page_id AS VARCHAR) AS id, regexp_extract(url, {q(URL_HOST_RE)}, 1) AS source,
         url, url AS filepath, CAST(strlen(html) AS BIGINT) AS file_size, {_ts('page_id')} AS ts,
         strftime({_ts('page_id')}, '%Y-%m-%dT%H:%M:%S') AS timestamp,
         md5(concat_ws('||', 'page_' || CAST(page_id AS VARCHAR), url)) AS image_hash,
         coalesce({html_to_text_sql('html')}, '') AS extracted_text
  FROM pages),
img_hits AS (
  SELECT r.id, t.category, t.cat_ord, t.kind, t.term_ord, t.term, t.weight, t.sev_rank
  FROM (SELECT id, lower(extracted_text) AS lt FROM images_raw) r
  JOIN terms t ON {_match('r.lt')}),
img_cat AS (
  SELECT id, category, cat_ord, max(sev_rank) AS sev FROM img_hits GROUP BY id, category, cat_ord),
img_doc AS (
  SELECT id, list(category ORDER BY cat_ord) AS cats, max(sev) AS sev FROM img_cat GROUP BY id),
images_enriched AS (
  SELECT r.id, r.source, r.filepath, r.extracted_text, r.image_hash, r.ts AS enrichment_timestamp,
         r.extracted_text <> '' AS ocr_success,
         CAST(length(r.extracted_text) AS INTEGER) AS text_length,
         d.id IS NOT NULL AS is_threat,
         CASE WHEN d.id IS NULL THEN 'benign' WHEN d.sev >= 3 THEN 'high'
              WHEN d.sev = 2 THEN 'medium' ELSE 'low' END AS threat_severity,
         coalesce(d.cats, []::VARCHAR[]) AS threat_categories
  FROM images_raw r LEFT JOIN img_doc d ON r.id = d.id)"""


def _with(body: str, d: ThreatDictionary | None = None) -> str:
    return f"WITH {base_ctes(d)},\n{body}"


AS_OF = f"DATE '{TEST_AS_OF}'"


def _share(part: str, whole: str) -> str:
    return f"CAST(round(100.0 * {part} / {whole}, 2) AS DOUBLE)"


# Every enriched row in one long form, and one row for each category it was flagged with.
_EVENTS = """events AS (
  SELECT 'text' AS kind, id, source, enrichment_timestamp AS seen, threat_severity AS level, threat_categories AS cats,
         title, text AS body, '' AS path
  FROM text_enriched
  UNION ALL
  SELECT 'image', id, source, enrichment_timestamp, threat_severity, threat_categories, '', extracted_text, filepath
  FROM images_enriched),
flagged AS (SELECT e.*, u.cat FROM events e, unnest(e.cats) AS u(cat))"""

# The last flagged row of each kind and category in the seven days before the anchor: its time first, then
# the least id at that time.
_LAST = f"""{_EVENTS},
late AS (SELECT * FROM flagged WHERE date_diff('day', CAST(seen AS DATE), {AS_OF}) <= 7),
final AS (
  SELECT l.kind, l.cat, l.seen, min(l.id) AS id
  FROM late l JOIN (SELECT kind, cat, max(seen) AS seen FROM late GROUP BY ALL) m USING (kind, cat, seen) GROUP BY ALL),
shown AS (SELECT l.* FROM late l JOIN final USING (kind, cat, seen, id))"""


def analytics_sql() -> dict[str, str]:
    """The analytics from their output contract: counts by FILTER over the long form, totals and ranks by joins."""
    out = {}
    per_day = f"""{_EVENTS},
per_day AS (
  SELECT CAST(seen AS DATE) AS event_date, source, count(*) FILTER (WHERE len(cats) > 0) AS bad,
         count(*) FILTER (WHERE len(cats) = 0) AS good, count(*) AS n
  FROM events GROUP BY kind, event_date, source)"""
    ratio = "CASE WHEN good > 0 THEN CAST(round(1.0 * bad / good, 4) AS DOUBLE) END AS threat_to_benign_ratio"
    counts = f"event_date, source, bad AS threat_count, good AS benign_count, n AS total_count, {_share('bad', 'n')} AS threat_percentage"
    out["daily_threat_ratio"] = _with(f"{per_day}\nSELECT {counts}, {_share('good', 'n')} AS benign_percentage, {ratio} FROM per_day")
    out["daily_threat_ratio_brief"] = _with(f"{per_day}\nSELECT {counts}, {ratio} FROM per_day")
    out["daily_threat_categories"] = _with(f"""{_EVENTS}
SELECT CAST(seen AS DATE) AS event_date, source, cat AS threat_category, kind AS content_type, count(*) AS threat_count
FROM flagged GROUP BY ALL""")
    head = "cat AS threat_category, id, source, kind AS content_type, level AS threat_severity, seen AS enrichment_timestamp"
    out["latest_threats"] = _with(f"""{_LAST}
SELECT {head}, IF(kind = 'text', left(title, 100), concat('Image: ', left(body, 80))) || '...' AS preview,
       nullif(path, '') AS image_path
FROM shown""")
    out["latest_threats_brief"] = _with(f"{_LAST}\nSELECT {head}, left(concat(title, path), 80) AS preview FROM shown")
    out["severity_over_time"] = _with(f"""{_EVENTS},
days AS (SELECT CAST(seen AS DATE) AS event_date, count(*) AS whole FROM events GROUP BY ALL),
levels AS (SELECT CAST(seen AS DATE) AS event_date, level, count(*) AS part FROM events GROUP BY ALL)
SELECT event_date, level AS threat_severity, part AS "count", {_share('part', 'whole')} AS percentage
FROM levels JOIN days USING (event_date)""")
    out["severity_distribution"] = _with(f"""{_EVENTS},
levels AS (SELECT level, count(*) FILTER (WHERE len(cats) > 0) AS part FROM events GROUP BY level)
SELECT level AS threat_severity, part AS "count", {_share('part', '(SELECT sum(part) FROM levels)')} AS percentage
FROM levels WHERE part > 0""")
    out["top_sources"] = _with(f"""{_EVENTS},
per_source AS (SELECT cat, source, count(*) AS n FROM flagged GROUP BY ALL)
SELECT a.cat AS threat_category, a.source, a.n AS threat_count, 1 + count(b.source) AS source_rank
FROM per_source a LEFT JOIN per_source b ON a.cat = b.cat AND b.n > a.n GROUP BY ALL""")
    read = f"count(*) AS total_images, count(*) FILTER (WHERE text_length > 0) AS ocr_success_count, {_share('count(*) FILTER (WHERE text_length > 0)', 'count(*)')} AS ocr_success_rate"
    out["ocr_success_daily"] = _with(f"""x AS (SELECT 1)
SELECT CAST(enrichment_timestamp AS DATE) AS event_date, source, {read}, avg(text_length) AS avg_extracted_text_length
FROM images_enriched GROUP BY ALL""")
    out["ocr_success_by_source"] = _with(f"x AS (SELECT 1)\nSELECT source, {read} FROM images_enriched GROUP BY source")
    return out


def operator_sql() -> dict[str, str]:
    out = {}
    detect = """SELECT id, category,
       coalesce(string_agg(term, '|' ORDER BY term_ord) FILTER (WHERE kind = 'keyword'), '') AS matched_keywords,
       coalesce(string_agg(term, '|' ORDER BY term_ord) FILTER (WHERE kind = 'pattern'), '') AS matched_patterns,
       CAST(sum(weight) AS FLOAT) AS threat_score
FROM text_hits GROUP BY id, category"""
    out["detect_threats"] = _with(f"x AS (SELECT 1)\n{detect}")
    out["detect_threats_join"] = out["detect_threats"]
    out["detect_threats_arrow"] = out["detect_threats"]
    out["threat_score"] = _with("""s AS (SELECT id, sum(weight) AS score, count(DISTINCT category) AS n FROM text_hits GROUP BY id)
SELECT r.id, CAST(coalesce(s.score, 0) AS DOUBLE) AS threat_score, CAST(coalesce(s.n, 0) AS INTEGER) AS n_categories
FROM text_raw r LEFT JOIN s ON r.id = s.id""")
    out["threat_severity"] = _with("""x AS (SELECT 1)
SELECT id, threat_severity, is_threat FROM text_enriched""")
    out["enrich_text"] = _with("""x AS (SELECT 1)
SELECT id, source, content_hash, is_threat, threat_severity,
       array_to_string(threat_categories, '|') AS threat_categories, enrichment_timestamp,
       md5(concat_ws('||', id, content_hash, CAST(enrichment_timestamp AS VARCHAR))) AS enrichment_id
FROM text_enriched""")
    out["enrich_images"] = _with("""x AS (SELECT 1)
SELECT id, source, filepath, image_hash, ocr_success, text_length, is_threat, threat_severity,
       array_to_string(threat_categories, '|') AS threat_categories, enrichment_timestamp,
       md5(concat_ws('||', id, image_hash, CAST(enrichment_timestamp AS VARCHAR))) AS enrichment_id
FROM images_enriched""")
    out["stream_enrich_text"] = _with("""x AS (SELECT 1)
SELECT id, source, content_hash, is_threat, threat_severity,
       array_to_string(threat_categories, '|') AS threat_categories
FROM text_enriched""")
    out["maintained_stats"] = _with("""x AS (SELECT 1)
SELECT 'severity' AS kind, threat_severity AS name, count(*) AS "count" FROM text_enriched GROUP BY ALL
UNION ALL
SELECT 'category', u.cat, count(*) FROM text_enriched t, unnest(t.threat_categories) AS u(cat) GROUP BY ALL""")
    # whatever was enriched first, folded or written again: the last enrichment of each row counts
    out["compacted_upserts"] = out["stream_enrich_text"]
    out["stream_enrich_images"] = _with("""x AS (SELECT 1)
SELECT id, source, image_hash, ocr_success, text_length, is_threat, threat_severity,
       array_to_string(threat_categories, '|') AS threat_categories
FROM images_enriched""")
    out["stream_first_seen"] = _with("x AS (SELECT 1)\nSELECT id, content_hash, 1 AS rows_written FROM text_raw")
    # the stream sees every page twice (landed, then replayed)
    out["batch_metrics"] = _with("""x AS (SELECT 1)
SELECT 2 * COUNT(*) AS records, CAST(2 * SUM(CASE WHEN is_threat THEN 1 ELSE 0 END) AS BIGINT) AS threats,
       CAST(2 * SUM(CASE WHEN ocr_success THEN 1 ELSE 0 END) AS BIGINT) AS ocr_success
FROM images_enriched""")
    out["extract_text"] = _with("""x AS (SELECT 1)
SELECT id, extracted_text, CAST(length(extracted_text) AS INTEGER) AS text_length FROM images_raw""")
    out["content_hash"] = _with("""x AS (SELECT 1)
SELECT id, content_hash FROM text_raw""")
    out["image_hash"] = _with("""x AS (SELECT 1)
SELECT id, filepath, image_hash FROM images_raw""")
    return out


def _any_contains(col: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({col}, {q(w)})" for w in words) + ")"


def prepare_sql() -> dict[str, str]:
    out = {}
    for variant, words, label, detected in (
            ("a", FALLBACK_A_WORDS, FALLBACK_A_CATEGORY, None),
            ("b", FALLBACK_B_WORDS, FALLBACK_B_CATEGORY, FALLBACK_B_DETECTED)):
        det = f"CASE WHEN is_threat THEN {q(detected)} ELSE '' END" if detected else "''"
        out[f"fallback_classifier_{variant}"] = _with(f"""fb AS (
  SELECT id, CASE WHEN {_any_contains('text', words)} THEN true ELSE false END AS is_threat FROM text_raw)
SELECT id, is_threat, CASE WHEN is_threat THEN 'medium' ELSE 'benign' END AS threat_severity,
       CASE WHEN is_threat THEN {q(label)} ELSE '' END AS threat_categories,
       {det} AS detected_threats
FROM fb""")
    out["harmonize_schema"] = _with(f"""fb AS (
  SELECT id, CASE WHEN {_any_contains('text', FALLBACK_A_WORDS)} THEN true ELSE false END AS is_threat FROM text_raw)
SELECT id, is_threat, CASE WHEN is_threat THEN 'medium' ELSE 'benign' END AS threat_severity,
       CASE WHEN is_threat THEN {q(LEGACY_FILL_CATEGORY)} ELSE '' END AS threat_categories,
       CASE WHEN is_threat THEN {q(LEGACY_FILL_DETECTED)} ELSE '' END AS detected_threats
FROM fb""")
    out["keyword_lookup_join"] = _with("""lk AS (SELECT DISTINCT category, term AS keyword FROM terms WHERE kind = 'keyword')
SELECT lk.category, lk.keyword, COUNT(*) AS doc_count
FROM (SELECT id, lower(concat_ws(' ', title, text)) AS lt FROM text_raw) d
JOIN lk ON contains(d.lt, lk.keyword)
GROUP BY lk.category, lk.keyword ORDER BY doc_count DESC, lk.category, lk.keyword""")
    return out


def ingest_sql() -> dict[str, str]:
    out = {}
    as_of = f"TIMESTAMP '{TEST_AS_OF} 00:00:00'"
    out["ingest_text"] = _with(f"""x AS (SELECT 1)
SELECT id, source, title, text, timestamp, {as_of} AS ingestion_timestamp, content_hash
FROM text_raw WHERE id IS NOT NULL AND text IS NOT NULL AND source IS NOT NULL""")
    out["ingest_images"] = _with(f"""x AS (SELECT 1)
SELECT id, source, filepath, file_size, timestamp, {as_of} AS ingestion_timestamp, image_hash
FROM images_raw WHERE id IS NOT NULL AND filepath IS NOT NULL AND source IS NOT NULL""")
    out["merge_insert_only"] = _with("""tgt AS (SELECT id, source, content_hash FROM text_raw WHERE lang = 'en'),
src AS (SELECT id, source, content_hash FROM text_raw UNION ALL SELECT id, source, content_hash FROM text_raw)
SELECT * FROM tgt
UNION ALL
SELECT DISTINCT * FROM src WHERE content_hash NOT IN (SELECT content_hash FROM tgt)""")
    out["load_raw"] = _with("x AS (SELECT 1)\nSELECT id, source, content_hash FROM text_raw")
    out["merge_upsert"] = _with(f"""fb AS (
  SELECT id, CASE WHEN {_any_contains('text', FALLBACK_A_WORDS)} THEN true ELSE false END AS hit FROM text_raw)
SELECT r.id, r.content_hash,
       CASE WHEN r.lang IN ('fr', 'de') THEN e.is_threat ELSE fb.hit END AS is_threat,
       CASE WHEN r.lang IN ('fr', 'de') THEN e.threat_severity
            WHEN fb.hit THEN 'medium' ELSE 'benign' END AS threat_severity,
       CASE WHEN r.lang IN ('fr', 'de') THEN r.ts + INTERVAL 1 DAY ELSE r.ts END AS enrichment_timestamp
FROM text_raw r JOIN text_enriched e ON r.id = e.id JOIN fb ON r.id = fb.id""")
    out["ingest_stats_text"] = _with("""x AS (SELECT 1)
SELECT COUNT(*) AS total_records, COUNT(DISTINCT source) AS unique_sources FROM text_raw""")
    out["ingest_stats_images"] = _with("""x AS (SELECT 1)
SELECT COUNT(*) AS total_images, COUNT(DISTINCT source) AS unique_sources,
       CAST(SUM(file_size) AS DOUBLE) / (1024 * 1024) AS total_size_mb FROM images_raw""")
    out["records_by_source"] = _with("""x AS (SELECT 1)
SELECT source, COUNT(*) AS "count" FROM text_raw GROUP BY source ORDER BY "count" DESC, source""")
    out["stream_stats_text"] = _with("""x AS (SELECT 1)
SELECT COUNT(*) AS total_records,
       CAST(SUM(CASE WHEN is_threat THEN 1 ELSE 0 END) AS BIGINT) AS threat_records,
       CAST(SUM(CASE WHEN NOT is_threat THEN 1 ELSE 0 END) AS BIGINT) AS benign_records
FROM text_enriched""")
    out["stream_stats_images"] = _with("""x AS (SELECT 1)
SELECT COUNT(*) AS total_images,
       CAST(SUM(CASE WHEN is_threat THEN 1 ELSE 0 END) AS BIGINT) AS threat_images,
       CAST(SUM(CASE WHEN NOT is_threat THEN 1 ELSE 0 END) AS BIGINT) AS benign_images,
       CAST(SUM(CASE WHEN ocr_success THEN 1 ELSE 0 END) AS BIGINT) AS ocr_success_count,
       AVG(CASE WHEN ocr_success THEN text_length END) AS avg_text_length
FROM images_enriched""")
    out["stats_category_distribution"] = _with("""x AS (SELECT 1)
SELECT category, COUNT(*) AS "count", 'text' AS content_type
FROM (SELECT unnest(threat_categories) AS category FROM text_enriched WHERE is_threat) GROUP BY category
UNION ALL
SELECT category, COUNT(*) AS "count", 'image' AS content_type
FROM (SELECT unnest(threat_categories) AS category FROM images_enriched WHERE is_threat) GROUP BY category""")
    out["stats_severity_distribution"] = _with("""x AS (SELECT 1)
SELECT threat_severity, COUNT(*) AS "count", 'text' AS content_type FROM text_enriched GROUP BY threat_severity
UNION ALL
SELECT threat_severity, COUNT(*) AS "count", 'image' AS content_type FROM images_enriched GROUP BY threat_severity""")
    return out


def _collected_ctes() -> str:
    conv_ts = "(TIMESTAMP '1970-01-01' + to_seconds(1704067200 + conv_id * 3600 + turn * 60))"
    post = "CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR)"
    body = "trim(regexp_replace(text, '[\\t\\n\\r ]+', ' ', 'g'))"
    return f"""wiki AS (
  SELECT 'wiki_' || CAST(doc_id AS VARCHAR) AS id, {q(WIKI_SOURCE)} AS source, substring(text, 1, 60) AS title,
         text, 'https://wiki.example.org/' || CAST(doc_id AS VARCHAR) AS url,
         '{TEST_AS_OF}T00:00:00' AS timestamp, {q(WIKI_AUTHOR)} AS author, lang AS description
  FROM documents),
social AS (
  SELECT 'reddit_' || {post} AS id, 'reddit_r_' || role AS source, substring(text, 1, 80) AS title,
         CASE WHEN role = 'assistant' AND text <> '' THEN text ELSE substring(text, 1, 80) END AS text,
         {q(SOCIAL_URL_PREFIX)} || '/r/' || role || '/comments/' || {post} AS url,
         strftime({conv_ts}, '%Y-%m-%dT%H:%M:%S') AS timestamp, role AS author,
         CAST(turn AS VARCHAR) AS score, CAST(length(text) AS VARCHAR) AS num_comments,
         CASE WHEN turn % 2 = 1 THEN 'true' ELSE 'false' END AS is_video
  FROM conversations),
rss AS (
  SELECT 'news_' || md5(link) AS id, role || '.example.com' AS source, trim(substring(body, 1, 60)) AS title,
         body AS text, link AS url,
         CASE WHEN turn % 2 = 0 THEN strftime({conv_ts}, '%a, %d %b %Y %H:%M:%S GMT')
              ELSE '{TEST_AS_OF}T00:00:00' END AS timestamp,
         CASE WHEN role = 'user' THEN CAST(conv_id AS VARCHAR) ELSE {q(UNKNOWN_AUTHOR)} END AS author,
         {q(NEWS_DEFAULT_CATEGORY)} AS category
  FROM (SELECT *, {body} AS body,
               'https://' || role || '.example.com/item/' || CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) AS link
        FROM conversations)),
collected AS (
  SELECT id, source, title, text FROM wiki UNION ALL SELECT id, source, title, text FROM rss
  UNION ALL SELECT id, source, title, text FROM social),
catalog AS (
  SELECT source || '_' || substring(md5(html), 1, 8) AS id, source, url AS filepath,
         CAST(strlen(html) AS BIGINT) AS file_size, md5(html) AS content_md5
  FROM (SELECT *, regexp_extract(url, {q(URL_HOST_RE)}, 1) AS source FROM pages))"""


def collect_sql() -> dict[str, str]:
    out = {}
    c = _collected_ctes()
    out["normalize_wiki"] = _with(f"{c}\nSELECT * FROM wiki")
    out["normalize_social"] = _with(f"{c}\nSELECT * FROM social")
    out["normalize_rss"] = _with(f"{c}\nSELECT * FROM rss")
    out["union_sources"] = _with(f"{c}\nSELECT * FROM collected")
    out["collection_stats_text"] = _with(f"""{c}
SELECT COUNT(*) AS total_samples,
       CAST(SUM(CASE WHEN source = {q(WIKI_SOURCE)} THEN 1 ELSE 0 END) AS BIGINT) AS wikipedia,
       CAST(SUM(CASE WHEN contains(id, 'news') THEN 1 ELSE 0 END) AS BIGINT) AS news,
       CAST(SUM(CASE WHEN contains(id, 'reddit') THEN 1 ELSE 0 END) AS BIGINT) AS reddit
FROM collected""")
    out["image_catalog"] = _with(f"{c}\nSELECT * FROM catalog")
    fams = ",\n       ".join(f"count(*) FILTER (WHERE page_id % {len(IMAGE_FAMILIES)} = {k}) AS {f}" for k, f in enumerate(IMAGE_FAMILIES))
    out["collection_stats_images"] = _with(f"""x AS (SELECT 1)
SELECT count(*) AS total_images, {fams}, coalesce(sum(strlen(html)), 0) / 1048576.0 AS total_size_mb FROM pages""")
    spoken = "(TIMESTAMP '1970-01-01' + to_seconds(1704067200 + conv_id * 3600 + turn * 60))"
    out["recent_events"] = _with(f"""x AS (SELECT 1),
own AS (
  SELECT {AS_OF}::TIMESTAMP AS at_time, {q(WIKI_SOURCE)} AS source FROM documents
  UNION ALL SELECT CASE WHEN turn % 2 = 0 THEN {spoken} ELSE {AS_OF}::TIMESTAMP END, role || '.example.com' FROM conversations
  UNION ALL SELECT {spoken}, 'reddit_r_' || role FROM conversations)
SELECT CAST(at_time AS DATE) AS event_date, source, count(*) AS n, min(at_time) AS first_time
FROM own WHERE at_time >= {AS_OF} - INTERVAL 3 DAY GROUP BY ALL""")
    sized = "page_id % 60000 + 1 AS width, length(coalesce(html, '')) % 60000 + 1 AS height"
    out["image_headers"] = _with(f"""x AS (SELECT 1)
SELECT page_id, 'whole' AS state, k.kind, CAST(width AS INTEGER) AS width, CAST(height AS INTEGER) AS height
FROM (SELECT page_id, {sized} FROM pages), (VALUES ('png'), ('jpeg'), ('gif')) AS k(kind)""")
    families = ", ".join(q(f) for f in IMAGE_FAMILIES)
    out["image_landing"] = _with(f"""x AS (SELECT 1),
own AS (SELECT *, [{families}][page_id % {len(IMAGE_FAMILIES)} + 1] AS source, {sized} FROM pages)
SELECT source || '_' || kind AS id_prefix, source, url, url || '/' || kind || '/whole' AS filepath, width || 'x' || height AS dimensions,
       kind AS category, '{TEST_AS_OF}T00:00:00' AS timestamp,
       CASE source WHEN 'unsplash' THEN 'Unsplash License' WHEN 'picsum' THEN 'Creative Commons CC0' ELSE 'Free to use' END AS license,
       CASE WHEN source IN ('unsplash', 'picsum') THEN kind END AS search_term
FROM own, (VALUES ('png'), ('jpeg'), ('gif')) AS k(kind)""")
    rank = "row_number() OVER (PARTITION BY conv_id, role ORDER BY turn)"
    out["first_items"] = _with(f"""{c},
numbered AS (SELECT conv_id, turn, role, {rank} AS k FROM conversations)
SELECT r.id, r.source, r.title FROM rss r
JOIN numbered n ON r.id = 'news_' || md5('https://' || n.role || '.example.com/item/' || n.conv_id || '/' || n.turn) WHERE n.k <= 2
UNION ALL
SELECT s.id, s.source, s.title FROM social s JOIN numbered n ON s.id = 'reddit_' || n.conv_id || '_' || n.turn WHERE n.k <= 2""")
    out["broken_payloads"] = _with(f"""{c},
groups AS (SELECT DISTINCT conv_id, role FROM conversations),
reasons(kind, name) AS (VALUES ('rss', 'unreadable'), ('rss', 'unreadable'), ('rss', 'no payload'),
                        ('social', 'unreadable'), ('social', 'no items'), ('social', 'no payload'))
SELECT 'record' AS kind, source AS name, count(*) AS n FROM collected GROUP BY ALL
UNION ALL
SELECT kind, name, count(*) FROM reasons, groups GROUP BY ALL
UNION ALL
SELECT 'wiki', u.name, count(*) FROM documents, (VALUES ('unreadable'), ('no payload')) AS u(name) GROUP BY ALL""")
    kinds = " OR ".join(f"starts_with(head, {q(o)})" for o in HTML_OPENINGS)
    out["image_valid_filter"] = _with(f"""x AS (SELECT 1)
SELECT id, 'html' AS content_kind
FROM (SELECT 'page_' || CAST(page_id AS VARCHAR) AS id,
             lower(regexp_replace(html, '^(\\x{{FEFF}}|\\s|<\\?xml[^>]*>|<!--(.|\\n)*?-->)*', '')) AS head FROM pages)
WHERE {kinds}""")
    out["scan_text_json"] = _with("""x AS (SELECT 1)
SELECT id, source, title, text, url, timestamp, NULL::VARCHAR AS author, lang FROM text_raw""")
    out["scan_text_arrays"] = out["scan_text_json"]
    out["scan_image_json"] = _with("""x AS (SELECT 1)
SELECT id, source, filepath, file_size, timestamp FROM images_raw""")
    return out


def oracle_queries() -> dict[str, str]:
    out = analytics_sql()
    out.update(operator_sql())
    out.update(prepare_sql())
    out.update(ingest_sql())
    out.update(collect_sql())
    return out
