"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_CORPUS = """corpus AS (
  SELECT o_orderkey AS record_id, CAST(year(o_orderdate) AS VARCHAR) AS year, n_name AS institution
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
)"""
_FACETS = f"""{_CORPUS},
years AS (SELECT year AS value, count(*) AS count FROM corpus WHERE year IS NOT NULL GROUP BY year ORDER BY year DESC LIMIT 4),
all_inst AS (SELECT institution AS value, count(*) AS count FROM corpus WHERE institution IS NOT NULL GROUP BY institution),
inst AS (SELECT * FROM all_inst ORDER BY count DESC, value LIMIT 20)"""
_COVER = f"""{_FACETS},
cover AS (
  SELECT value AS label, 'year' AS kind, CAST(row_number() OVER (ORDER BY value DESC) - 1 AS INTEGER) AS priority, count AS total FROM years
  UNION ALL SELECT 'other years', 'other', (SELECT CAST(count(*) AS INTEGER) FROM years), (SELECT count(*) FROM corpus WHERE year NOT IN (SELECT value FROM years))
  UNION ALL SELECT 'no year', 'none', (SELECT CAST(count(*) + 1 AS INTEGER) FROM years), (SELECT count(*) FROM corpus WHERE year IS NULL)
)"""
_PLAN = f"""{_COVER},
ranked AS (SELECT value, CAST(row_number() OVER (ORDER BY count DESC, value) AS INTEGER) AS child FROM inst),
big AS (SELECT * FROM cover WHERE kind = 'year' AND total > 1000),
rows AS (
  SELECT label, kind, CAST(NULL AS VARCHAR) AS parent, priority AS parent_priority, 0 AS child, total FROM cover
  UNION ALL
  SELECT b.label || ' / ' || r.value, 'institution', b.label, b.priority, r.child,
    (SELECT count(*) FROM corpus c WHERE c.year = b.label AND c.institution = r.value)
  FROM big b, ranked r
  UNION ALL
  SELECT b.label || ' / other institutions', 'residual', b.label, b.priority, (SELECT CAST(count(*) + 1 AS INTEGER) FROM ranked),
    (SELECT count(*) FROM corpus c WHERE c.year = b.label AND (c.institution IS NULL OR c.institution NOT IN (SELECT value FROM inst)))
  FROM big b
),
states AS (SELECT *, CASE WHEN total > 1000 AND kind = 'year' THEN 'split' WHEN total > 1000 THEN 'partial' ELSE 'complete' END AS status FROM rows),
plan AS (
  SELECT *, CAST(CASE WHEN status = 'split' THEN 0 ELSE ceil(least(total, 1000) / 100) END AS INTEGER) AS pages,
    CASE WHEN status = 'partial' THEN total - 1000 ELSE 0 END AS inaccessible FROM states
)"""
_DOCS = "docs AS (SELECT doc_id, sha256(text) AS sha, CAST(strlen(text) AS BIGINT) AS bytes, lang, source, text FROM documents)"
_DISTINCT = f"{_DOCS},\nunique_files AS (SELECT sha, arg_max(bytes, doc_id) AS bytes, count(*) AS records FROM docs GROUP BY sha)"
_FIT = f"""{_DISTINCT},
sorted AS (SELECT row_number() OVER (ORDER BY sha) AS i, bytes FROM unique_files),
fold AS (
  SELECT i, bytes, CAST(1 AS BIGINT) AS batch, bytes AS size FROM sorted WHERE i = 1
  UNION ALL
  SELECT s.i, s.bytes, CASE WHEN f.size >= 500000 THEN f.batch + 1 ELSE f.batch END, CASE WHEN f.size >= 500000 THEN s.bytes ELSE f.size + s.bytes END
  FROM fold f JOIN sorted s ON s.i = f.i + 1
),
batch AS (SELECT batch, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes FROM fold GROUP BY batch)"""
_URL = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)"
_HOST = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)"
_PATH = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
_QUERY = r"regexp_extract(url, '^[^?#]*\?([^#]*)', 1)"
_NAME = f"string_split({_PATH}, '/')[-1]"
_US = "epoch_us({})"


SQL = {
    "retry_after_parse": """WITH r(id, raw) AS (VALUES (1, '120'), (2, ''), (3, NULL), (4, 'Wed, 21 Oct 2026 07:28:00 GMT'), (5, 'soon'), (6, '-5'), (7, ' 1.5 '), (8, 'Wed, 21 Oct 2015 07:28:00 GMT')),
p AS (SELECT id, trim(coalesce(raw, '')) AS t, try_cast(trim(coalesce(raw, '')) AS DOUBLE) AS n, try_strptime(trim(coalesce(raw, '')), '%a, %d %b %Y %H:%M:%S GMT') AS d FROM r)
SELECT CAST(id AS INTEGER) AS id,
  greatest(CAST(CASE WHEN t = '' THEN 3600 WHEN n IS NOT NULL THEN n WHEN d IS NOT NULL THEN (epoch_us(d) - epoch_us(TIMESTAMP '2026-10-21 07:00:00')) / 1e6 ELSE 3600 END AS DOUBLE), 0) AS seconds,
  CASE WHEN t = '' THEN 'client_policy_no_retry_after' WHEN n IS NULL AND d IS NULL THEN 'client_policy_invalid_retry_after' ELSE 'server_retry_after' END AS source
FROM p""",
    "facet_years": f"WITH {_CORPUS} SELECT year AS value, count(*) AS count FROM corpus WHERE year IS NOT NULL GROUP BY year",
    "facet_institutions": f"WITH {_FACETS} SELECT * FROM all_inst",
    "smallest_facet": f"WITH {_FACETS} SELECT value, count FROM all_inst ORDER BY count, value LIMIT 1",
    "partition_cover": f"WITH {_COVER} SELECT * FROM cover",
    "partition_plan": f"WITH {_PLAN} SELECT * FROM plan",
    "split_coverage": f"""WITH {_PLAN}
SELECT p.label, p.total AS parent_total, count(c.label) AS children, count(c.total) AS children_with_total,
  CAST(sum(c.total) AS BIGINT) AS children_total, sum(c.total) = p.total AS matches
FROM plan p JOIN plan c ON c.parent = p.label WHERE p.status = 'split' GROUP BY p.label, p.total""",
    "complement_check": f"""WITH {_FACETS},
y AS (SELECT value AS year, count AS year_expected FROM years ORDER BY count, value LIMIT 1),
i AS (SELECT value AS institution FROM all_inst ORDER BY count DESC, value LIMIT 1),
n AS (
  SELECT count(*) AS root, count(*) FILTER (c.year = y.year) AS year_observed, count(*) FILTER (c.year = y.year AND c.institution = i.institution) AS child,
    count(*) FILTER (c.year = y.year AND c.institution IS DISTINCT FROM i.institution) AS residual, count(*) FILTER (c.year IS NULL) AS no_year,
    count(*) FILTER (c.year NOT IN (SELECT value FROM years)) AS other_years
  FROM corpus c, y, i
)
SELECT root, year, year_expected, year_observed, institution, child, residual, no_year, other_years,
  year_observed - child = residual AS residual_matches, root - (SELECT sum(count) FROM years) - no_year = other_years AS other_matches FROM n, y, i""",
    "next_partition": f"""WITH {_CORPUS}, parts AS (SELECT year AS id, 3000 - CAST(year AS INTEGER) AS priority, count(*) AS count FROM corpus GROUP BY year)
SELECT id, priority, 'harvesting' AS status FROM parts WHERE count > (SELECT avg(count) FROM parts) ORDER BY priority, id LIMIT 1""",
    "partition_states": f"""WITH {_CORPUS}, cells AS (SELECT year, institution, count(*) AS total FROM corpus GROUP BY ALL)
SELECT *, CASE WHEN total <= 100 THEN 'complete' ELSE 'harvesting' END AS next_status, CASE WHEN total > 100 THEN 2 END AS next_page FROM cells""",
    "coverage_report": f"""WITH RECURSIVE {_FIT}, {_PLAN},
p AS (
  SELECT count(*) AS partitions, count(*) FILTER (status = 'complete') AS complete, count(*) FILTER (status = 'split') AS split,
    count(*) FILTER (status = 'partial') AS partial, CAST(sum(inaccessible) AS BIGINT) AS inaccessible_records FROM plan
),
l AS (SELECT count(*) AS links, count(DISTINCT sha) AS records, count(*) - count(DISTINCT sha) AS duplicate_links FROM (SELECT DISTINCT sha, lang FROM docs)),
b AS (SELECT count(*) AS closed_batches, CAST(coalesce(sum(files), 0) AS BIGINT) AS files, CAST(coalesce(sum(bytes), 0) AS BIGINT) AS bytes FROM batch WHERE bytes >= 500000)
SELECT * FROM p, l, b""",
    "record_first_wins": f"WITH {_DOCS} SELECT sha AS record_id, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source, arg_min(lang, doc_id) AS lang FROM docs GROUP BY sha",
    "record_last_wins": "SELECT user_id, ts, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    "partition_links_summary": f"""WITH {_DOCS}, links AS (SELECT DISTINCT sha, source FROM docs)
SELECT count(*) AS links, count(DISTINCT sha) AS records, count(*) - count(DISTINCT sha) AS duplicates FROM links""",
    "record_conflicts": f"""WITH {_DOCS}, keyed AS (SELECT *, lang || '-' || bytes AS record_id FROM docs)
SELECT record_id, doc_id, sha FROM keyed QUALIFY sha <> first_value(sha) OVER (PARTITION BY record_id ORDER BY doc_id)""",
    "normalize_props": "SELECT event_id, upper(event_type) AS kind, CAST(json_extract(props, '$.k') AS BIGINT) AS k, replace(props, ' ', '') AS canonical FROM events",
    "reject_split": """WITH d AS (
  SELECT d.doc_id, n_chars, CASE WHEN quality IS NULL THEN 'titulo_ausente' WHEN quality = 0 THEN 'titulo_vazio' END AS issue
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
), r AS (SELECT doc_id, issue, CASE WHEN n_chars <= 1000 THEN issue || '_e_sem_url_utilizavel' END AS reason FROM d)
SELECT *, reason IS NULL AS accepted FROM r""",
    "page_fingerprints": "SELECT conv_id, count(*) AS n, sha256(string_agg(text, chr(10) ORDER BY turn, text)) AS fingerprint FROM conversations GROUP BY conv_id",
    "repeated_pages": f"""WITH {_DOCS}
SELECT lang, doc_id, first_page FROM (SELECT lang, doc_id, min(doc_id) OVER (PARTITION BY lang, sha) AS first_page FROM docs) WHERE doc_id > first_page""",
    "snapshot_growth_check": """SELECT (SELECT count(*) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)) AS old, CAST(0 AS BIGINT) AS missing,
  CAST(0 AS BIGINT) AS changed, (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS added""",
    "import_compatibility": """SELECT page_id, CASE WHEN url NOT LIKE '%example.org%' AND url LIKE '%/en/%' THEN 'consulta_atual_com_quatro_campos' END AS basis FROM pages""",
    "file_dedupe": f"WITH {_DISTINCT} SELECT * FROM unique_files",
    "candidate_vs_site": f"""WITH {_DOCS}
SELECT count(DISTINCT CASE WHEN source <> 'src0' THEN sha END) AS candidates, count(DISTINCT CASE WHEN source = 'src0' THEN sha END) AS site_documents,
  (SELECT count(*) FROM (SELECT sha FROM docs GROUP BY sha HAVING bool_or(source = 'src0') AND bool_or(source <> 'src0'))) AS both FROM docs""",
    "pdf_duplicates": f"""WITH {_DOCS}, e AS (SELECT bytes, row_number() OVER (PARTITION BY sha ORDER BY doc_id) > 1 AS again FROM docs)
SELECT count(*) AS responses, count(*) FILTER (again) AS duplicates, CAST(coalesce(sum(bytes) FILTER (again), 0) AS BIGINT) AS duplicate_bytes FROM e""",
    "archived_skip": f"""WITH {_DOCS}
SELECT doc_id, sha IN (SELECT sha FROM docs d JOIN labels l ON d.doc_id = l.doc_id WHERE quality = 1) AS skip FROM docs""",
    "archived_results": f"""WITH {_DOCS}, least AS (SELECT lang, arg_min(sha, (bytes, doc_id)) AS sha, arg_min(bytes, (bytes, doc_id)) AS bytes FROM docs GROUP BY lang),
f AS (SELECT doc_id, sha, bytes FROM docs UNION ALL SELECT d.doc_id, l.sha, l.bytes FROM docs d JOIN least l ON d.lang = l.lang),
ok AS (SELECT doc_id, sha IN (SELECT sha FROM docs d JOIN labels l ON d.doc_id = l.doc_id WHERE toxic = 0) OR sha < '8' OR bytes = 0 AS good FROM f)
SELECT doc_id AS record_id, bool_and(good) AS valid FROM ok GROUP BY doc_id""",
    "late_associations": f"""WITH {_DOCS}, packed AS (SELECT sha, min(d.doc_id) AS batch_number FROM docs d JOIN labels l ON d.doc_id = l.doc_id GROUP BY sha)
SELECT d.doc_id AS record_id, d.sha, batch_number, CASE WHEN lang <> 'en' THEN source ELSE '' END AS source_url
FROM docs d JOIN packed p ON d.sha = p.sha WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)""",
    "pending_files": f"WITH {_DISTINCT} SELECT * FROM unique_files WHERE sha NOT IN (SELECT sha FROM docs d JOIN labels l ON d.doc_id = l.doc_id)",
    "batch_prefix": f"""WITH {_DISTINCT}, r AS (
  SELECT sha, bytes, CAST(coalesce(sum(bytes) OVER (ORDER BY sha ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM unique_files
) SELECT * FROM r WHERE before < 500000""",
    "batch_next_fit": f"WITH RECURSIVE {_FIT} SELECT * FROM batch",
    "tree_checksum": f"""WITH {_DOCS}, lines AS (SELECT source, 'pdfs/' || lpad(CAST(doc_id AS VARCHAR), 9, '0') AS path, sha FROM docs)
SELECT source, count(*) AS files, sha256(string_agg(sha || '  ' || path || chr(10), '' ORDER BY path)) AS tree_sha256 FROM lines GROUP BY source""",
    "manifest_join": f"WITH {_DOCS} SELECT d.doc_id AS record_id, 'pdfs/' || sha || '.pdf' AS pdf_path, source, bytes FROM labels l JOIN docs d ON l.doc_id = d.doc_id",
    "manifest_inclusion": """SELECT (SELECT count(DISTINCT doc_id) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)) AS only_left,
  (SELECT count(DISTINCT doc_id) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS only_right""",
    "budget_stop": f"""WITH {_DOCS}, r AS (
  SELECT doc_id, sha, bytes, CAST(coalesce(sum(bytes) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM docs
) SELECT * FROM r WHERE before < 500000""",
    "target_stop": f"""WITH {_DOCS}, m AS (SELECT doc_id, sha, CASE WHEN row_number() OVER (PARTITION BY sha ORDER BY doc_id) = 1 THEN 1 ELSE 0 END AS new FROM docs),
r AS (SELECT doc_id, sha, CAST(coalesce(sum(new) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS seen FROM m)
SELECT * FROM r WHERE seen < 150""",
    "url_caps": """SELECT user_id, event_id, count(*) OVER (PARTITION BY user_id) > 8 AS limited FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) <= 8""",
    "attempt_status_counts": "SELECT event_type AS status, count(*) AS n FROM events GROUP BY event_type",
    "failure_stage_counts": """SELECT CASE WHEN event_type <> 'view' THEN 'stage-' || right(json_extract_string(props, '$.k'), 1) ELSE 'nao_registrada' END AS stage, count(*) AS n
FROM events WHERE event_type <> 'purchase' GROUP BY 1""",
    "domain_status_pivot": f"""SELECT {_HOST} AS domain, CASE WHEN regexp_matches(html, '(?i)<a\\s[^>]*?href="([^"]*)"') THEN 'sucesso' ELSE 'nao_obtido' END AS status, count(*) AS n
FROM pages GROUP BY 1, 2""",
    "download_report": """WITH u AS (SELECT user_id, count(*) FILTER (event_type = 'purchase' AND CAST(floor(value) AS BIGINT) % 2 = 0) AS c FROM events GROUP BY user_id)
SELECT count(*) AS processed_records, 10000 - count(*) AS remaining_records, count(*) FILTER (c > 0) AS works_with_candidate_pdf,
  CAST(sum(greatest(c - 1, 0)) AS BIGINT) AS possible_extra_candidate_files FROM u""",
    "cooldown_state": f"""WITH s AS (SELECT user_id, max(ts) FILTER (event_type = 'error') AS b, max(ts) FILTER (event_type = 'purchase') AS s FROM events GROUP BY user_id)
SELECT user_id, {_US.format('b')} AS last_block, {_US.format('s')} AS last_success, {_US.format('b + INTERVAL 2 DAY')} AS blocked_until,
  coalesce(NOT coalesce(s > b, false) AND b + INTERVAL 2 DAY > TIMESTAMP '2024-01-15 00:00:00', false) AS active FROM s""",
    "retry_eligibility": """WITH l AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT user_id, CASE WHEN event_type = 'purchase' AND value <= 50 THEN 'skip'
  WHEN epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(ts) < 86400000000 THEN 'wait' ELSE 'retry' END AS verdict FROM l""",
    "host_pacing": """WITH n AS (SELECT event_id, user_id, epoch_us(ts) AS arrival_us, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events)
SELECT event_id, user_id, arrival_us,
  i * 3600000000 + max(arrival_us - i * 3600000000) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS start_us FROM n""",
    "raw_log_match": """SELECT a.event_id, b.event_id AS raw_id FROM events a JOIN events b ON a.event_type = b.event_type AND a.props = b.props AND a.event_id < b.event_id
WHERE abs(epoch_us(a.ts) - epoch_us(b.ts)) <= 120000000""",
    "url_parts": f"SELECT page_id, {_URL} AS origin, {_HOST} AS host, {_PATH} AS path, {_QUERY} AS query, {_NAME} AS name FROM pages",
    "host_counts": f"SELECT {_HOST} AS host, count(*) AS pages FROM pages GROUP BY 1",
    "candidate_identity": f"""WITH p AS (SELECT page_id, lower(regexp_extract(url, '^([a-z]+)', 1) || ' ' || {_HOST}) AS site, {_HOST} AS host, regexp_replace({_PATH}, '/+', '/', 'g') AS path, {_QUERY} AS query, lower({_NAME}) || '.pdf' AS name FROM pages)
SELECT page_id, f.form, CASE WHEN f.form < 2 THEN 'dspace ' || site || ' 1/2 ' || name ELSE 'url ' || site || ' ' || path || ' ' || query END AS identity
FROM p, (SELECT unnest([0, 1, 2]) AS form) f""",
    "anchor_targets": r"""WITH t AS (SELECT page_id, regexp_extract_all(html, '(?i)<a\s[^>]*?href="([^"]*)"', 1) AS t FROM pages)
SELECT page_id, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS position, unnest(t) AS target FROM t""",
    "site_document_filter": "SELECT page_id, url LIKE '%/en/%' OR url LIKE '%/es/%' AS is_site_document FROM pages",
    "challenge_pages": "SELECT page_id, html NOT LIKE '%<a href%' AS challenge FROM pages",
    "content_kinds": """SELECT page_id, CASE WHEN url LIKE '%/en/%' THEN 'pdf' WHEN url LIKE '%/de/%' OR url LIKE '%example.com%' THEN 'invalid_pdf'
  WHEN url LIKE '%example.net%' THEN 'html' ELSE 'other' END AS kind FROM pages""",
    "boolean_groups": """SELECT doc_id FROM documents WHERE (contains(lower(text), 'the') OR contains(lower(text), 'der')) AND (contains(lower(text), 'ing') OR contains(lower(text), 'ung'))""",
    "clean_urls": "SELECT page_id, regexp_replace(url, '#.*$', '') AS cleaned FROM pages",
    "robots_allowed": """SELECT page_id, CASE WHEN url LIKE '%example.org%' THEN 'robots_indisponivel' WHEN url LIKE '%example.com/en/%' THEN 'robots_bloqueado' ELSE 'allowed' END AS robots FROM pages""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
