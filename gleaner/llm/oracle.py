"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from gleaner.llm.quality import RULES

_MEASURES = r"""
word AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents)
),
triple AS (
  SELECT doc_id, word, pos, (word || ' ' || (lead(word) OVER d) || ' ' || (lead(word, 2) OVER d)) AS three
  FROM word WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
),
found AS (
  SELECT doc_id, word, pos, three IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, three) > 1 AS again FROM triple
),
covered AS (
  SELECT doc_id, word, again OR coalesce(lag(again) OVER d, false) OR coalesce(lag(again, 2) OVER d, false) AS inside
  FROM found WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
),
words AS (
  SELECT doc_id, count(*) AS n_words, CAST(sum(length(word)) AS BIGINT) AS word_chars,
    CAST(sum(CASE WHEN inside THEN 1 ELSE 0 END) AS BIGINT) AS n_repeat_words
  FROM covered GROUP BY doc_id
),
lines AS (
  SELECT doc_id, count(line) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
measured AS (
  SELECT d.doc_id, d.source, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    CAST(coalesce(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')), 0) AS BIGINT) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM documents d LEFT JOIN words w ON d.doc_id = w.doc_id LEFT JOIN lines l ON d.doc_id = l.doc_id
)"""


def _shrunk(rule: str) -> str:
    mean = f"(all_{rule} / docs)"
    between = f"greatest(square_{rule} / docs - {mean} * {mean} - {mean} * (1 - {mean}) * hosts / docs, 1e-9)"
    strength = f"greatest({mean} * (1 - {mean}) / {between} - 1, 1.0)"
    return f"(k_{rule} + {mean} * {strength}) / (n + {strength})"


def quality_verdicts() -> str:
    """``measured`` and ``verdict`` (doc_id, base_failed, host_rejected), as common table expressions."""
    ks = ", ".join(f"sum(CASE WHEN {r.fails} THEN 1 ELSE 0 END) AS k_{r.name}" for r in RULES)
    sums = ", ".join(f"sum(k_{r.name}) AS all_{r.name}, sum(k_{r.name} * k_{r.name} / n) AS square_{r.name}" for r in RULES)
    over = " OR ".join(f"{_shrunk(r.name)} > {r.most}" for r in RULES)
    return f"""{_MEASURES},
host AS (SELECT source, count(*) AS n, {ks} FROM measured WHERE source IS NOT NULL GROUP BY source),
corpus AS (SELECT sum(n) AS docs, count(*) AS hosts, {sums} FROM host),
bad AS (SELECT source, {over} AS host_rejected FROM host, corpus),
verdict AS (
  SELECT m.*, ({RULES[0].fails}) AS base_failed, coalesce(host_rejected, false) AS host_rejected
  FROM measured m LEFT JOIN bad b ON m.source = b.source
)"""


QUALITY = f"""WITH {quality_verdicts()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_rejected,
  NOT base_failed AND NOT host_rejected AS kept FROM verdict"""

# A source's slots are the golden-ratio points in its interval; they cover whole passes over its stream and a prefix of it.
MIXING = r"""WITH sized AS (
  SELECT doc_id, source, md5('11|' || doc_id) AS key,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid
  FROM sized GROUP BY source
),
unit AS (SELECT least(2048, greatest(1, CAST(sum(source_size) AS BIGINT) // 1048576)) AS block FROM src),
weighed AS (SELECT *, 3 * source_size AS cap, [5, 2, 1][sid % 3 + 1] AS weight, sum(source_size) OVER () AS words FROM src),
rated AS (
  SELECT *, row_number() OVER r AS rank, (words - coalesce(sum(cap) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS rate
  FROM weighed WINDOW r AS (ORDER BY cap / weight, sid), b AS (ORDER BY cap / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
cut AS (SELECT min(rank) AS first, arg_min(rate, rank) AS rate FROM rated WHERE rate * weight <= cap),
plan AS (
  SELECT source, sid, source_size, CASE WHEN rank < first THEN CAST(cap AS DOUBLE) ELSE cut.rate * weight END AS target, cap FROM rated, cut
),
goals AS (
  SELECT *, least(CAST(floor(target + 0.5) AS BIGINT), cap) AS goal, (source_size + block - 1) // block AS blocks FROM plan, unit
),
quota AS (
  SELECT *, CASE WHEN goal > 0 THEN greatest(1, CAST(floor(goal / source_size * blocks + 0.5) AS BIGINT)) ELSE 0 END AS slots FROM goals
),
edged AS (
  SELECT *, CAST(sum(slots) OVER (ORDER BY sid) AS HUGEINT) AS cum, CAST(sum(slots) OVER () AS HUGEINT) AS total FROM quota
),
ranges AS (SELECT sid, blocks, (cum - slots) * 4294967296 // total AS low, cum * 4294967296 // total AS high FROM edged),
points AS (SELECT k, CAST((CAST(k AS HUGEINT) * 2654435769) % 4294967296 AS BIGINT) AS x FROM range((SELECT CAST(max(total) AS BIGINT) FROM edged)) t(k)),
ranked AS (
  SELECT sid, blocks, k, row_number() OVER (PARTITION BY sid ORDER BY k) - 1 AS j FROM points JOIN ranges ON x >= low AND x < high
),
slot AS (SELECT sid, k, j FROM ranked WHERE j < 3 * blocks),
held AS (SELECT sid, count(*) AS got FROM slot GROUP BY sid),
placed AS (
  SELECT s.*, e.sid, source_size, target, blocks, block, coalesce(got, 0) AS got,
    CAST(coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM sized s JOIN edged e ON s.source IS NOT DISTINCT FROM e.source LEFT JOIN held h ON h.sid = e.sid
),
took AS (
  SELECT *, CAST(CASE WHEN size = 0 THEN 0 ELSE got // blocks * size + greatest(least(got % blocks * block - start, size), 0) END AS BIGINT) AS taken
  FROM placed
)
SELECT doc_id, source, size, source_size, target, taken, k AS first_slot
FROM took t LEFT JOIN slot s ON t.taken > 0 AND s.sid = t.sid AND s.j = t.start // t.block"""

CHAT = r"""WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    md5(length(coalesce(role, '')) || '|' || coalesce(role, '') || coalesce(text, '')) AS content
  FROM conversations WHERE conv_id IS NOT NULL
),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, content) AS n FROM said),
whole AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(content, '' ORDER BY n) AS key,
    string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY n) AS rendered
  FROM placed GROUP BY conv_id
),
once AS (SELECT key, min(conv_id) AS conv_id FROM whole GROUP BY key),
begun AS (SELECT DISTINCT substr(key, 1, 32 * CAST(k AS INTEGER)) AS key FROM whole, unnest(range(1, n_turns)) AS t(k))
SELECT w.conv_id, n_turns, rendered FROM whole w JOIN once o ON w.conv_id = o.conv_id
WHERE w.key NOT IN (SELECT key FROM begun)"""

WARC = """WITH sized AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
),
placed AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM sized
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to FROM placed"""
