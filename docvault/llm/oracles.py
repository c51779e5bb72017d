"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

BLANKS = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||' '"

OP7 = f"""
WITH lines AS (
  SELECT doc_id, pos, line,
         translate(trim(line, {BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
), common AS (
  SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT l.*, c.k IS NOT NULL AND l.doc_id <> c.keeper AS gone FROM lines l LEFT JOIN common c USING (k)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

#: Classes of documents that share enough shingles, as `doc_id, n_shingles, component_id`.
CLASSES = """
WITH RECURSIVE tokens AS (
  SELECT doc_id,
         list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[]
           WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM tokens
), entries AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM entries a JOIN entries b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM sets
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.y)::BIGINT AS component_id
FROM sets s JOIN reach r ON s.doc_id = r.x GROUP BY s.doc_id, s.s
"""

OP4 = CLASSES.format(percent=75)
OP11 = f"SELECT *, doc_id = component_id AS kept FROM ({CLASSES.format(percent=85)})"

RECORDS = """
  SELECT page_id, (page_id // 1000)::BIGINT AS archive, strlen(r)::BIGINT AS len, sha256(r) AS hash FROM (
    SELECT page_id, 'WARC/1.1' || crlf || 'WARC-Type: resource' || crlf || 'WARC-Record-ID: <urn:page:' || page_id || '>' || crlf
      || 'WARC-Target-URI: ' || coalesce(url, '') || crlf || 'Content-Type: text/html' || crlf
      || 'Content-Length: ' || strlen(coalesce(html, '')) || crlf || crlf || coalesce(html, '') || crlf || crlf AS r
    FROM (SELECT *, chr(13) || chr(10) AS crlf FROM {pages}))
"""

OP10 = f"""
WITH damaged AS (
  SELECT page_id, url, CASE WHEN page_id % 97 = 13
           THEN substr(html, 1, length(html) // 2) || '~' || substr(html, length(html) // 2 + 2) ELSE html END AS html
  FROM pages WHERE NOT coalesce(page_id % 5003 = 4007, false)
), ours AS (
  SELECT *, (sum(len) OVER (PARTITION BY archive ORDER BY page_id) - len)::BIGINT AS at FROM ({RECORDS.format(pages="pages")})
), theirs AS (
  SELECT *, (sum(len) OVER (PARTITION BY archive ORDER BY page_id) - len)::BIGINT AS at FROM ({RECORDS.format(pages="damaged")})
)
SELECT coalesce(a.archive, b.archive) AS archive, coalesce(a.page_id, b.page_id) AS record_id,
       CASE WHEN b.hash IS NULL THEN 'lost' WHEN a.hash IS NULL THEN 'added' WHEN a.hash <> b.hash THEN 'changed' ELSE 'moved' END AS status,
       a.at AS our_offset, b.at AS their_offset, a.len AS our_length, b.len AS their_length, a.hash AS our_hash, b.hash AS their_hash
FROM ours a FULL JOIN theirs b ON a.page_id = b.page_id
WHERE a.hash IS DISTINCT FROM b.hash OR a.at IS DISTINCT FROM b.at
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_jaccard_join": OP4, "op7_line_dedup": OP7, "op10_warc_audit": OP10, "op11_minhash": OP11}
