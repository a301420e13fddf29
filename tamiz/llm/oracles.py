"""SQL that single queries must equal."""

from __future__ import annotations

SQL = {
    "op8_line_dedup": """
WITH cut AS (SELECT doc_id, source, string_split(text, chr(10)) AS parts FROM documents),
lines AS (
  SELECT doc_id, coalesce(source, '') AS site, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM cut),
wordy AS (SELECT * FROM lines WHERE regexp_matches(line, '[^ \\t-\\r]')),
spread AS (SELECT line, min({'d': doc_id, 'p': pos}) AS first FROM wordy GROUP BY line HAVING count(DISTINCT site) >= 10),
marked AS (
  SELECT l.doc_id, l.line, l.pos, regexp_matches(l.line, '[^ \\t-\\r]') AS wordy,
         s.line IS NOT NULL AND {'d': l.doc_id, 'p': l.pos} > s.first AS gone
  FROM lines l LEFT JOIN spread s ON l.line = s.line)
SELECT doc_id, CAST(count(*) FILTER (wordy) AS INTEGER) AS n_lines, CAST(count(*) FILTER (gone) AS INTEGER) AS removed_lines,
       CAST(length(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS INTEGER) AS clean_chars,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS clean_sha256
FROM marked GROUP BY doc_id""",
    "op11_contamination": r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
starts AS (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS k FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[k:k + 9], ' ') AS phrase FROM starts),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (SELECT r, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS k FROM texts, sizes),
found AS (
  SELECT p.r, p.k, p.n, v.item FROM (SELECT r, k, n, array_to_string(w[k:k + n - 1], ' ') AS phrase FROM places) p
  JOIN windows v ON p.phrase = v.phrase AND p.n = v.n),
words AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS pos FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
          FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN words USING (r) LEFT JOIN named USING (r)""",
}
