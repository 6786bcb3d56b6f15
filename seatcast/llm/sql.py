"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Every stretch of words as long as some window is looked up among the windows.
CONTAMINATION = rf"""WITH
words AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
),
items AS (
    SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS k,
           unnest([array_to_string(w[i:i + 12], ' ') FOR i IN range(1, greatest(len(w) - 12, 1) + 1)])
               AS gram
    FROM items WHERE len(w) > 0
),
grams AS (
    SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i, w
    FROM words, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k
),
hits AS (
    SELECT doc_id, i, k, item_id
    FROM (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS gram FROM grams)
    JOIN windows USING (k, gram)
),
covered AS (
    SELECT doc_id, count(DISTINCT p) AS n
    FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id
),
listed AS (
    SELECT doc_id, count(item_id) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(l.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(c.n, 0) > 0 AND 20 * coalesce(c.n, 0) >= len(w) AS contaminated
FROM words LEFT JOIN covered c USING (doc_id) LEFT JOIN listed l USING (doc_id)"""

# Documents that share a shingle are compared; a recursive walk follows the links.
NEAR_DUPLICATES = rf"""WITH RECURSIVE
words AS (
    SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id,
           unnest([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, greatest(len(w) - 4, 1) + 1)]) AS x
    FROM words WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT s.doc_id AS a, t.doc_id AS b, count(*) AS n
    FROM shingles s JOIN shingles t ON s.x = t.x AND s.doc_id <> t.doc_id GROUP BY ALL
),
links AS (
    SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * shared.n >= 85 * (p.n + q.n - shared.n)
),
reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT reached.doc_id, b FROM reached JOIN links ON a = other
),
least_id AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = doc_id AS kept
FROM least_id LEFT JOIN sizes USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {"op6_prefix_decontamination": CONTAMINATION, "op10_hyperminhash": NEAR_DUPLICATES}
