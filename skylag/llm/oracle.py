"""DuckDB SQL of the operators' queries that SQL can express."""


WARC = """
WITH rows AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
sized AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM rows),
kept AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS keep
  FROM sized)
SELECT page_id, cast(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN keep <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keep <> page_id THEN keep END AS refers_to
FROM kept
"""

DECONTAMINATE = r"""
WITH item_words AS (
  SELECT item_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT cast(item_id AS VARCHAR) AS item_id, least(10, len(words)) AS width,
         array_to_string(words[k:k + least(10, len(words)) - 1], ' ') AS gram
  FROM item_words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS t(k) WHERE len(words) > 0),
widths AS (SELECT DISTINCT width FROM windows),
doc_words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM documents),
grams AS (
  SELECT doc_id, width, k, array_to_string(words[k:k + width - 1], ' ') AS gram
  FROM doc_words, widths, unnest(range(1, len(words) - width + 2)) AS t(k)),
hits AS (SELECT g.doc_id, g.k, g.width, w.item_id FROM grams g JOIN windows w USING (width, gram)),
per_word AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM hits, unnest(range(k, k + width)) AS t(p) GROUP BY doc_id),
per_doc AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items
  FROM hits GROUP BY doc_id)
SELECT d.doc_id, cast(len(d.words) AS BIGINT) AS n_words, cast(coalesce(p.n_hit, 0) AS BIGINT) AS n_hit,
       cast(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.items, '')) AS items_sha256,
       coalesce(p.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN per_word p ON d.doc_id = p.doc_id LEFT JOIN per_doc i ON d.doc_id = i.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": WARC, "op9_decontaminate": DECONTAMINATE}
