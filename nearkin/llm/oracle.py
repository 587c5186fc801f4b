"""The operators that SQL can express, as SQL over the given tables."""

from __future__ import annotations

from nearkin.llm import block_dedup, filter_audit, host_rules, jaccard_join, suffix_dedup, vector_codes

_BREAK = r"[\x20\x09-\x0D]+"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '{_BREAK}'), lambda w: w <> '')"


def block_dedup_sql(window: int = block_dedup.WINDOW) -> str:
    return f"""
WITH texts AS (SELECT doc_id, {_words("coalesce(text, '')")} AS ws FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i + {window - 1}], ' ') AS key
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {window - 2})) AS i FROM texts WHERE len(ws) >= {window})),
later AS (
  SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id, i) AS nth FROM windows)
  WHERE nth > 1),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + {window})) AS place FROM later),
removed AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id),
places AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS place FROM texts),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS t FROM places ANTI JOIN covered USING (doc_id, place)
  GROUP BY doc_id)
SELECT t.doc_id, len(ws)::BIGINT AS n_words, coalesce(r.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM texts t LEFT JOIN removed r ON r.doc_id = t.doc_id LEFT JOIN kept k ON k.doc_id = t.doc_id"""


def suffix_dedup_sql(window: int = suffix_dedup.WINDOW) -> str:
    return f"""
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, {2 * window})) AS key
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - {window - 1})) AS i FROM texts
        WHERE length(h) >= {2 * window})),
later AS (
  SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id, i) AS nth FROM windows)
  WHERE nth > 1),
marked AS (
  SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {window}, true) AS fresh FROM later),
numbered AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
spans AS (SELECT doc_id, span, min(i) AS a, max(i) + {window} AS b FROM numbered GROUP BY doc_id, span),
totals AS (SELECT doc_id, sum(b - a)::BIGINT AS n, count(*) AS spans FROM spans GROUP BY doc_id),
edges AS (
  SELECT doc_id, a AS until, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM spans
  UNION ALL
  SELECT t.doc_id, length(h) // 2, coalesce(max(b), 0) FROM texts t LEFT JOIN spans s ON s.doc_id = t.doc_id
  GROUP BY t.doc_id, h),
kept AS (
  SELECT e.doc_id, string_agg(substr(h, 2 * since + 1, 2 * (until - since)), '' ORDER BY since) AS k
  FROM edges e JOIN texts t ON t.doc_id = e.doc_id GROUP BY e.doc_id)
SELECT t.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed,
       coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM texts t JOIN kept ON kept.doc_id = t.doc_id LEFT JOIN totals ON totals.doc_id = t.doc_id"""


def jaccard_sql(words: int = jaccard_join.WORDS, percent: int = jaccard_join.PERCENT) -> str:
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE texts AS (SELECT doc_id, {_words(lowered)} AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + {words - 1}], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {words - 2}, 2))) AS i FROM texts WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM common c JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * c.n >= {percent} * (a.n + b.n - c.n)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.y FROM reached r JOIN both_ways l ON l.x = r.other)
SELECT r.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM reached r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id"""


ORACLE = {
    "op3_host_rules": host_rules.ORACLE_SQL,
    "op4_suffix_dedup": suffix_dedup_sql(),
    "op7_block_dedup": block_dedup_sql(),
    "op10_jaccard_join": jaccard_sql(),
    "op11_filter_audit": filter_audit.ORACLE_SQL,
    "op13_vector_codes": vector_codes.oracle_sql(),
}
