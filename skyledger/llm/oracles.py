"""SQL (DuckDB) for those registered queries that SQL can express."""

from __future__ import annotations

BENCHMARK_DECONTAMINATION = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bn AS (
  SELECT item_id, w, LEAST(13, len(w)) AS n FROM b WHERE len(w) > 0
), bk AS (
  SELECT item_id, w, n, UNNEST(range(1, len(w) - n + 2)) AS k FROM bn
), win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS x FROM bk
), dk AS (
  SELECT doc_id, w, n, UNNEST(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n
), hits AS (
  SELECT doc_id, k, dw.n, item_id FROM (SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS x FROM dk) dw JOIN win ON win.n = dw.n AND win.x = dw.x
), hit AS (
  SELECT doc_id, COUNT(DISTINCT p) AS n_hit FROM (SELECT doc_id, UNNEST(range(k, k + n)) AS p FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, COUNT(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items, sha256(COALESCE(ids, '')) AS items_sha256,
  COALESCE(n_hit, 0) > 0 AND 20 * COALESCE(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""

_KINDS = {
    "assign": (0, r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""),
    "access": (1, "AKIA[A-Z0-9]{16,}"),
    "hex": (2, "[0-9a-f]{24,}"),
    "opaque": (3, "[A-Za-z0-9+/_-]{20,}"),
}


def _matches(kind: str) -> str:
    number, pattern = _KINDS[kind]
    value = f"regexp_extract(ms[k], '{pattern}', 1)" if kind == "assign" else "ms[k]"
    return f"""
  SELECT doc_id, owner, repo, {number} AS kind, '{kind}' AS name, CAST(list_sum([length(g) FOR g IN gaps[:k]]) + COALESCE(list_sum([length(m) FOR m IN ms[:k - 1]]), 0) AS BIGINT) AS s, length(ms[k]) AS size, {value} AS value
  FROM (SELECT *, UNNEST(range(1, len(ms) + 1)) AS k FROM (SELECT doc_id, owner, repo, regexp_extract_all(text, '{pattern}') AS ms, string_split_regex(text, '{pattern}') AS gaps FROM d))"""


SECRET_SCANS = f"""
WITH d AS (
  SELECT doc_id, COALESCE(text, '') AS text, COALESCE(source, '') AS owner, COALESCE(source, '') || '/' || COALESCE(lang, '') AS repo FROM documents
), raw AS ({" UNION ALL ".join(map(_matches, _KINDS))}
), found AS (
  SELECT *, s + size AS e FROM raw
  WHERE CASE kind WHEN 0 THEN length(value) >= 6 WHEN 3 THEN regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[0-9]') ELSE TRUE END
), candidates AS (
  SELECT * FROM found f WHERE kind < 3 OR NOT EXISTS (SELECT 1 FROM found o WHERE o.kind < 3 AND o.doc_id = f.doc_id AND o.s < f.e AND f.s < o.e)
), owners AS (
  SELECT value, kind = 3 AS opaque, NOT (COUNT(DISTINCT owner) >= 3 OR COUNT(DISTINCT owner) >= 2 AND COUNT(DISTINCT repo) >= 4) AS live FROM candidates GROUP BY ALL
), judged AS (
  SELECT c.*, o.live, name || ':' || s || ':' || e AS span FROM candidates c JOIN owners o ON o.value = c.value AND o.opaque = (c.kind = 3) WHERE c.kind < 3 OR o.live
), sums AS (
  SELECT doc_id, COUNT(*) FILTER (WHERE kind = 0) AS n_assign, COUNT(*) FILTER (WHERE kind = 1) AS n_access, COUNT(*) FILTER (WHERE kind = 2) AS n_hex,
    string_agg(span, ',' ORDER BY s, kind) FILTER (WHERE kind < 3) AS base, string_agg(span, ',' ORDER BY s, kind) AS spans, COUNT(*) FILTER (WHERE live) AS n_live, COUNT(*) FILTER (WHERE NOT live) AS n_copied
  FROM judged GROUP BY doc_id
)
SELECT d.doc_id, COALESCE(n_assign, 0) AS n_assign, COALESCE(n_access, 0) AS n_access, COALESCE(n_hex, 0) AS n_hex, sha256(COALESCE(base, '')) AS base_sha256, COALESCE(spans, '') AS spans, COALESCE(n_live, 0) AS n_live, COALESCE(n_copied, 0) AS n_copied
FROM d LEFT JOIN sums ON sums.doc_id = d.doc_id
"""

FILL_MIDDLE = r"""
WITH d AS (
  SELECT doc_id, COALESCE(text, '') AS text, regexp_extract_all(COALESCE(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u, sha256('42:' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS x FROM documents
), h AS (
  SELECT *, len(u) AS n, CAST('0x' || x[1:8] AS BIGINT) % (len(u) + 1) AS a, CAST('0x' || x[9:16] AS BIGINT) % (len(u) + 1) AS b, CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM d
), p AS (
  SELECT doc_id, text, CAST(n AS BIGINT) AS n, array_to_string(u[:LEAST(a, b)], '') AS pre, array_to_string(u[LEAST(a, b) + 1:GREATEST(a, b)], '') AS mid, array_to_string(u[GREATEST(a, b) + 1:], '') AS suf,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""

FILTER_AUDIT = r"""
WITH d AS (
  SELECT doc_id, COALESCE(source, '') AS part, COALESCE(text, '') AS text, regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), l AS (
  SELECT doc_id, MAX(CAST(quality = 1 AS INT)) AS good, MAX(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT part, COALESCE(good, 0) AS good, COALESCE(toxic, 0) AS toxic,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' ELSE '' END
      || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN d.doc_id > MIN(d.doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
  FROM d LEFT JOIN l ON l.doc_id = d.doc_id
), x AS (
  SELECT UNNEST(['A', 'B', 'C', 'D', 'E']) AS x
), o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
  WHERE a.x <> b.x AND a.x <> c.x AND a.x <> d.x AND a.x <> e.x AND b.x <> c.x AND b.x <> d.x AND b.x <> e.x AND c.x <> d.x AND c.x <> e.x AND d.x <> e.x
), s AS (
  SELECT part, good, toxic, fails, filter_order, step, filter_order[step] AS letter, COALESCE((SELECT MIN(k) FROM UNNEST([1, 2, 3, 4, 5]) t(k) WHERE contains(fails, filter_order[k])), 6) AS hit
  FROM (SELECT part, good, toxic, fails, COUNT(*) AS copies FROM f GROUP BY ALL) g, o, (SELECT UNNEST([1, 2, 3, 4, 5]) AS step) k, UNNEST(range(copies)) r
), c AS (
  SELECT part, filter_order, step, letter, COUNT(*) FILTER (WHERE hit > step) AS kept, COUNT(*) FILTER (WHERE hit = step) AS removed, COUNT(*) FILTER (WHERE hit < step AND contains(fails, letter)) AS redundant,
    COUNT(*) FILTER (WHERE fails = letter) AS unique_fails, COUNT(*) FILTER (WHERE hit = step AND good = 1) AS good_lost, COUNT(*) FILTER (WHERE hit = step AND toxic = 1) AS toxic_lost
  FROM s GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INT) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(SUM(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM c
"""

ORACLES = {
    "op4_secret_scans": SECRET_SCANS,
    "op8_benchmark_decontamination": BENCHMARK_DECONTAMINATION,
    "op12_fill_middle": FILL_MIDDLE,
    "op13_filter_audit": FILTER_AUDIT,
}
