"""SQL of the registered queries, for DuckDB."""

ORACLES = {
    "q01_pointings_since_watermark": r"""SELECT event_id, user_id, event_type, value FROM events WHERE ts > TIMESTAMP '2024-01-21 00:00:00'""",
    "q02_pointings_extent": r"""SELECT CAST(COALESCE(MAX(event_id),0) AS BIGINT) AS max_id, COUNT(*) AS n_rows FROM events""",
    "q03_canonical_id": r"""SELECT doc_id, COALESCE(NULLIF(source,''), NULLIF(lang,''), CAST(doc_id AS VARCHAR)) AS object_id FROM documents""",
    "q04_element_hash": r"""SELECT o_orderkey, md5(concat_ws('|', COALESCE(CAST(o_custkey AS VARCHAR),'None'), COALESCE(o_orderstatus,'None'), COALESCE(CAST(CAST(ROUND(o_totalprice*100) AS BIGINT) AS VARCHAR),'None'))) AS element_hash FROM orders""",
    "q05_keep_filter": r"""SELECT p_partkey, p_brand FROM part WHERE COALESCE(p_retailprice / 36 > 30, FALSE) OR COALESCE(p_size <= 6, FALSE) OR COALESCE(TRY_CAST(NULLIF(regexp_extract(p_brand,'[0-9]+(?:\.[0-9]+)?',0),'') AS DOUBLE) >= 3, FALSE)""",
    "q06_ignore_anti": r"""SELECT c.c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = c.c_custkey)""",
    "q07_diff_status": r"""WITH cur AS (SELECT o_orderkey AS id, md5(concat_ws('|', COALESCE(CAST(o_custkey AS VARCHAR),'None'), COALESCE(o_orderstatus,'None'))) AS h FROM orders), base AS (SELECT id, CASE WHEN id % 7 = 0 THEN 'stale' ELSE h END AS h FROM cur WHERE id % 10 <> 0) SELECT CASE WHEN b.id IS NULL THEN 'new' WHEN b.h <> c.h THEN 'updated' ELSE 'unchanged' END AS status, COUNT(*) AS n FROM cur c LEFT JOIN base b ON b.id = c.id GROUP BY 1""",
    "q08_work_routing": r"""WITH obj AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 10 = 0 THEN 'new' WHEN c_custkey % 7 = 0 THEN 'updated' ELSE 'unchanged' END AS status FROM customer), pt AS (SELECT event_id, user_id, ts FROM events) SELECT o.status AS job, COUNT(*) AS n_pairs, COUNT(DISTINCT o.id) AS n_objects FROM obj o JOIN pt p ON p.user_id = o.id AND (o.status IN ('new','updated') OR p.ts > TIMESTAMP '2024-01-21 00:00:00') GROUP BY 1""",
    "q09_orbit_projection": r"""SELECT s_name AS "ObjID", ROUND(s_acctbal + 2461000.5 - 2400000.5, 4) AS "epochMJD_TDB", 'KEP' AS "FORMAT", CAST(s_nationkey AS DOUBLE) AS "H_r", CAST(0.5 AS DOUBLE) AS "g-r" FROM supplier""",
    "q10_calendar_mjd": r"""SELECT o_orderkey, CAST(date_diff('day', DATE '1858-11-17', o_orderdate) AS BIGINT) AS epoch_mjd FROM orders""",
    "q11_fractional_mjd": r"""WITH e AS (SELECT event_id, CAST(date_diff('day', DATE '1858-11-17', CAST(ts AS DATE)) AS DOUBLE) AS whole, CAST(day(ts) AS DOUBLE) + CAST(epoch_us(ts) % 86400000000 AS DOUBLE) / CAST(86400000000.0 AS DOUBLE) AS d FROM events) SELECT event_id, whole + (d - floor(d)) AS mjd FROM e""",
    "q12_chunk_assignment": r"""SELECT o_orderkey, CAST(ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS input_row, CAST((ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1) // 5000 AS BIGINT) AS chunk FROM orders""",
    "q13_chunk_manifest": r"""WITH r AS (SELECT UNNEST(range(0, (SELECT COUNT(*) FROM orders), 4000)) AS lo), c AS (SELECT lo // 4000 AS chunk, lo, LEAST(lo + 4000, (SELECT COUNT(*) FROM orders)) AS hi FROM r) SELECT CAST(chunk AS BIGINT) AS chunk, printf('chunk_%05d_rows_%07d_%07d', CAST(chunk AS BIGINT), CAST(lo AS BIGINT), CAST(hi - 1 AS BIGINT)) AS node_id, CAST(lo AS BIGINT) AS row_start, CAST(hi AS BIGINT) AS row_end, CAST(hi - lo AS BIGINT) AS row_count FROM c""",
    "q14_selected_chunks": r"""WITH r AS (SELECT o_orderkey, CAST((ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1) // 1000 AS BIGINT) AS chunk FROM orders) SELECT o_orderkey, chunk FROM r WHERE chunk IN (1,3,4,5,8)""",
    "q15_failed_range_rows": r"""WITH r AS (SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders), c AS (SELECT i // 1000 AS chunk, MIN(i) AS lo, MAX(i)+1 AS hi, MAX(CASE WHEN o_orderkey % 4999 = 17 THEN 1 ELSE 0 END) AS bad FROM r GROUP BY 1) SELECT CAST(c.chunk AS BIGINT) AS chunk, CAST(c.lo AS BIGINT) AS chunk_row_start, CAST(c.hi AS BIGINT) AS chunk_row_end, r.o_orderkey FROM c JOIN r ON r.i >= c.lo AND r.i < c.hi WHERE c.bad = 1""",
    "q16_debug_subchunks": r"""WITH n AS (SELECT COUNT(*) AS n FROM orders), p AS (SELECT lo, LEAST(lo + 1000, n) AS hi FROM (SELECT UNNEST(range(0, n, 1000)) AS lo, n FROM n)), d AS (SELECT lo, hi, UNNEST(range(lo, hi, 300)) AS s FROM p) SELECT printf('chunk_%05d_debug_%04d_rows_%07d_%07d', CAST(lo // 1000 AS BIGINT), CAST((s - lo) // 300 AS BIGINT), CAST(s AS BIGINT), CAST(LEAST(s + 300, hi) - 1 AS BIGINT)) AS node_id, printf('chunk_%05d_rows_%07d_%07d', CAST(lo // 1000 AS BIGINT), CAST(lo AS BIGINT), CAST(hi - 1 AS BIGINT)) AS parent, CAST(lo AS BIGINT) AS parent_start, CAST(s AS BIGINT) AS row_start, CAST(LEAST(s + 300, hi) AS BIGINT) AS row_end FROM d""",
    "q17_isolated_rows": r"""SELECT o_orderkey AS failing_id, CAST(ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS ordinal FROM orders WHERE o_orderkey % 4999 = 17""",
    "q18_leaf_anti_join": r"""WITH n AS (SELECT p_partkey AS node, CASE WHEN p_partkey = 0 THEN NULL ELSE (p_partkey - 1) // 2 END AS parent FROM part) SELECT CAST(a.node AS BIGINT) AS leaf FROM n a WHERE NOT EXISTS (SELECT 1 FROM n b WHERE b.parent = a.node)""",
    "q19_combine_union_by_name": r"""SELECT o_orderkey AS k, o_custkey AS cust, CAST(NULL AS BIGINT) AS supp FROM orders UNION ALL SELECT l_orderkey, CAST(NULL AS BIGINT), l_suppkey FROM lineitem""",
    "q20_key_counts": r"""SELECT l_orderkey, l_linenumber, COUNT(*) AS row_count FROM lineitem GROUP BY 1,2""",
    "q21_audit_missing_pairs": r"""WITH s AS (SELECT l_orderkey k, l_linenumber t, COUNT(*) n FROM lineitem GROUP BY 1,2), c AS (SELECT l_orderkey k, l_linenumber t, COUNT(*) n FROM lineitem WHERE NOT (l_suppkey % 13 = 0) GROUP BY 1,2) SELECT s.k AS object_id, s.t AS line, s.n AS source_count, COALESCE(c.n,0) AS combined_count, s.n - COALESCE(c.n,0) AS missing_count FROM s LEFT JOIN c ON s.k IS NOT DISTINCT FROM c.k AND s.t IS NOT DISTINCT FROM c.t WHERE s.n > COALESCE(c.n,0)""",
    "q22_audit_summary": r"""WITH m AS (SELECT l_orderkey k, COUNT(*) n FROM lineitem GROUP BY 1), c AS (SELECT l_orderkey k, COUNT(*) n FROM lineitem WHERE l_suppkey % 13 <> 0 GROUP BY 1) SELECT 'detections' AS output_name, CAST(SUM(m.n) AS BIGINT) AS source_rows, CAST(SUM(COALESCE(c.n,0)) AS BIGINT) AS combined_rows, COUNT(*) AS source_pairs, COUNT(c.k) AS combined_pairs, CAST(SUM(GREATEST(m.n-COALESCE(c.n,0),0)) AS BIGINT) AS missing_rows FROM m LEFT JOIN c ON m.k = c.k""",
    "q23_lookup_first": r"""WITH i AS (SELECT CASE WHEN o_custkey % 3 > 0 THEN CAST(o_custkey AS VARCHAR) END AS object_id, 0 AS rank, o_orderkey AS catalog_row FROM orders UNION ALL SELECT CAST(o_orderkey % 2000 AS VARCHAR), 1, o_orderkey FROM orders) SELECT object_id, catalog_row FROM i WHERE object_id IS NOT NULL QUALIFY ROW_NUMBER() OVER (PARTITION BY object_id ORDER BY rank, catalog_row) = 1""",
    "q24_timing_summary": r"""SELECT CAST(NULLIF(event_id % 4, 0) AS INTEGER) AS debug_level, user_id % 5 AS row_count, COUNT(*) AS total_ranges, COUNT(*) FILTER (WHERE value < 50) AS completed, COUNT(*) FILTER (WHERE NOT (value < 50)) AS failed, COUNT(*) FILTER (WHERE event_id % 2 = 0) AS resumed, ROUND(AVG(value),4) AS mean_simulator_seconds, ROUND(MEDIAN(value),4) AS median_simulator_seconds, ROUND(MAX(value),4) AS max_simulator_seconds, ROUND(SUM(value + 1),4) AS total_duration_seconds, ROUND(SUM(CAST(0.25 AS DOUBLE)),4) AS total_input_write_seconds, CAST(0 AS DOUBLE) AS wall_time_seconds FROM events GROUP BY 1, 2""",
    "q25_json_field": r"""SELECT event_id, TRY_CAST(json_extract_string(props,'$.k') AS BIGINT) AS k FROM events""",
    "q26_baseline_last_wins": r"""SELECT o_custkey AS object_id, arg_max(o_orderpriority, o_orderkey) AS element_hash FROM orders GROUP BY 1""",
    "q27_semi_select": r"""SELECT n.n_nationkey, n.n_name FROM nation n WHERE EXISTS (SELECT 1 FROM supplier s WHERE s.s_nationkey = n.n_nationkey)""",
    "q28_missing_dates_drop": r"""SELECT CAST(o_orderkey AS VARCHAR) AS "ObjID", CAST(date_diff('day', DATE '1858-11-17', CAST(o_orderdate AS DATE)) AS DOUBLE) AS "epochMJD_TDB", CAST(date_diff('day', DATE '1858-11-17', CAST(o_orderdate AS DATE)) AS DOUBLE) + CAST(o_orderkey % 8 AS DOUBLE) / 8 AS "t_p_MJD_TDB", CAST(o_custkey AS DOUBLE) AS e, 'COM' AS "FORMAT" FROM orders WHERE o_orderstatus = 'P'""",
    "q29_group_failures": r"""WITH n AS (SELECT p_partkey AS k, CASE WHEN p_partkey > 0 THEN (p_partkey - 1) // 2 END AS parent, p_partkey % 3 = 0 AS failed FROM part), c AS (SELECT parent, bool_and(NOT failed) AS passed FROM n WHERE parent IS NOT NULL GROUP BY 1) SELECT CAST(n.k AS VARCHAR) AS node_id FROM n JOIN c ON c.parent = n.k WHERE n.failed AND c.passed""",
    "q30_salvage": r"""WITH r AS (SELECT o_orderkey % 4999 = 17 AS bad, ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders), c AS (SELECT i // 1000 AS chunk, MIN(i) AS lo, MAX(i) + 1 AS hi, bool_or(bad) AS failed FROM r GROUP BY 1), d AS (SELECT c.chunk, (r.i - c.lo) // 250 AS k, MIN(r.i) AS lo, MAX(r.i) + 1 AS hi, bool_or(r.bad) AS failed FROM c JOIN r ON r.i // 1000 = c.chunk WHERE c.failed GROUP BY 1, 2) SELECT CAST(lo AS BIGINT) AS row_start, CAST(hi AS BIGINT) AS row_end, CAST(NULL AS INTEGER) AS debug_level, 'done' AS status FROM c WHERE NOT failed UNION ALL SELECT CAST(lo AS BIGINT), CAST(hi AS BIGINT), CAST(1 AS INTEGER), 'done' FROM d WHERE NOT failed""",
    "q31_time_order": r"""WITH e AS (SELECT CASE WHEN event_id % 10 > 0 THEN value END AS t, CAST(event_id AS VARCHAR) AS id FROM events) SELECT t AS "fieldMJD_TAI", id AS "ObjID", CAST(ROW_NUMBER() OVER (ORDER BY t IS NULL, t, id) - 1 AS BIGINT) AS place FROM e""",
    "q32_halves": r"""WITH n AS (SELECT COUNT(*) AS n FROM lineitem), p AS (SELECT lo // 777 AS chunk, lo, LEAST(lo + 777, n) AS hi FROM (SELECT UNNEST(range(0, n, 777)) AS lo, n FROM n)), h AS (SELECT chunk, lo AS plo, hi AS phi, lo AS a, lo + (hi - lo) // 2 AS b FROM p WHERE hi - lo > 1 UNION ALL SELECT chunk, lo, hi, lo + (hi - lo) // 2, hi FROM p WHERE hi - lo > 1) SELECT printf('chunk_%05d_isolate_%02d_rows_%07d_%07d', CAST(chunk AS BIGINT), CAST(2 AS BIGINT), CAST(a AS BIGINT), CAST(b - 1 AS BIGINT)) AS node_id, printf('chunk_%05d_rows_%07d_%07d', CAST(chunk AS BIGINT), CAST(plo AS BIGINT), CAST(phi - 1 AS BIGINT)) AS parent_node_id, CAST(a AS BIGINT) AS row_start, CAST(b AS BIGINT) AS row_end FROM h""",
    "q33_removed": r"""SELECT c_custkey AS object_id FROM customer c WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey)""",
    "q34_audit_surplus": r"""WITH m AS (SELECT l_orderkey k, COUNT(*) n FROM lineitem GROUP BY 1), c AS (SELECT l_orderkey k, COUNT(*) n FROM lineitem WHERE l_suppkey % 13 <> 0 GROUP BY 1) SELECT m.k AS object_id, m.n AS source_count, COALESCE(c.n, 0) AS combined_count, m.n - COALESCE(c.n, 0) AS missing_count FROM m LEFT JOIN c ON c.k = m.k WHERE m.n > COALESCE(c.n, 0)""",
    "q35_bucketed_diff": r"""WITH o AS (SELECT o_orderkey AS id, concat_ws('|', o_custkey, COALESCE(o_orderstatus, '')) AS h FROM orders), v AS (SELECT 1 AS v, id, CASE WHEN id % 7 = 0 THEN 'stale' ELSE h END AS h FROM o WHERE id % 10 <> 0 UNION ALL SELECT 2, id, h FROM o UNION ALL SELECT 3, id, CASE WHEN id % 100 = 7 THEN 'moved' ELSE h END FROM o WHERE id % 100 <> 11) SELECT CAST(a.v AS INTEGER) AS cycle, CASE WHEN b.id IS NULL THEN 'new' WHEN a.h <> b.h THEN 'updated' ELSE 'unchanged' END AS status, COUNT(*) AS n FROM v a LEFT JOIN v b ON b.id = a.id AND b.v = a.v - 1 GROUP BY 1, 2 UNION ALL SELECT 3, 'baseline', COUNT(*) FROM v WHERE v = 3""",
    "q36_digest_ranges": r"""WITH r AS (SELECT o_orderkey AS k, ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1 AS i, COUNT(*) OVER () AS n, o_custkey FROM orders), d AS (SELECT i, i - ROW_NUMBER() OVER (ORDER BY i) AS g FROM r WHERE i >= n - 3 OR (k % 997 = 5 OR k % 1499 < 4) AND o_custkey <> -1) SELECT CAST(MIN(i) AS BIGINT) AS row_start, CAST(MAX(i) + 1 AS BIGINT) AS row_end FROM d GROUP BY g""",
    "q37_tree_lineage": r"""WITH RECURSIVE n AS (SELECT p_partkey AS node, CASE WHEN p_partkey >= 3 THEN (p_partkey - 3) // 2 END AS parent FROM part), k AS (SELECT n.node, CASE WHEN p.node IS NOT NULL THEN n.parent END AS parent FROM n LEFT JOIN n p ON p.node = n.parent), t AS (SELECT node, node AS root, 0 AS depth, CAST(node AS VARCHAR) AS path FROM k WHERE parent IS NULL UNION ALL SELECT k.node, t.root, t.depth + 1, t.path || '/' || k.node FROM k JOIN t ON k.parent = t.node) SELECT CAST(node AS BIGINT) AS node, CAST(root AS BIGINT) AS root, CAST(depth AS INTEGER) AS depth, path FROM t""",
    "q38_streamed_diff": r"""WITH o AS (SELECT o_orderkey AS id, concat_ws('|', o_custkey, COALESCE(o_orderstatus, '')) AS h FROM orders), v AS (SELECT 1 AS v, id, CASE WHEN id % 7 = 0 THEN 'stale' ELSE h END AS h FROM o WHERE id % 10 <> 0 UNION ALL SELECT 2, id, h FROM o UNION ALL SELECT 3, id, CASE WHEN id % 100 = 7 THEN 'moved' ELSE h END FROM o WHERE id % 100 <> 11) SELECT CAST(a.v AS BIGINT) AS version, CASE WHEN b.id IS NULL THEN 'new' WHEN a.h <> b.h THEN 'updated' ELSE 'unchanged' END AS status, COUNT(*) AS n FROM v a LEFT JOIN v b ON b.id = a.id AND b.v = a.v - 1 GROUP BY 1, 2""",
    "q39_user_sessions": r"""WITH e AS (SELECT user_id, epoch_us(ts) AS t FROM events), m AS (SELECT *, CASE WHEN t - LAG(t) OVER (PARTITION BY user_id ORDER BY t) <= 14400000000 THEN 0 ELSE 1 END AS fresh FROM e), s AS (SELECT user_id, t, SUM(fresh) OVER (PARTITION BY user_id ORDER BY t) AS s FROM m) SELECT user_id, MIN(t) AS start_micros, MAX(t) + 14400000000 AS end_micros, COUNT(*) AS n_events FROM s GROUP BY user_id, s HAVING MAX(t) + 14400000000 <= (SELECT MAX(t) FROM e) // 1000 * 1000 - 21600000000""",
    "q40_combined_slices": r"""SELECT printf('%07d', o_orderkey) AS object_id, CASE WHEN o_orderkey % 5 IN (0, 4) THEN o_custkey END AS o_custkey, CASE WHEN o_orderkey % 5 IN (1, 2, 3) THEN o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 5 IN (0, 1, 4) THEN CAST(CAST(ROUND(o_totalprice * 100) AS BIGINT) AS VARCHAR) END AS cents FROM orders""",
    "q41_one_day": r"""SELECT CAST(event_id AS VARCHAR) AS "ObjID", CAST(user_id AS VARCHAR) AS user_id FROM events WHERE epoch_us(ts) / CAST(86400000000 AS DOUBLE) + 40587 >= 60320 AND epoch_us(ts) / CAST(86400000000 AS DOUBLE) + 40587 < 60321""",
    "q42_resumed_execution": r"""WITH r AS (SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders), c AS (SELECT CAST(i // 2000 AS BIGINT) AS chunk, CAST(MIN(i) AS BIGINT) AS row_start, CAST(MAX(i) + 1 AS BIGINT) AS row_end, bool_or(o_orderkey % 4999 = 17) AS bad FROM r GROUP BY 1) SELECT chunk, printf('chunk_%05d_rows_%07d_%07d', chunk, row_start, row_end - 1) AS node_id, row_start, row_end, CASE WHEN bad THEN 'failed' ELSE 'done' END AS status, chunk % 2 = 0 AS resumed, NOT bad AS output_exists FROM c""",
    "q43_catalog_scan": r"""SELECT CAST(ROW_NUMBER() OVER (ORDER BY o_orderkey) AS BIGINT) AS catalog_row, CAST(o_orderkey AS VARCHAR) AS object_id, md5(concat_ws('|', o_custkey, '', '', CASE WHEN o_orderkey % 3 > 0 THEN COALESCE(o_orderstatus, '') ELSE '' END, '', '', '', '', '', '', '')) AS element_hash FROM orders""",
    "q44_ignored_ids": r"""SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier) AND c_custkey NOT IN (SELECT n_nationkey + d FROM nation, (VALUES (300), (301)) v(d)) AND c_custkey <> 777""",
    "q45_missing_pairs": r"""SELECT 'detections' AS output_name, CAST(l_orderkey AS VARCHAR) AS object_id, 'ObjID' AS id_column, 'fieldMJD_TAI' AS timestamp_column, COUNT(*) AS source_count, COUNT(*) FILTER (WHERE l_suppkey % 13 <> 0) AS combined_count, COUNT(*) FILTER (WHERE l_suppkey % 13 = 0) AS missing_count, CASE WHEN l_orderkey % 2 = 0 THEN l_orderkey END AS catalog_row, CAST(l_linenumber AS BIGINT) AS time FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) FILTER (WHERE l_suppkey % 13 = 0) > 0""",
    "q46_failing_catalog_rows": r"""WITH r AS (SELECT o_orderkey, o_custkey, CAST(ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS i FROM orders), c AS (SELECT CAST(i // 500 AS BIGINT) AS chunk, MIN(i) AS lo, MAX(i) + 1 AS hi FROM r GROUP BY 1 HAVING bool_or(o_orderkey % 4999 = 17)) SELECT printf('chunk_%05d_rows_%07d_%07d', chunk, lo, hi - 1) AS failure_node_id, chunk AS failure_parent_chunk, lo AS failure_row_start, hi AS failure_row_end, 'failed' AS failure_status, 'bad row' AS failure_error, 'rows ' || (hi - lo) AS failure_kind, i AS failure_input_row, o_orderkey, o_custkey FROM r JOIN c ON i // 500 = chunk""",
    "q47_digest_leaves": r"""WITH r AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY c_custkey) - 1 AS BIGINT) AS i, c_custkey AS k, c_nationkey AS n FROM customer), h AS (SELECT i, sha256('{"input_row":' || i || ',"k":' || k || ',"n":' || n || '}') AS h FROM r) SELECT CAST(i // 100 AS BIGINT) AS node, sha256(string_agg(i || ':' || h, ',' ORDER BY i)) AS digest, COUNT(*) AS rows FROM h GROUP BY 1""",
}
