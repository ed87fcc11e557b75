"""SQL of ``file_queries``: what scans must find, written from the tables the files were made of."""

from __future__ import annotations

from labelops.constants import OTHER
from labelops.plans.flow_oracle import BY_RAW, FRUIT, PIXELS, UNIQUE
from labelops.plans.oracle import ALIGN, ITEMS, SPLIT, _basic, add

FILES = """files AS (SELECT doc_id, coalesce(lang, 'none') AS class, lpad(doc_id::VARCHAR, 8, '0') || CASE WHEN source = 'src7' THEN '.txt' WHEN doc_id % 3 = 0 THEN '.PNG' ELSE '.jpg' END AS file_name,
  strlen(text)::BIGINT AS length, sha256(text) AS content_hash, doc_id % 20 = 1 AS deeper FROM documents WHERE doc_id % 50 <> 0)"""
add("scan_labelled", f"""WITH {FILES} SELECT class, file_name, length, CASE WHEN length <= 4000 THEN content_hash END AS content_hash,
  CASE WHEN length > 4000 THEN 'file_too_large' END AS reason FROM files WHERE NOT deeper AND file_name NOT LIKE '%.txt'""")
add("scan_unsupported", f"""WITH {FILES} SELECT class, CASE WHEN file_name LIKE '%.txt' THEN 'unsupported_extension' END AS reason, count(*) AS files, sum(length)::BIGINT AS bytes
FROM files WHERE NOT deeper GROUP BY ALL""")
add("scan_splits", f"""WITH {FILES}, s AS (SELECT *, CASE WHEN doc_id % 10 < 6 THEN 'train' WHEN doc_id % 10 < 8 THEN 'val' ELSE 'test' END AS split FROM files
  WHERE doc_id % 10 < 9 AND file_name NOT LIKE '%.txt') SELECT split, class, count(*) AS files FROM s GROUP BY GROUPING SETS ((split, class), (split))""")
add("scan_uploads", f"WITH {FILES} SELECT class AS raw_label, file_name, deeper FROM files WHERE file_name NOT LIKE '%.txt'")
add("scan_images", f"""WITH {PIXELS} SELECT vec_id::VARCHAR AS name, CASE WHEN vec_id % 7 = 3 THEN -1 ELSE 8 END AS width, CASE WHEN vec_id % 7 = 3 THEN 'corrupted_image' END AS reason,
  CASE WHEN vec_id % 7 <> 3 THEN string_agg(repeat(printf('%02X', v), 3), '' ORDER BY i, j) END AS rgb FROM px GROUP BY vec_id""")
add("published_splits", f"WITH {SPLIT} SELECT split, class, file_name, width::INT AS width, 2 AS version FROM splits")

LISTED = """old AS (SELECT concat_ws('/', lang, doc_id::VARCHAR) AS path, coalesce(lang, 'none') AS class, strlen(text)::BIGINT AS length, doc_id FROM documents),
new AS (SELECT CASE WHEN doc_id % 83 = 11 THEN path || 'b' ELSE path END AS path, class, length + CASE WHEN doc_id % 89 = 7 THEN 1 ELSE 0 END AS length, doc_id FROM old WHERE doc_id % 97 <> 5)"""
add("changed_files", f"""WITH {LISTED} SELECT coalesce(o.path, n.path) AS path, coalesce(o.class, n.class) AS class,
  CASE WHEN o.path IS NULL THEN 'added' WHEN n.path IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM old o FULL JOIN new n ON o.path = n.path WHERE o.path IS NULL OR n.path IS NULL OR o.length <> n.length""")
NODES = "SELECT {n} AS level, {range} AS range, path, length FROM {side}"
LEVELS = [(0, "''"), (1, "class"), (2, "class || '/' || substr(sha256(path), 1, 2)")]
TREE = "{side}_tree AS (SELECT level, range, count(*) AS files, sum(length)::BIGINT AS bytes, list((path, length) ORDER BY path) AS lines FROM ({rows}) GROUP BY ALL)"
BOTH = ", ".join(TREE.format(side=t, rows=" UNION ALL ".join(NODES.format(n=n, range=r, side=t) for n, r in LEVELS)) for t in ("old", "new"))
add("changed_ranges", f"""WITH {LISTED}, {BOTH} SELECT coalesce(o.level, n.level)::INT AS level, coalesce(o.range, n.range) AS range, coalesce(o.files, 0)::BIGINT AS files_before, coalesce(n.files, 0)::BIGINT AS files_after,
  coalesce(o.bytes, 0)::BIGINT AS bytes_before, coalesce(n.bytes, 0)::BIGINT AS bytes_after FROM old_tree o FULL JOIN new_tree n ON o.level = n.level AND o.range = n.range
WHERE o.lines IS DISTINCT FROM n.lines""")

SCANNED = UNIQUE.replace("SELECT lang AS class", f"SELECT {FRUIT} AS class").replace("FROM documents", "FROM documents WHERE source IS DISTINCT FROM 'src7'", 1)
add("flow_rebuild", f"""WITH {SCANNED}, {ALIGN.format(rows='splits')}, d AS (SELECT 'main' AS dataset, * FROM c UNION ALL SELECT 'subset', * FROM c WHERE class <> '{OTHER}')
SELECT dataset, count(*) AS class_count, sum(train)::BIGINT AS train_rows, sum(val)::BIGINT AS val_rows, sum(test)::BIGINT AS test_rows, count(*) FILTER (train = 0 OR val = 0 OR test = 0) AS misaligned_classes,
  0::BIGINT AS forbidden_present, 0::BIGINT AS missing_required, 0::BIGINT AS leaked_keys, 0::BIGINT AS repeated_keys, true AS valid, (sum(train) + sum(val) + sum(test))::BIGINT AS published FROM d GROUP BY dataset""")
add("flow_rebuild_cleaned", f"""WITH {BY_RAW}, n AS (SELECT *, {_basic('raw_class')} || '__' || {_basic("regexp_replace(file_name, '[.][^.]*$', '')")} AS base FROM rows_ WHERE reason IS NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY class, base ORDER BY lower(raw_class), raw_class, lower(file_name), file_name, path::VARCHAR) AS rn FROM n)
SELECT path, class, raw_class, file_name AS source_file_name, base || CASE WHEN rn = 1 THEN '' ELSE '__' || lpad(rn::VARCHAR, 4, '0') END || '.jpg' AS file_name FROM k""")
