"""SQL of ``flow_queries``, of the fits, the near-duplicate search and batch scoring."""

from __future__ import annotations

from labelops.constants import MERGE_GROUPS, OTHER
from labelops.plans.oracle import (
    ALIGN, CLEANED, CROP, FIRST, ITEMS, LINES, MATRIX, ORACLE, PRED, PRODUCTION, QUALITY, SPLIT, SPLIT_COUNTS, STATS, TOTALS, UPLOADS, FLOW, HIST, _grown, add,
)

# --- texts of sources and sinks ----------------------------------------------------------------

NAMES = """names AS (SELECT p_brand, p_name AS n, row_number() OVER (PARTITION BY p_brand ORDER BY p_name) - 1 AS i FROM (SELECT DISTINCT p_brand, p_name FROM part))"""
add("class_name_texts", f"WITH {NAMES} SELECT p_brand, i::INT AS pos, n AS class_name FROM names")
add("manifest_texts", f"""WITH {NAMES} SELECT p_brand, 'B' AS stage, string_agg(n, ',' ORDER BY i) AS class_names, string_agg(n || '=' || i, ';' ORDER BY n) AS class_to_index,
  count(*)::INT AS num_classes, '320,320' AS image_size, 0.5::DOUBLE AS fruit_threshold FROM names GROUP BY p_brand""")
add("manifest_drift", f"""WITH {NAMES}, g AS (SELECT p_brand, count(*) AS n FROM names GROUP BY p_brand)
SELECT p_brand, n::INT AS n, CASE WHEN n % 3 > 0 THEN '320,320' END AS image_size,
  CASE WHEN n % 3 = 1 THEN 'epochs=' || n || ';notes={{"by":"' || p_brand || '","ok":true}}' ELSE '' END AS unknown FROM g""")
add("weak_class_texts", f"WITH {NAMES} SELECT p_brand, n AS requested FROM names")
add("kv_metric_lines", f"WITH {HIST} SELECT run, 'loss' AS metric, loss AS value FROM hist UNION ALL SELECT run, 'epochs', n::DOUBLE FROM hist")
add("report_metric_lines", f"WITH {HIST} SELECT run, 'test_accuracy' AS metric, val_accuracy AS value FROM hist" + "".join(
    f" UNION ALL SELECT run, '{side}_{m}', {c}::DOUBLE FROM hist"
    for side, cols in (("macro", ("loss", "val_loss", "n")), ("weighted", ("n", "val_loss", "loss"))) for m, c in zip(("precision", "recall", "f1"), cols)))
EPOCHS = HIST + """, keyed AS (SELECT *, datediff('day', DATE '2024-01-01', stage::DATE) AS pos FROM hist),
told AS (SELECT *, CASE ((pos % 3) + 3) % 3 WHEN 0 THEN 'stage1' WHEN 1 THEN 'stage2' ELSE 'extra' END AS key, ((pos % 3) + 3) % 3 AS seat FROM keyed),
epochs AS (SELECT run, key AS stage, (dense_rank() OVER (PARTITION BY run ORDER BY seat) - 1)::INT AS stage_pos,
  (row_number() OVER (PARTITION BY run, key ORDER BY pos, hour) - 1)::INT AS i, n::DOUBLE AS accuracy, val_accuracy, loss,
  CASE WHEN row_number() OVER (PARTITION BY run, key ORDER BY pos, hour) < count(*) OVER (PARTITION BY run, key) THEN val_loss END AS val_loss FROM told)"""
add("history_texts", f"""WITH {EPOCHS} SELECT run, stage, stage_pos, i, round(accuracy, 6) AS accuracy, round(val_accuracy, 6) AS val_accuracy, round(loss, 6) AS loss,
  round(val_loss, 6) AS val_loss FROM epochs""")
add("history_more_metrics", f"""WITH {HIST}, e AS (SELECT run, round(loss, 6) AS value, (row_number() OVER (PARTITION BY run ORDER BY stage, hour) - 1)::INT AS i FROM hist)
SELECT run, 'stage1' AS stage, 'top3' AS metric, i, value FROM e UNION ALL SELECT run, 'stage1', 'top3', count(*)::INT, NULL FROM e GROUP BY run""")
add("model_family", "SELECT p_partkey, p_size % 4 = 0 OR (p_size % 5 <> 4 AND p_size % 3 = 0) AS is_family FROM part")
add("listing_rank", f"""WITH {ITEMS} SELECT class, file_name, row_number() OVER (PARTITION BY class ORDER BY lower(raw_class), raw_class, lower(file_name), file_name) AS rank FROM items""")
add("csv_cells", f"""WITH {ITEMS}, r AS (SELECT class, raw_class, count(*) AS n FROM items GROUP BY ALL)
SELECT class, sum(n)::BIGINT AS raw_images, '["' || string_agg(raw_class, '","' ORDER BY lower(raw_class), raw_class) || '"]' AS source_raw_classes FROM r GROUP BY class""")
add("report_json", f"""WITH {CLEANED}, {TOTALS} SELECT '{{"crop_failed":0,"crop_success":0,"kept_original":' || sum(CASE WHEN class = 'es' THEN 0 ELSE raw_images END)::BIGINT || ',"output_class_count":' || count(*)
  || ',"raw_images":' || sum(raw_images)::BIGINT || ',"skipped_images":' || sum(skipped_images)::BIGINT || ',"valid_images":' || sum(valid_images)::BIGINT || '}}' AS value FROM s""")
add("json_lines", f"""WITH {PRODUCTION} SELECT '{{"image_path":"' || image_path || '","group":"' || grp || CASE WHEN stage_b_ran THEN '","stage_b_top1_label":"' || top1 ELSE '' END
  || '","reason":"' || reason || '"}}' AS value FROM prod""")

# --- pixels ------------------------------------------------------------------------------------

PIXELS = """px AS (SELECT vec_id, (generate_subscripts(embedding, 1) - 1) // 8 AS i, (generate_subscripts(embedding, 1) - 1) % 8 AS j,
  least(255, greatest(0, floor(unnest(embedding)::DOUBLE * 512 + 128)))::INT AS v FROM embeddings)"""
MIRROR = "CASE WHEN {0} < 0 THEN 1 WHEN {0} > 7 THEN 6 ELSE {0} END"
STEPS = ((-1, 0), (1, 0), (0, -1), (0, 1))
LAPLACE = "lap AS (SELECT p.vec_id, " + " + ".join(f"n{k}.v" for k in range(4)) + " - 4 * p.v AS l FROM px p " + " ".join(
    f"JOIN px n{k} ON n{k}.vec_id = p.vec_id AND n{k}.i = {MIRROR.format(f'(p.i + {a})')} AND n{k}.j = {MIRROR.format(f'(p.j + {b})')}" for k, (a, b) in enumerate(STEPS)) + ")"
add("image_profile", f"""WITH {PIXELS}, {LAPLACE}, sharp AS (SELECT vec_id, round(var_pop(l), 6) AS sharpness FROM lap GROUP BY vec_id),
a AS (SELECT k.range AS k, y.range // 4 AS i, sum(cos(pi() * k.range * (2 * y.range + 1) / 64)) AS c FROM range(8) k, range(32) y GROUP BY ALL),
half AS (SELECT vec_id, k, j, sum(c * v) AS x FROM px JOIN a USING (i) GROUP BY ALL),
low AS (SELECT vec_id, h.k AS k, a.k AS l, sum(a.c * h.x) AS x FROM half h JOIN a ON a.i = h.j GROUP BY ALL),
mid AS (SELECT *, median(x) OVER (PARTITION BY vec_id) AS m FROM low),
two AS (SELECT list('1'::HUGEINT << range::INT ORDER BY range) AS powers FROM range(64)),
bits AS (SELECT vec_id, sum(CASE WHEN x > m THEN list_extract(powers, (64 - 8 * k - l)::INT) ELSE 0 END)::HUGEINT AS h FROM mid, two GROUP BY vec_id),
raw AS (SELECT vec_id, sha256(from_hex(string_agg(printf('%02x', v), '' ORDER BY i, j))) AS content_hash FROM px GROUP BY vec_id)
SELECT vec_id::VARCHAR AS path, content_hash, 8 AS width, 8 AS height, 1 AS channels, sharpness,
  (CASE WHEN h >= 9223372036854775808::HUGEINT THEN h - 18446744073709551616::HUGEINT ELSE h END)::BIGINT AS phash FROM raw JOIN sharp USING (vec_id) JOIN bits USING (vec_id)""")
add("rgb_pixels", f"WITH {PIXELS} SELECT vec_id::VARCHAR AS path, 8 AS width, 8 AS height, string_agg(repeat(printf('%02X', v), 3), '' ORDER BY i, j) AS rgb FROM px GROUP BY vec_id")
add("box_contrast", f"""WITH {PIXELS}, b AS (SELECT vec_id, i, j, v, vec_id % 4 AS x1, vec_id % 3 AS y1, 2 * (vec_id % 4) + 1 AS x2, vec_id % 3 + 4 AS y2 FROM px),
inner_ AS (SELECT vec_id, median(v) AS m FROM b WHERE i >= y1 AND i < y2 AND j >= x1 AND j < x2 GROUP BY vec_id),
border AS (SELECT vec_id, v FROM px WHERE i < 2 UNION ALL SELECT vec_id, v FROM px WHERE i > 5 UNION ALL SELECT vec_id, v FROM px WHERE j < 2 UNION ALL SELECT vec_id, v FROM px WHERE j > 5),
outer_ AS (SELECT vec_id, median(v) AS m FROM border GROUP BY vec_id)
SELECT vec_id::VARCHAR AS path, round(sqrt(3 * (a.m - o.m) * (a.m - o.m)), 6) AS contrast FROM inner_ a JOIN outer_ o USING (vec_id)""")

# --- flows -------------------------------------------------------------------------------------

BY_RAW = CLEANED.replace("SELECT lang AS class", "SELECT lang || '_' || source AS class")
add("flow_clean", f"WITH {BY_RAW}, " + STATS.format(by="class", more=", class AS source_raw_classes"))
add("flow_crop", f"""WITH {LINES}, {_grown('boxes', 'grown', '', 0.16)}, d AS (SELECT 'c' || l_linenumber AS class, CASE WHEN area < 100 THEN 'blurry_image' ELSE {CROP} END AS reason FROM grown),
n AS (SELECT class, reason, count(*) AS n FROM d GROUP BY GROUPING SETS ((class, reason), (reason)))
SELECT class, sum(n)::BIGINT AS total, coalesce(sum(n) FILTER (reason = 'crop_applied'), 0)::BIGINT AS cropped,
  coalesce(sum(n) FILTER (reason <> 'crop_applied'), 0)::BIGINT AS kept_original, 0::BIGINT AS failed, string_agg(reason || '=' || n, ';' ORDER BY reason) AS reasons FROM n GROUP BY class""")
ONCE = ITEMS.replace("items AS (", "listed AS (", 1) + f", items AS (SELECT * EXCLUDE rn FROM (SELECT *, {FIRST} AS rn FROM listed) WHERE rn = 1)"
UNIQUE = SPLIT.replace(ITEMS, ONCE)
SOME = SPLIT_COUNTS.format(rows="s")
add("flow_split", f"WITH {UNIQUE} " + SPLIT_COUNTS.format(rows="splits"))
add("flow_subset", f"WITH {UNIQUE}, s AS (SELECT class, split FROM splits WHERE class <> 'de') {SOME}")
add("flow_supported", f"""WITH {UNIQUE}, s AS (SELECT class, split FROM splits WHERE class <> 'fr'), u AS (SELECT class, split FROM splits WHERE class = 'fr')
SELECT *, 'supported' AS side FROM ({SOME}) UNION ALL SELECT *, 'unsupported' FROM ({SPLIT_COUNTS.format(rows='u')})""")
add("flow_ab", f"WITH {UNIQUE} SELECT class, file_name, split FROM splits")
KINDS = (*MERGE_GROUPS, OTHER)
FRUIT = f"[{', '.join(repr(c) for c in KINDS)}][doc_id % {len(KINDS)} + 1]"
add("flow_validate", f"""WITH {UNIQUE.replace('SELECT lang AS class', f'SELECT {FRUIT} AS class')}, {ALIGN.format(rows='splits')}, d AS (SELECT 'main' AS dataset, * FROM c UNION ALL SELECT 'subset', * FROM c WHERE class <> '{OTHER}')
SELECT dataset, count(*) AS class_count, sum(train)::BIGINT AS train_rows, sum(val)::BIGINT AS val_rows, sum(test)::BIGINT AS test_rows, count(*) FILTER (train = 0 OR val = 0 OR test = 0) AS misaligned_classes,
  0::BIGINT AS forbidden_present, 0::BIGINT AS missing_required, 0::BIGINT AS leaked_keys, 0::BIGINT AS repeated_keys, true AS valid FROM d GROUP BY dataset""")
HALVES = UNIQUE.replace("SELECT lang AS class", "SELECT CASE WHEN doc_id % 2 = 0 THEN 'even' ELSE 'odd' END AS class")
add("flow_loader", f"""WITH {HALVES} SELECT split, class, file_name FROM splits WHERE file_name NOT LIKE '%.txt' AND {QUALITY} IS NULL AND sharpness >= 100""")
add("flow_labels", f"""WITH {ITEMS}, n AS (SELECT path, CASE class WHEN 'es' THEN 'other' ELSE class END AS c FROM items),
m AS (SELECT c, (row_number() OVER (ORDER BY c) - 1)::INT AS label FROM (SELECT DISTINCT c FROM n)), o AS (SELECT c, (row_number() OVER (ORDER BY c) - 1)::INT AS label FROM (SELECT DISTINCT c FROM n WHERE c <> 'other'))
SELECT path, 'multiclass' AS view, label FROM n JOIN m USING (c) UNION ALL SELECT path, 'binary', CASE WHEN c = 'other' THEN 0 ELSE 1 END FROM n UNION ALL SELECT path, 'no_other', label FROM n JOIN o USING (c)""")


def _counters(rows: str, columns) -> str:
    return " UNION ALL ".join(f"SELECT '{out}' AS counter, {c} AS value, count(*) AS n FROM {rows} GROUP BY {c}" for c, out in columns)


add("flow_uploads", f"WITH {FLOW} " + _counters("flows", (("route", "route"), ("grp", "group"), ("evaluation_status", "evaluation_status"))))
add("flow_production", ORACLE["audit_counters"])
add("flow_supported_eval", f"""WITH {UPLOADS}, u AS (SELECT normalized_label AS l, top1 AS p, count(*) AS n FROM up WHERE true_label IS NULL GROUP BY ALL)
SELECT l AS label, sum(n)::BIGINT AS count, string_agg(p || '=' || n, ';' ORDER BY n DESC, p) AS predicted_as FROM u GROUP BY l""")
add("flow_confusion", ORACLE["confusion_pairs"])
add("flow_runs", f"""WITH {EPOCHS}, t AS (SELECT run, min(val_accuracy) AS test_accuracy, min(loss) AS b, max(loss) AS c, max(val_loss) AS d FROM hist GROUP BY run),
e AS (SELECT run, max(val_accuracy) AS best_val_accuracy, min(val_loss) AS min_val_loss, count(*) AS total_epochs FROM epochs GROUP BY run)
SELECT run, round(test_accuracy, 6) AS test_accuracy, round(b, 6) AS macro_precision, round(c, 6) AS macro_recall, round(c, 6) AS macro_f1, round(b, 6) AS weighted_f1,
  round(best_val_accuracy, 6) AS best_val_accuracy, round(min_val_loss, 6) AS min_val_loss, total_epochs FROM e JOIN t USING (run)""")

# --- every branch of the outcome tables --------------------------------------------------------

ROUGH = UPLOADS + """,
rough AS (SELECT image_path, true_label, CASE WHEN image_path::BIGINT % 11 = 0 THEN 'unknown_label' ELSE grp END AS grp, CASE WHEN image_path::BIGINT % 13 <> 0 THEN score END AS score,
  CASE WHEN image_path::BIGINT % 17 <> 0 THEN p1 END AS p1, p2, top1 FROM up)"""
ROUGH_FLOW = ROUGH + """,
r AS (SELECT *, CASE WHEN score IS NULL OR (score >= 0.3 AND p1 IS NULL) THEN 'error' WHEN score < 0.3 THEN 'stage_a_other' WHEN p1 < 0.6 THEN 'low_confidence' ELSE 'stage_b_supported' END AS route FROM rough),
j AS (SELECT *, CASE WHEN route = 'error' THEN 'image_error' WHEN grp = 'unknown_label' AND route = 'low_confidence' THEN 'unknown_label_manual_review' WHEN grp = 'unknown_label' THEN 'unknown_true_label'
  WHEN route = 'low_confidence' THEN 'low_confidence_manual_review' WHEN route = 'stage_a_other' AND grp = 'out_of_scope' THEN 'stage_a_correctly_blocked_other' WHEN route = 'stage_a_other' THEN 'stage_a_blocked_real_fruit'
  WHEN grp = 'supported' AND top1 = true_label THEN 'stage_b_correct_supported_class' WHEN grp = 'supported' THEN 'stage_b_wrong_supported_class'
  WHEN grp = 'out_of_scope' THEN 'stage_a_false_pass_other_then_stage_b_accepted' ELSE 'unsupported_v1_auto_accepted_as_supported' END AS reason FROM r),
told AS (SELECT *, CASE WHEN reason = 'image_error' THEN 'error' WHEN reason = 'unknown_true_label' THEN 'unknown_label' WHEN reason LIKE '%manual_review' THEN 'manual_review'
  WHEN reason IN ('stage_a_correctly_blocked_other', 'stage_b_correct_supported_class') THEN 'correct' ELSE 'wrong' END AS evaluation_status FROM j)"""
add("flow_reasons", f'WITH {ROUGH_FLOW} SELECT image_path, grp AS "group", route, evaluation_status, reason FROM told')
add("upload_slices", f"""WITH {ROUGH_FLOW} SELECT 'gate_blocked_wrong' AS slice, image_path FROM told WHERE route = 'stage_a_other' AND evaluation_status = 'wrong'
UNION ALL SELECT 'class_wrong', image_path FROM told WHERE grp = 'supported' AND route = 'stage_b_supported' AND evaluation_status = 'wrong'
UNION ALL SELECT 'review', image_path FROM told WHERE route = 'low_confidence' UNION ALL SELECT 'errors', image_path FROM told WHERE route = 'error'""")
add("production_reasons", f"""WITH {ROUGH}, f AS (SELECT *, CASE WHEN score IS NULL THEN 'error' WHEN grp = 'unsupported_v1' THEN 'manual_review_unsupported' WHEN grp = 'unknown_label' THEN 'manual_review_unknown_label'
  WHEN score <= 0.01 THEN 'stage_a_other' WHEN score < 0.52 THEN 'manual_review_stage_a_uncertain' WHEN p1 IS NULL THEN 'error' WHEN p1 < 0.85 THEN 'manual_review_low_confidence'
  WHEN p1 - p2 < 0.15 THEN 'manual_review_ambiguous' ELSE 'stage_b_supported_auto_accept' END AS final_route FROM rough),
t AS (SELECT *, CASE WHEN final_route = 'error' THEN 'image_error_or_unreadable' WHEN grp = 'unsupported_v1' THEN 'unsupported_class_routed_to_manual_review' WHEN grp = 'unknown_label' THEN 'unknown_label_sent_to_manual_review'
  WHEN grp = 'out_of_scope' AND final_route = 'stage_a_other' THEN 'out_of_scope_blocked_by_stage_a' WHEN grp = 'out_of_scope' AND final_route LIKE 'manual%' THEN 'out_of_scope_sent_to_manual_review'
  WHEN grp = 'out_of_scope' THEN 'out_of_scope_auto_accepted_as_supported' WHEN final_route LIKE 'manual%' THEN 'supported_class_sent_to_manual_review'
  WHEN final_route = 'stage_a_other' THEN 'supported_class_blocked_as_other_by_stage_a' WHEN top1 = true_label THEN 'supported_class_auto_accepted_correctly' ELSE 'supported_class_auto_accepted_wrong_class' END AS reason FROM f)
SELECT image_path, grp AS "group", final_route, CASE WHEN final_route = 'error' THEN 'error' WHEN grp = 'unsupported_v1' OR reason = 'out_of_scope_blocked_by_stage_a' THEN 'correct_flow'
  WHEN reason = 'out_of_scope_sent_to_manual_review' THEN 'acceptable_manual_review' WHEN reason LIKE '%to_manual_review' THEN 'manual_review'
  WHEN reason = 'supported_class_auto_accepted_correctly' THEN 'correct_auto' WHEN reason = 'supported_class_auto_accepted_wrong_class' THEN 'wrong_auto' ELSE 'wrong_flow' END AS evaluation_result, reason FROM t""")

# --- fits --------------------------------------------------------------------------------------

VECTORS = SPLIT.replace(ITEMS, "items AS (SELECT label::VARCHAR AS class, vec_id::VARCHAR AS file_name, label FROM embeddings)")
add("fit_gate", f"""WITH {VECTORS} SELECT count(*) FILTER (label = 9) AS n_other, count(*) FILTER (label <> 9) AS n_fruit, true AS loss_fell, 51::BIGINT AS thresholds
FROM splits WHERE split = 'test'""")
add("fit_classes", f"WITH {VECTORS} SELECT label::INT AS class_idx, count(*) FILTER (split = 'test') AS support, true AS loss_fell FROM splits GROUP BY label")

# --- near duplicates and batch scoring ---------------------------------------------------------

ONES = ", ".join(f"sum((h >> {b}) & 1) AS b{b}" for b in range(64))
WORD = " + ".join(f"CASE WHEN 2 * b{b} > n THEN {1 << b}::UBIGINT ELSE 0::UBIGINT END" for b in range(64))
add("near_dups", f"""WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '\\s+')) AS w FROM documents),
h AS (SELECT doc_id, ('0x' || substr(md5(w), 1, 16))::UBIGINT AS h FROM w WHERE w <> ''),
b AS (SELECT doc_id, count(*) AS n, {ONES} FROM h GROUP BY doc_id),
s AS (SELECT d.doc_id, d.lang, CASE WHEN b.doc_id IS NULL THEN 0::UBIGINT ELSE {WORD} END AS h FROM documents d LEFT JOIN b USING (doc_id)),
g AS (SELECT lang, list([{{'id': doc_id, 'h': h}}] ORDER BY doc_id) AS l FROM s GROUP BY lang),
k AS (SELECT lang, unnest(list_reduce(l, lambda a, x: CASE WHEN len(list_filter(a, lambda y: bit_count(xor(y.h, x[1].h)) <= 3)) = 0 THEN list_concat(a, x) ELSE a END)) AS r FROM g)
SELECT lang AS class, r.id AS doc_id, (CASE WHEN r.h >= 9223372036854775808::UBIGINT THEN r.h::HUGEINT - 18446744073709551616::HUGEINT ELSE r.h::HUGEINT END)::BIGINT AS phash FROM k""")
add("score", """WITH x AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding)::DOUBLE AS v FROM embeddings),
g AS (SELECT vec_id, 1 / (1 + exp(-20 * avg(v))) AS score FROM x GROUP BY vec_id),
e AS (SELECT vec_id, i % 10 AS c, exp(10 * sum(v)) AS w FROM x JOIN g USING (vec_id) WHERE score >= 0.5 GROUP BY ALL),
t AS (SELECT vec_id, arg_min(c, (-w, c)) AS pred_idx, max(w) / sum(w) AS confidence FROM e GROUP BY vec_id)
SELECT vec_id, round(score, 6) AS score, pred_idx::INT AS pred_idx, round(confidence, 6) AS confidence FROM g LEFT JOIN t USING (vec_id)""")
