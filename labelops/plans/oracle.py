"""The queries once more as plain SQL over the same tables, for checking results."""

from __future__ import annotations

from labelops.plans.standins import ADJECTIVES, PART_CLASSES, PART_RULES

ORACLE: dict[str, str] = {}


def _names(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _case(table: dict[str, str], key: str, default: str = "NULL") -> str:
    return "CASE " + key + " " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in table.items()) + f" ELSE {default} END"


def _squash(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '[^a-z0-9]+', '_', 'g'), '^_|_$', '', 'g')"


def _safe(text: str) -> str:
    return _squash(f"lower({text})")


def _basic(text: str) -> str:
    return f"regexp_replace({_safe(text)}, '_c$', '')"


def _rate(n: str, d: str) -> str:
    return f"coalesce(({n})::DOUBLE / nullif({d}, 0), 0.0)"


def add(name: str, sql: str) -> None:
    ORACLE[name] = sql


# --- shared views ------------------------------------------------------------------------------

ITEMS = """items AS (
  SELECT lang AS class, lang || '_' || source AS raw_class,
         lpad(doc_id::VARCHAR, 8, '0') || CASE WHEN source = 'src7' THEN '.txt' ELSE '.JPG' END AS file_name, doc_id AS path,
         n_chars AS width, 100 * (1 + length(text) - length(replace(text, chr(10), ''))) AS height,
         (length(text) - length(replace(text, ' ', '')))::DOUBLE AS sharpness, sha256(text) AS content_hash
  FROM documents)"""

QUALITY = """CASE WHEN width < 100 OR height < 100 THEN 'image_too_small'
  WHEN width > 5000 OR height > 5000 THEN 'image_too_large'
  WHEN width::DOUBLE / height > 4 OR width::DOUBLE / height < 0.25 THEN 'invalid_aspect_ratio' END"""

CLEANED = ITEMS + f""",
gated AS (SELECT *, coalesce(CASE WHEN file_name LIKE '%.txt' THEN 'unsupported_extension' END, {QUALITY},
                             CASE WHEN sharpness < 100 THEN 'blurry_image' END) AS gate FROM items),
kept AS (SELECT path FROM (SELECT path, row_number() OVER (PARTITION BY class, content_hash ORDER BY lower(raw_class), raw_class, lower(file_name), file_name) AS rn
                           FROM gated WHERE gate IS NULL) WHERE rn = 1),
rows_ AS (SELECT g.*, coalesce(gate, CASE WHEN k.path IS NULL THEN 'duplicate_image' END) AS reason FROM gated g LEFT JOIN kept k USING (path))"""

FIRST = "row_number() OVER (PARTITION BY content_hash ORDER BY lower(class), class, lower(file_name), file_name)"


def _sizes(source: str) -> str:
    """Split sizes of (class, n): floors, largest remainders, then empty splits filled from the largest."""
    return f"""parts AS (
  SELECT class, n, s.split, s.pos, floor(n * s.r)::BIGINT AS fl, n * s.r - floor(n * s.r) AS frac, s.r
  FROM {source}, (VALUES ('train', 0, CAST(0.70 AS DOUBLE)), ('val', 1, CAST(0.15 AS DOUBLE)), ('test', 2, CAST(0.15 AS DOUBLE))) AS s(split, pos, r)),
placed AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY frac DESC, r DESC, pos) AS rk, sum(fl) OVER (PARTITION BY class) AS total FROM parts),
first_ AS (SELECT class, n, split, pos, fl + CASE WHEN rk <= n - total THEN 1 ELSE 0 END AS c FROM placed),
lifted AS (SELECT *, count(*) FILTER (c = 0) OVER (PARTITION BY class) AS empty,
                  row_number() OVER (PARTITION BY class ORDER BY c DESC, pos) AS big FROM first_),
final AS (SELECT class, n, split, CASE WHEN c = 0 THEN 1 WHEN big = 1 THEN c - empty ELSE c END AS c FROM lifted),
sizes AS (SELECT class, max(n) AS n, max(c) FILTER (split = 'train')::BIGINT AS train, max(c) FILTER (split = 'val')::BIGINT AS val,
                 max(c) FILTER (split = 'test')::BIGINT AS test FROM final GROUP BY class)"""


SPLIT = ITEMS + ",\ncounts AS (SELECT class, count(*) AS n FROM items GROUP BY class),\n" + _sizes("counts") + """,
splits AS (
  SELECT i.*, CASE WHEN rk <= s.train THEN 'train' WHEN rk <= s.train + s.val THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY class ORDER BY sha256('42:' || class || ':' || file_name), file_name) AS rk FROM items) i
  JOIN sizes s USING (class))"""

SPLIT_COUNTS = """SELECT class, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val,
  count(*) FILTER (split = 'test') AS test, count(*) AS total FROM {rows} GROUP BY GROUPING SETS ((class), ())"""

PRED = """e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
means AS (SELECT label AS c, pos, avg(x) AS m FROM e GROUP BY label, pos),
dist AS (SELECT vec_id, any_value(label) AS true_idx, c, sum((x - m) * (x - m)) AS d FROM e JOIN means USING (pos) GROUP BY vec_id, c),
weights AS (SELECT *, exp(-100 * (d - min(d) OVER (PARTITION BY vec_id))) AS w FROM dist),
probs AS (SELECT vec_id, true_idx, c, w / sum(w) OVER (PARTITION BY vec_id) AS p FROM weights),
best AS (SELECT vec_id, any_value(true_idx) AS true_idx, list(c ORDER BY p DESC, c) AS cs, list(p ORDER BY p DESC, c) AS ps FROM probs GROUP BY vec_id),
pred AS (SELECT vec_id, true_idx, cs[1] AS pred_idx, cs[2] AS second_idx, ps[1] AS p1, ps[2] AS p2 FROM best)"""

MATRIX = PRED + """,
grid AS (SELECT a.range::INT AS true_idx, b.range::INT AS pred_idx FROM range(10) a, range(10) b),
cm AS (SELECT true_idx, pred_idx, count(vec_id) AS n FROM grid LEFT JOIN pred USING (true_idx, pred_idx) GROUP BY ALL)"""


def _per_class(cm: str, out: str) -> str:
    return f"""{out}_sums AS (
  SELECT class_idx, sum(s)::BIGINT AS support, sum(p)::BIGINT AS predicted_count, sum(t)::BIGINT AS true_positives FROM (
    SELECT true_idx AS class_idx, n AS s, 0 AS p, CASE WHEN true_idx = pred_idx THEN n ELSE 0 END AS t FROM {cm}
    UNION ALL SELECT pred_idx, 0, n, 0 FROM {cm}) GROUP BY class_idx),
{out}_pr AS (SELECT *, {_rate('true_positives', 'predicted_count')} AS precision, {_rate('true_positives', 'support')} AS recall FROM {out}_sums),
{out} AS (SELECT *, coalesce(2.0 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1, 'class_' || class_idx AS class_name FROM {out}_pr)"""


METRICS = MATRIX + ",\n" + _per_class("cm", "m")

SUMMARY = f"""SELECT sum(support)::BIGINT AS samples, round({_rate('sum(true_positives)', 'sum(support)')}, 6) AS accuracy,
  round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1,
  round({_rate('sum(precision * support)', 'sum(support)')}, 6) AS weighted_precision,
  round({_rate('sum(recall * support)', 'sum(support)')}, 6) AS weighted_recall,
  round({_rate('sum(f1 * support)', 'sum(support)')}, 6) AS weighted_f1 FROM m"""

UPLOADS = PRED + """,
up AS (SELECT lpad(vec_id::VARCHAR, 8, '0') AS image_path, 'class_' || true_idx AS normalized_label,
              CASE WHEN true_idx <= 6 THEN 'class_' || true_idx END AS true_label,
              CASE WHEN true_idx <= 6 THEN 'supported' WHEN true_idx <= 8 THEN 'unsupported_v1' ELSE 'out_of_scope' END AS grp,
              ((vec_id * 37) % 100) / 100.0::DOUBLE AS score, 'class_' || pred_idx AS top1, p1, p2 FROM pred)"""

FLOW = UPLOADS + """,
routed AS (SELECT *, CASE WHEN score < 0.3 THEN 'stage_a_other' WHEN p1 < 0.6 THEN 'low_confidence' ELSE 'stage_b_supported' END AS route FROM up),
flow AS (SELECT image_path, normalized_label, true_label, grp, route,
    CASE WHEN route <> 'stage_a_other' THEN top1 END AS predicted_label, CASE WHEN route <> 'stage_a_other' THEN p1 ELSE 0.0 END AS confidence,
    CASE WHEN route = 'low_confidence' THEN 'low_confidence_manual_review'
         WHEN route = 'stage_a_other' AND grp = 'out_of_scope' THEN 'stage_a_correctly_blocked_other'
         WHEN route = 'stage_a_other' THEN 'stage_a_blocked_real_fruit'
         WHEN grp = 'supported' AND top1 = true_label THEN 'stage_b_correct_supported_class'
         WHEN grp = 'supported' THEN 'stage_b_wrong_supported_class'
         WHEN grp = 'out_of_scope' THEN 'stage_a_false_pass_other_then_stage_b_accepted'
         ELSE 'unsupported_v1_auto_accepted_as_supported' END AS reason FROM routed),
judged AS (SELECT *, CASE WHEN reason IN ('stage_a_correctly_blocked_other', 'stage_b_correct_supported_class') THEN true
                          WHEN route = 'low_confidence' THEN NULL ELSE false END AS correct FROM flow),
flows AS (SELECT *, CASE WHEN correct IS NULL THEN 'manual_review' WHEN correct THEN 'correct' ELSE 'wrong' END AS evaluation_status FROM judged)"""

PRODUCTION = UPLOADS + """,
banded AS (SELECT *, CASE WHEN score >= 0.52 THEN 'stage_a_fruit' WHEN score <= 0.01 THEN 'stage_a_other' ELSE 'manual_review_stage_a_uncertain' END AS stage_a_route,
                  grp <> 'unsupported_v1' AND score >= 0.52 AS stage_b_ran FROM up),
final_ AS (SELECT *, CASE WHEN grp = 'unsupported_v1' THEN 'manual_review_unsupported' WHEN stage_a_route <> 'stage_a_fruit' THEN stage_a_route
    WHEN p1 < 0.85 THEN 'manual_review_low_confidence' WHEN p1 - p2 < 0.15 THEN 'manual_review_ambiguous' ELSE 'stage_b_supported_auto_accept' END AS final_route FROM banded),
reasons AS (SELECT *, CASE
    WHEN grp = 'unsupported_v1' THEN 'unsupported_class_routed_to_manual_review'
    WHEN grp = 'out_of_scope' AND final_route = 'stage_a_other' THEN 'out_of_scope_blocked_by_stage_a'
    WHEN grp = 'out_of_scope' AND final_route LIKE 'manual%' THEN 'out_of_scope_sent_to_manual_review'
    WHEN grp = 'out_of_scope' THEN 'out_of_scope_auto_accepted_as_supported'
    WHEN final_route LIKE 'manual%' THEN 'supported_class_sent_to_manual_review'
    WHEN final_route = 'stage_a_other' THEN 'supported_class_blocked_as_other_by_stage_a'
    WHEN top1 = true_label THEN 'supported_class_auto_accepted_correctly' ELSE 'supported_class_auto_accepted_wrong_class' END AS reason FROM final_),
prod AS (SELECT *, CASE reason
    WHEN 'unsupported_class_routed_to_manual_review' THEN 'correct_flow' WHEN 'out_of_scope_blocked_by_stage_a' THEN 'correct_flow'
    WHEN 'out_of_scope_sent_to_manual_review' THEN 'acceptable_manual_review' WHEN 'out_of_scope_auto_accepted_as_supported' THEN 'wrong_flow'
    WHEN 'supported_class_sent_to_manual_review' THEN 'manual_review' WHEN 'supported_class_blocked_as_other_by_stage_a' THEN 'wrong_flow'
    WHEN 'supported_class_auto_accepted_correctly' THEN 'correct_auto' ELSE 'wrong_auto' END AS result FROM reasons)"""

GATE = """gate AS (SELECT l.doc_id, l.quality AS truth, least(d.n_chars / 3000.0::DOUBLE, 1.0) AS score FROM labels l JOIN documents d USING (doc_id))"""


def _binary(counts: str) -> str:
    """All binary metrics from a relation (threshold, tn, fp, fn, tp)."""
    return f"""pr AS (SELECT *, {_rate('tn', 'tn + fn')} AS op, {_rate('tn', 'tn + fp')} AS orc, {_rate('tp', 'tp + fp')} AS fpn, {_rate('tp', 'tp + fn')} AS fr,
  {_rate('tn + tp', 'tn + fp + fn + tp')} AS accuracy FROM {counts}),
f AS (SELECT *, coalesce(2.0 * op * orc / nullif(op + orc, 0), 0.0) AS o1, coalesce(2.0 * fpn * fr / nullif(fpn + fr, 0), 0.0) AS f1 FROM pr),
bm AS (SELECT threshold, op AS other_precision, orc AS other_recall, o1 AS other_f1, fpn AS fruit_precision, fr AS fruit_recall, f1 AS fruit_f1, accuracy,
  (o1 + f1) / 2.0 AS macro_f1, (orc + fr) / 2.0 AS balanced_accuracy, least(orc, fr) AS min_recall, fp AS other_misclassified_as_fruit,
  fn AS fruit_misclassified_as_other, tn, fp, fn, tp FROM f)"""


COUNTS = """count(*) FILTER (truth <> 1 AND score < t) AS tn, count(*) FILTER (truth <> 1 AND score >= t) AS fp,
  count(*) FILTER (truth = 1 AND score < t) AS fn, count(*) FILTER (truth = 1 AND score >= t) AS tp"""
SWEEP = GATE + f""",
grid AS (SELECT CAST(0.3 AS DOUBLE) + range * ((CAST(0.3 AS DOUBLE) + CAST(0.01 AS DOUBLE)) - CAST(0.3 AS DOUBLE)) AS t FROM range(51)),
counts AS (SELECT t AS threshold, {COUNTS} FROM grid, gate GROUP BY t),
""" + _binary("counts")
FIGURES = ("threshold", "other_precision", "other_recall", "other_f1", "fruit_precision", "fruit_recall", "fruit_f1", "accuracy", "macro_f1",
           "balanced_accuracy", "min_recall")
BM_COLS = ", ".join(f"round({c}, 6) AS {c}" for c in FIGURES) + ", other_misclassified_as_fruit, fruit_misclassified_as_other, tn, fp, fn, tp"
ONE_GATE = f"WITH {GATE}, counts AS (SELECT CAST(0.5 AS DOUBLE) AS threshold, {COUNTS} FROM gate, (SELECT CAST(0.5 AS DOUBLE) AS t)),\n" + _binary("counts")

# --- names -------------------------------------------------------------------------------------

add("tokens_of_names", f"""WITH named AS (
  SELECT 'part' AS source, p_partkey AS id, p_name || ' ' || p_brand || '_C ' AS name FROM part
  UNION ALL SELECT 'documents', doc_id, text FROM documents)
SELECT source, id, md5({_basic('name')}) AS basic, md5(CASE WHEN {_safe('name')} = '' THEN 'image' ELSE {_safe('name')} END) AS safe FROM named""")

PART_NAME = f"{_basic('p_name' + chr(32) + '|| chr(32) || p_brand ||' + chr(32) + chr(39) + '_' + chr(39) + ' || p_size')}"


def _prefix_match(known) -> str:
    """Longest known name that is the token without its number, or such a name followed by ``_``."""
    values = ", ".join(f"('{k}')" for k in known)
    return f"""tok AS (SELECT p_partkey, p_type, {PART_NAME} AS t FROM part),
known(k) AS (VALUES {values}),
hit AS (SELECT p_partkey, arg_max(k, length(k)) AS k FROM tok JOIN known
        ON regexp_replace(t, '(^|_)[0-9]+$', '') = k OR starts_with(regexp_replace(t, '(^|_)[0-9]+$', ''), k || '_') GROUP BY p_partkey),
res AS (SELECT p_partkey, p_type, t, k, CASE WHEN t IN (SELECT k FROM known) THEN t ELSE coalesce(k, t) END AS known FROM tok LEFT JOIN hit USING (p_partkey))"""


KNOWN = (*ADJECTIVES[:4], *PART_CLASSES[::2])
add("known_class", f"WITH {_prefix_match(KNOWN)} SELECT p_partkey, known FROM res")
add("merge_class", f"WITH {_prefix_match(PART_CLASSES)} SELECT p_partkey, {_case(PART_RULES, 'known', 'known')} AS merged FROM res")
add("loader_label", f"""WITH {_prefix_match((*PART_CLASSES[::2], 'hot'))}
SELECT p_partkey, CASE WHEN t IN (SELECT k FROM known) OR k IS NOT NULL THEN CASE WHEN coalesce(k, t) = 'hot' THEN 'heated' ELSE coalesce(k, t) END
  WHEN regexp_matches(t, '(^|_)[0-9]+$') THEN split_part(t, '_', 1) ELSE t END AS label, CASE WHEN p_type = 'PROMO' THEN 0 ELSE 1 END AS is_real FROM res""")
add("taxonomy_plan", f"""WITH raw AS (SELECT DISTINCT p_name AS r, {_basic('p_name')} AS t FROM part),
merged AS (SELECT r, {_case(PART_RULES, 't', 't')} AS class FROM raw)
SELECT class, count(*) AS raw_classes, string_agg(r, ',' ORDER BY lower(r), r) AS sources,
  CASE WHEN class = '' THEN 'blank_name' WHEN count(*) > 1 AND class NOT IN ('ring', 'plate') THEN 'unplanned_merge'
       WHEN class = 'old_rod' THEN 'pre_merge_name' END AS problem FROM merged GROUP BY class""")
add("output_folders", """SELECT p_name, CASE p_name WHEN 'small ring' THEN 'small_ring_nhan_nho' WHEN 'hot plate' THEN 'hot_plate_bep'
  ELSE replace(p_name, ' ', '_') || '_khong_ro' END || '_' || count(*) AS folder FROM part GROUP BY p_name""")
add("ascii_fold", f"""WITH words AS (SELECT lang, unnest(regexp_split_to_array(text, '\\s+')) AS w FROM documents)
SELECT lang, {_squash("lower(strip_accents(lower(w)))")} AS ascii_token, count(*) AS n FROM words WHERE w <> '' GROUP BY ALL""")
add("map_upload_label", f"""WITH m AS (SELECT p_partkey, replace(p_name, ' ', '_') AS t FROM part),
a AS (SELECT *, CASE t WHEN 'small_plate' THEN 'small_ring' ELSE t END AS name FROM m),
g AS (SELECT *, name IN ({_names(c for c in PART_CLASSES if c.endswith(('ring', 'rod', 'bolt')))}) AS ok FROM a)
SELECT p_partkey, t AS normalized_label, CASE WHEN ok THEN name END AS true_label,
  CASE WHEN ok THEN 'supported' WHEN name IN ('hot_plate', 'old_plate') THEN 'unsupported_v1' WHEN name = 'red_widget' THEN 'out_of_scope' ELSE 'unknown_label' END AS "group" FROM g""")
WEAK = """WITH names(c) AS (VALUES {listed}), asked AS (SELECT DISTINCT {asked} AS r FROM part),
hits AS (SELECT r, count(*) FILTER (c = r) AS exact, count(*) FILTER (starts_with(c, r || '_')) AS n, min(c) FILTER (starts_with(c, r || '_')) AS c FROM asked, names WHERE r <> '' GROUP BY r),
resolved AS (SELECT DISTINCT CASE WHEN exact > 0 THEN r ELSE c END AS class_name FROM hits WHERE exact > 0 OR n = 1)"""
add("weak_names", WEAK.format(listed="('economy_a'), ('promo'), ('small_b'), ('standard_c'), ('promo_x')", asked="lower(trim(p_type))") + " SELECT class_name FROM resolved")
add("weak_flags", WEAK.format(listed="('promo'), ('small'), ('larg_e')", asked="split_part(lower(p_type), 'e', 1)") + """
SELECT p_partkey, lower(p_type) AS class, lower(p_type) IN (SELECT class_name FROM resolved) AS is_weak FROM part""")

# --- cleaning ----------------------------------------------------------------------------------

add("quality_gate", f"""WITH {ITEMS} SELECT file_name, {QUALITY} AS reason, CASE WHEN sharpness < 100 THEN 'blurry_image' END AS blur,
  coalesce({QUALITY}, '') AS warnings, {QUALITY} AS error FROM items""")
add("clean_cascade", f"WITH {CLEANED} SELECT file_name, class, reason FROM rows_")
STATS = """r AS (SELECT {by}, reason, count(*) AS n FROM rows_ GROUP BY ALL)
SELECT {by}, sum(n)::BIGINT AS raw_images, coalesce(sum(n) FILTER (reason IS NULL), 0)::BIGINT AS valid_images,
  coalesce(sum(n) FILTER (reason IS NOT NULL), 0)::BIGINT AS skipped_images,
  coalesce(string_agg(reason || '=' || n, ';' ORDER BY reason) FILTER (reason IS NOT NULL), '') AS skip_reasons{more} FROM r GROUP BY {by}"""
add("raw_class_stats", f"WITH {CLEANED}, " + STATS.format(by="raw_class, class", more=""))
add("output_class_stats", f"WITH {CLEANED}, " + STATS.format(
    by="class", more=", (SELECT string_agg(x, ',' ORDER BY lower(x), x) FROM (SELECT DISTINCT raw_class AS x FROM items i WHERE i.class = r.class)) AS source_raw_classes"))
add("small_classes", f"""WITH {CLEANED} SELECT raw_class AS class, count(*) FILTER (reason IS NULL) AS accepted_rows,
  count(*) FILTER (reason IS NULL) = 0 AS "empty" FROM rows_ GROUP BY raw_class HAVING count(*) FILTER (reason IS NULL) < 10""")
add("unique_names", f"""WITH n AS (SELECT p_partkey AS path, p_type AS class, p_brand AS raw_class, p_name || '.' || p_size AS file_name,
    {_basic('p_brand')} || '__' || {_basic('p_name')} AS base FROM part),
k AS (SELECT *, row_number() OVER (PARTITION BY class, base ORDER BY lower(raw_class), raw_class, lower(file_name), file_name, lower(path::VARCHAR), path::VARCHAR) AS rn FROM n)
SELECT path, class, base || CASE WHEN rn = 1 THEN '' ELSE '__' || lpad(rn::VARCHAR, 4, '0') END || '.jpg' AS output_name FROM k""")
add("dedup_exact", f"WITH {ITEMS} SELECT class, file_name, content_hash FROM (SELECT *, {FIRST} AS rn FROM items) WHERE rn = 1")
add("dup_counts", f"""WITH {ITEMS}, r AS (SELECT class, {FIRST} AS rn FROM items)
SELECT class, count(*) AS input_rows, count(*) FILTER (rn = 1) AS unique_rows, count(*) FILTER (rn > 1) AS duplicates_removed FROM r GROUP BY class""")
add("copies_marked", f"WITH {ITEMS} SELECT path, {FIRST} > 1 AS is_copy FROM items")
add("dup_preview", f"""WITH {ITEMS}, c AS (SELECT class, file_name, {FIRST} AS rn FROM items),
p AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY lower(file_name), file_name) AS k FROM c WHERE rn > 1) SELECT class, file_name FROM p WHERE k <= 30""")

# --- splits ------------------------------------------------------------------------------------

add("split_sizes", f"""WITH c0 AS (SELECT lang AS class, count(*) AS n FROM documents GROUP BY lang
  UNION ALL SELECT p_type || '/' || p_brand, count(*) FROM part GROUP BY ALL),
{_sizes('c0')} SELECT class, n, CASE WHEN n >= 3 THEN train END AS train, CASE WHEN n >= 3 THEN val END AS val, CASE WHEN n >= 3 THEN test END AS test FROM sizes""")
add("stratified_split", f"WITH {SPLIT} SELECT class, file_name, split FROM splits")
add("split_counts", f"WITH {SPLIT} " + SPLIT_COUNTS.format(rows="splits"))
PAIRS = "(VALUES ('train', 'train'), ('val', 'val'), ('test', 'test'), ('train', 'val'), ('train', 'test'), ('val', 'test')) AS w(l, r)"
OVERLAP = f"""keys AS (SELECT 'name' AS chk, class || '/' || file_name AS k, split FROM splits UNION ALL SELECT 'content', content_hash, split FROM splits),
per AS (SELECT chk, k, split, count(*) AS n FROM keys GROUP BY ALL),
hits AS (SELECT a.chk, l, r, a.k FROM per a, {PAIRS} WHERE a.split = l AND ((l = r AND a.n > 1) OR (l <> r AND EXISTS (SELECT 1 FROM per b WHERE b.chk = a.chk AND b.k = a.k AND b.split = r)))),
leaks AS (SELECT c.chk AS "check", l AS left_split, r AS right_split, count(h.k) AS shared_keys, min(h.k) AS example
          FROM (VALUES ('name'), ('content')) AS c(chk) CROSS JOIN {PAIRS} LEFT JOIN hits h USING (chk, l, r) GROUP BY ALL)"""
add("split_overlap", f"WITH {SPLIT}, {OVERLAP} SELECT * FROM leaks")
ALIGN = """c AS (SELECT class, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) FILTER (split = 'test') AS test FROM {rows} GROUP BY class)"""
add("class_alignment", f"""WITH {ITEMS}, loose AS (SELECT raw_class AS class, CASE WHEN path % 17 < 12 THEN 'train' WHEN path % 17 < 15 THEN 'val' ELSE 'test' END AS split FROM items),
{ALIGN.format(rows='loose')}
SELECT *, concat_ws(',', CASE WHEN train = 0 THEN 'train' END, CASE WHEN val = 0 THEN 'val' END, CASE WHEN test = 0 THEN 'test' END) AS missing_in,
  train > 0 AND val > 0 AND test > 0 AS aligned FROM c""")
add("class_policy", """SELECT 'forbidden_present' AS rule, lang AS class FROM documents WHERE lang IN ('fr', 'yy') GROUP BY lang
UNION ALL SELECT 'missing_required', w.c FROM (VALUES ('de'), ('en'), ('xx')) AS w(c) WHERE w.c NOT IN (SELECT lang FROM documents)""")
add("class_order", f"""WITH {SPLIT}, {ALIGN.format(rows='splits')}, found AS (SELECT *, row_number() OVER (ORDER BY lower(class), class) - 1 AS seat FROM c),
listed(pos, class) AS (VALUES (0, 'de'), (1, 'en'), (2, 'es'), (3, 'it'), (4, 'fr'))
SELECT class, pos::INT AS listed_at, seat::INT AS found_at, coalesce(train, 0) AS train, coalesce(val, 0) AS val, coalesce(test, 0) AS test,
  pos IS NOT DISTINCT FROM seat AND coalesce(train, 0) > 0 AND coalesce(val, 0) > 0 AND coalesce(test, 0) > 0 AS ok FROM listed FULL JOIN found USING (class)""")
add("validation_summary", f"""WITH {SPLIT}, {OVERLAP}, {ALIGN.format(rows='splits')},
a AS (SELECT count(*) AS class_count, sum(train)::BIGINT AS train_rows, sum(val)::BIGINT AS val_rows, sum(test)::BIGINT AS test_rows,
             count(*) FILTER (train = 0 OR val = 0 OR test = 0) AS misaligned_classes, count(*) FILTER (class = 'fr') AS forbidden_present,
             3 - count(*) FILTER (class IN ('de', 'en', 'xx')) AS missing_required FROM c),
b AS (SELECT coalesce(sum(shared_keys) FILTER (left_split <> right_split), 0)::BIGINT AS leaked_keys,
             coalesce(sum(shared_keys) FILTER (left_split = right_split), 0)::BIGINT AS repeated_keys FROM leaks)
SELECT *, leaked_keys + repeated_keys + misaligned_classes + forbidden_present + missing_required = 0 AS valid FROM a, b""")
add("ab_match", f"""WITH {ITEMS}, m AS (SELECT *, width > 500 AS both_ FROM items),
u AS (SELECT class, count(*) AS matched_unique FROM (SELECT class, {FIRST} AS rn FROM m WHERE both_) WHERE rn = 1 GROUP BY class)
SELECT class, count(*) AS a_files, count(*) FILTER (both_) AS b_files, count(*) FILTER (both_) AS matched, 0::BIGINT AS missing_in_a,
  count(*) FILTER (NOT both_) AS missing_in_b, coalesce(max(matched_unique), 0) AS matched_unique,
  count(*) FILTER (both_) - coalesce(max(matched_unique), 0) AS duplicate_skipped FROM m LEFT JOIN u USING (class) GROUP BY class""")
add("ab_missing", f"""WITH {ITEMS}, r AS (SELECT class, file_name, row_number() OVER (PARTITION BY class ORDER BY file_name) AS k FROM items WHERE width <= 500)
SELECT class, file_name, 'missing_in_b' AS side FROM r WHERE k <= 30""")
add("name_sets", f"""WITH {ITEMS} SELECT DISTINCT class, file_name, CASE WHEN width > 400 AND height > 300 THEN 'both' WHEN width > 400 THEN 'left_only' ELSE 'right_only' END AS side
FROM items WHERE width > 400 OR height > 300""")
add("class_diff", f"""WITH {ITEMS}, l AS (SELECT DISTINCT raw_class || '_' || path % 50 AS class FROM items WHERE width >= 800), r AS (SELECT DISTINCT raw_class || '_' || path % 50 AS class FROM items WHERE width < 800)
SELECT class, 'left_only' AS side FROM l WHERE class NOT IN (SELECT class FROM r) UNION ALL SELECT class, 'right_only' FROM r WHERE class NOT IN (SELECT class FROM l)""")
add("reconcile", f"""WITH {SPLIT}, w AS (SELECT class, file_name, CASE WHEN width > 9000 THEN 'val' ELSE split END AS split FROM splits WHERE width > 300)
SELECT split, class, file_name, 'not_written' AS side FROM splits s ANTI JOIN w USING (split, class, file_name)
UNION ALL SELECT split, class, file_name, 'not_planned' FROM w ANTI JOIN splits USING (split, class, file_name)""")
add("subset", f"WITH {SPLIT}, s AS (SELECT class, split FROM splits WHERE class <> 'de') " + SPLIT_COUNTS.format(rows="s"))
add("supported", f"WITH {SPLIT}, s AS (SELECT class, split FROM splits WHERE class <> 'fr') " + SPLIT_COUNTS.format(rows="s"))
add("missing_names", "SELECT c AS class FROM (VALUES ('fr'), ('zz'), ('en'), ('aa')) AS w(c) WHERE c NOT IN (SELECT lang FROM documents)")
LANES = ", ".join(f"sum(('0x' || substr(h, {1 + 15 * i}, 15))::HUGEINT)::VARCHAR AS s{i}" for i in range(4))
add("snapshot", f"""WITH h AS (SELECT event_type, user_id, sha256('F|' || event_id || '|' || user_id || '|' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f')) AS h FROM events),
t AS (SELECT count(DISTINCT event_type) AS class_count, count(*) AS file_count, sum(user_id)::BIGINT AS total_bytes, {LANES} FROM h)
SELECT class_count, file_count, total_bytes, sha256(s0 || '|' || s1 || '|' || s2 || '|' || s3) AS digest FROM t""")

# --- geometry ----------------------------------------------------------------------------------

add("letterbox", """WITH b AS (SELECT p_partkey, p_size * 13 + 1 AS w, p_partkey % 900 + 1 AS h FROM part), s AS (SELECT *, least(320.0::DOUBLE / w, 320.0::DOUBLE / h) AS k FROM b),
d AS (SELECT p_partkey, greatest(1, round_even(w * k, 0)::INT) AS width, greatest(1, round_even(h * k, 0)::INT) AS height FROM s)
SELECT p_partkey, width, height, ((320 - width) // 2)::INT AS offset_x, ((320 - height) // 2)::INT AS offset_y FROM d""")
LINES = """lines AS (SELECT l_orderkey, l_linenumber, l_partkey % 200 AS x, l_suppkey % 150 AS y, (l_partkey * 7) % 300 - 20 AS cw, (l_suppkey * 3) % 200 - 10 AS ch,
  (l_partkey * l_linenumber) % 700 AS area, l_tax * 400 AS texture, l_discount * 140 AS contrast, l_tax * 0.08 AS edges FROM lineitem),
boxes AS (SELECT *, CASE WHEN l_linenumber <> 7 THEN x END AS x1, CASE WHEN l_linenumber <> 7 THEN y END AS y1,
  CASE WHEN l_linenumber <> 7 THEN x + cw END AS x2, CASE WHEN l_linenumber <> 7 THEN y + ch END AS y2 FROM lines)"""


def _grown(source: str, out: str, box: str, ratio: float) -> str:
    """Boxes grown by a share of their sides inside a 400 x 320 image, with size and area share."""
    a, b, c, d = (f"{box}{s}" for s in ("x1", "y1", "x2", "y2"))
    px = f"round_even(greatest({c} - {a}, 1) * CAST({ratio} AS DOUBLE), 0)::INT"
    py = f"round_even(greatest({d} - {b}, 1) * CAST({ratio} AS DOUBLE), 0)::INT"
    return f"""{out}_g AS (SELECT *, CASE WHEN {a} IS NOT NULL THEN greatest(0, {a} - {px}) END AS gx1, CASE WHEN {a} IS NOT NULL THEN greatest(0, {b} - {py}) END AS gy1,
  CASE WHEN {a} IS NOT NULL THEN least(400, {c} + {px}) END AS gx2, CASE WHEN {a} IS NOT NULL THEN least(320, {d} + {py}) END AS gy2 FROM {source}),
{out}_s AS (SELECT *, greatest(0, gx2 - gx1) AS bw, greatest(0, gy2 - gy1) AS bh FROM {out}_g),
{out} AS (SELECT *, (bw * bh)::DOUBLE / 128000 AS share FROM {out}_s)"""


CROP = """CASE WHEN gx1 IS NULL THEN 'no_bbox' WHEN bw <= 0 OR bh <= 0 THEN 'empty_bbox' WHEN share < 0.2 THEN 'bbox_area_too_small' WHEN share > 0.8 THEN 'bbox_area_too_large'
  WHEN bw < 100 OR bh < 100 THEN 'bbox_pixel_side_too_small' WHEN least(bw / 400.0, bh / 320.0) < 0.25 THEN 'bbox_ratio_side_too_small'
  WHEN bw::DOUBLE / bh > 2.6 OR bw::DOUBLE / bh < 1 / 2.6 THEN 'bbox_aspect_too_skewed'
  WHEN NOT (texture >= 25 OR contrast >= 12 OR edges >= 0.006) THEN 'weak_foreground_signal' ELSE 'crop_applied' END"""
add("crop_decision", f"""WITH {LINES}, {_grown('boxes', 'grown', '', 0.16)}, d AS (SELECT *, {CROP} AS reason FROM grown)
SELECT l_linenumber, reason, reason = 'crop_applied' AS applied, count(*) AS n, sum(gx1)::BIGINT AS x1, sum(gy1)::BIGINT AS y1, sum(gx2)::BIGINT AS x2, sum(gy2)::BIGINT AS y2,
  max(CASE WHEN gx1 IS NULL THEN 0.0 ELSE share END) AS area_ratio,
  max(CASE WHEN reason IN ('crop_applied', 'weak_foreground_signal') THEN texture ELSE 0.0 END) AS texture FROM d GROUP BY ALL""")
GATE_RULE = """CASE WHEN {p}gx1 IS NULL THEN 'no_bbox' WHEN {p}bw <= 0 OR {p}bh <= 0 THEN 'empty_bbox' WHEN {p}share < 0.02 THEN 'bbox_too_small'
  WHEN {p}share > 0.92 THEN 'bbox_too_large' WHEN least({p}bw / 400.0, {p}bh / 320.0) < 0.12 THEN 'bbox_side_too_small' ELSE 'ok' END"""
add("choose_crop", f"""WITH {LINES}, keyed AS (SELECT *, row_number() OVER () AS id, 0 AS sx1, 0 AS sy1, area AS sx2, area // 3 AS sy2 FROM boxes),
{_grown('keyed', 'c', '', 0.12)}, {_grown('keyed', 's', 's', 0.12)},
j AS (SELECT {GATE_RULE.format(p='c.')} AS cw, {GATE_RULE.format(p='s.')} AS sw, c.gx2 AS cx2, s.gx2 AS sx2, c.share AS ca, s.share AS sa FROM c JOIN s USING (id)),
o AS (SELECT CASE WHEN cw = 'ok' THEN 'contour' WHEN sw = 'ok' THEN 'saliency' ELSE 'none' END AS method, CASE WHEN cw = 'ok' THEN cx2 WHEN sw = 'ok' THEN sx2 END AS x2,
  CASE WHEN cw = 'ok' THEN ca WHEN sw = 'ok' THEN sa ELSE 1.0 END AS area, CASE WHEN cw = 'ok' OR sw = 'ok' THEN 'ok' ELSE 'auto_failed:contour:' || cw || ';saliency:' || sw END AS reason FROM j)
SELECT method, method <> 'none' AS applied, reason, count(*) AS n, sum(x2)::BIGINT AS x2, min(area) AS area_ratio FROM o GROUP BY ALL""")
add("bbox_union", f"""WITH {LINES} SELECT l_orderkey AS image_id, min(x) FILTER (big) AS x1, min(y) FILTER (big) AS y1, max(x + cw) FILTER (big) AS x2, max(y + ch) FILTER (big) AS y2
FROM (SELECT *, area / 128000.0::DOUBLE >= 0.0015 AS big FROM lines) GROUP BY l_orderkey""")
add("bbox_largest", f"""WITH {LINES}, r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY area DESC, l_linenumber, x, y, cw, ch) AS k FROM lines WHERE area / 128000.0::DOUBLE >= 0.002)
SELECT o.l_orderkey AS image_id, r.x AS x1, r.y AS y1, r.x + r.cw AS x2, r.y + r.ch AS y2 FROM (SELECT DISTINCT l_orderkey FROM lineitem) o LEFT JOIN r ON o.l_orderkey = r.l_orderkey AND k = 1""")
PLAIN = f"{LINES}, plain_s AS (SELECT *, x1 AS gx1, greatest(0, x2 - x1) AS bw, greatest(0, y2 - y1) AS bh FROM boxes), plain AS (SELECT *, (bw * bh)::DOUBLE / 128000 AS share FROM plain_s)"
add("crop_stats", f"""WITH {PLAIN}, d AS (SELECT 'c' || l_linenumber AS class, {CROP} AS reason FROM plain),
n AS (SELECT class, reason, count(*) AS n FROM d GROUP BY GROUPING SETS ((class, reason), (reason)))
SELECT class, sum(n)::BIGINT AS total, coalesce(sum(n) FILTER (reason = 'crop_applied'), 0)::BIGINT AS cropped,
  coalesce(sum(n) FILTER (reason <> 'crop_applied'), 0)::BIGINT AS kept_original, 0::BIGINT AS failed, string_agg(reason || '=' || n, ';' ORDER BY reason) AS reasons FROM n GROUP BY class""")
TOTALS = """s AS (SELECT class, count(*) AS raw_images, count(*) FILTER (reason IS NULL) AS valid_images, count(*) FILTER (reason IS NOT NULL) AS skipped_images FROM rows_ GROUP BY class)"""
add("dataset_report", f"""WITH {CLEANED}, {TOTALS}, c AS (SELECT class, coalesce({QUALITY}, 'crop_applied') AS reason, count(*) AS n FROM items WHERE class <> 'es' GROUP BY ALL),
k AS (SELECT class, coalesce(sum(n) FILTER (reason = 'crop_applied'), 0)::BIGINT AS a, coalesce(sum(n) FILTER (reason <> 'crop_applied'), 0)::BIGINT AS b,
      string_agg(reason || '=' || n, ';' ORDER BY reason) AS r FROM c GROUP BY class)
SELECT class, raw_images, valid_images, skipped_images, coalesce(a, 0) AS crop_success, coalesce(b, 0) AS kept_original, 0::BIGINT AS crop_failed, coalesce(r, '') AS crop_reasons FROM s LEFT JOIN k USING (class)""")
add("report_totals", f"""WITH {CLEANED}, {TOTALS} SELECT sum(raw_images)::BIGINT AS raw_images, sum(valid_images)::BIGINT AS valid_images, sum(skipped_images)::BIGINT AS skipped_images,
  0::BIGINT AS crop_success, sum(CASE WHEN class = 'es' THEN 0 ELSE raw_images END)::BIGINT AS kept_original, 0::BIGINT AS crop_failed, count(*) AS output_class_count FROM s""")

# --- labels and scores -------------------------------------------------------------------------

add("label_index", """WITH c AS (SELECT upper(p_type[1]) || lower(p_type[2:]) AS class, p_partkey FROM part),
i AS (SELECT class, (row_number() OVER (ORDER BY lower(class), class) - 1)::INT AS label FROM (SELECT DISTINCT class FROM c)) SELECT p_partkey, class, label FROM c JOIN i USING (class)""")
add("one_hot", "SELECT vec_id, repeat('0', label) || '1' || repeat('0', 9 - label) AS one_hot FROM embeddings")
add("class_weights", """WITH c AS (SELECT p_brand AS class, count(*) AS n FROM part GROUP BY p_brand)
SELECT class, n, round(least(1.2, greatest(0.8, (sum(n) OVER ())::DOUBLE / (count(*) OVER () * n))), 6) AS weight FROM c""")
add("binary_weights", f"""WITH {GATE}, c AS (SELECT truth AS class, count(*) AS n FROM gate GROUP BY truth)
SELECT class, n, round((sum(n) OVER ())::DOUBLE / (2 * n), 6) AS weight FROM c""")
add("top_k", f"""WITH {PRED}, t AS (SELECT vec_id, unnest(cs[1:3]) AS class_index, unnest(ps[1:3]) AS p, generate_subscripts(cs[1:3], 1) AS k FROM best)
SELECT vec_id, (k - 1)::INT AS place, class_index, 'class_' || class_index AS label, round(p, 6) AS confidence FROM t""")
add("margin", f"""WITH {PRED} SELECT vec_id, 'class_' || pred_idx AS top1_label, round(p1, 6) AS top1_confidence, 'class_' || second_idx AS top2_label, round(p2, 6) AS top2_confidence,
  round(p1 - p2, 6) AS margin FROM pred""")
add("with_fallback", f"WITH {PRED} SELECT vec_id, CASE WHEN p1 < 0.6 THEN 'other' ELSE 'class_' || pred_idx END AS label, p1 < 0.6 AS used_fallback FROM pred")
add("check_scores", "SELECT count(*) AS vectors, 0::BIGINT AS wrong_length FROM embeddings")
add("sanity_loss", f"""WITH {PRED}, l AS (SELECT -ln(greatest(p, 1e-7)) AS v FROM probs WHERE c = true_idx)
SELECT count(*) AS samples, round(avg(v), 6) AS loss, avg(v) <= 10 AS sane FROM l""")
add("batches", """SELECT vec_id, ((row_number() OVER (ORDER BY sha256('42:3:' || vec_id), vec_id) - 1) // 32)::BIGINT AS batch FROM embeddings""")
add("batch_plan", "SELECT count(*) AS examples, count(*) // 32 AS batches FROM embeddings")
add("centroid_scores", f"WITH {PRED} SELECT vec_id, c AS class_idx, round(p, 6) AS p FROM probs")

# --- metrics -----------------------------------------------------------------------------------

M_COLS = "class_idx, support, predicted_count, true_positives, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, class_name"
add("confusion", f"WITH {MATRIX} SELECT true_idx, pred_idx, n FROM cm")
add("class_metrics", f"WITH {METRICS} SELECT {M_COLS} FROM m")
add("summary_metrics", f"WITH {METRICS} {SUMMARY}")
add("weak_classes", f"WITH {METRICS} SELECT class_name, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM m WHERE recall < 0.4 OR f1 < 0.4")
add("weak_by_recall", f"WITH {METRICS} SELECT class_name, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM m WHERE recall < 0.4")


def _top(tie: str) -> str:
    return f"""tot AS (SELECT *, sum(n) OVER (PARTITION BY true_idx) AS s FROM cm),
top AS (SELECT true_idx, pred_idx, n, {_rate('n', 's')} AS rate, row_number() OVER (PARTITION BY true_idx ORDER BY n DESC, pred_idx {tie}) AS place FROM tot WHERE true_idx <> pred_idx AND n > 0)"""


for name, tie in (("top_confusions", "ASC"), ("top_confusions_high_index", "DESC")):
    add(name, f"WITH {MATRIX}, {_top(tie)} SELECT true_idx, pred_idx, n, round(rate, 6) AS rate, place::INT AS place FROM top WHERE place <= 3")
add("confusion_pairs", f"""WITH {MATRIX}, p AS (SELECT a.true_idx AS i, a.pred_idx AS j, a.n AS f, b.n AS b FROM cm a JOIN cm b ON a.true_idx = b.pred_idx AND a.pred_idx = b.true_idx WHERE a.true_idx < a.pred_idx)
SELECT 'class_' || i AS first, 'class_' || j AS second, f + b AS n, f AS n_forward, b AS n_backward FROM p WHERE f + b > 0 ORDER BY f + b DESC, greatest(f, b) DESC, first DESC, second DESC LIMIT 10""")
add("error_analysis", f"""WITH {METRICS}, {_top('ASC')}, l AS (SELECT true_idx AS class_idx, string_agg('class_' || pred_idx || '=' || n, ';' ORDER BY place) AS t FROM top WHERE place <= 3 GROUP BY true_idx)
SELECT {M_COLS}, coalesce(t, '') AS top_confusions, recall < 0.6 OR f1 < 0.6 AS weak FROM m LEFT JOIN l USING (class_idx)""")
add("directed_pairs", f"WITH {MATRIX}, {_top('ASC')} SELECT 'class_' || true_idx AS source, 'class_' || pred_idx AS target, n AS count, round(rate, 6) AS rate FROM top WHERE place <= 3")
add("hard_class_lines", f"""WITH {METRICS}, {_top('ASC')},
l AS (SELECT true_idx AS class_idx, string_agg(printf('class_%d (count=%d, rate=%.4f)', pred_idx, n, rate), ', ' ORDER BY place) AS t FROM top WHERE place <= 2 GROUP BY true_idx),
w AS (SELECT * FROM m LEFT JOIN l USING (class_idx) WHERE recall < 0.6 OR f1 < 0.6)
SELECT class_idx, 0 AS line_no, printf('%s | precision=%.4f | recall=%.4f | f1=%.4f | support=%d', class_name, precision, recall, f1, support) AS value FROM w
UNION ALL SELECT class_idx, 1, '  confused_with: ' || coalesce(t, 'none') FROM w""")
KV = ("test_accuracy_reference_only", "macro_precision", "macro_recall", "macro_f1", "weighted_precision", "weighted_recall", "weighted_f1")
KV_COLS = ("accuracy", *KV[1:])
add("class_kv_lines", f"WITH {METRICS}, t AS ({SUMMARY}) SELECT 0 AS line_no, 'selected_stage: stage2' AS value UNION ALL SELECT 1, 'test_loss: 0.500000'" + "".join(
    f" UNION ALL SELECT {i + 2}, printf('{k}: %.6f', {c}) FROM t" for i, (k, c) in enumerate(zip(KV, KV_COLS))))
add("label_manifest", """WITH c AS (SELECT p_type AS n, row_number() OVER (ORDER BY lower(p_type), p_type) - 1 AS i FROM (SELECT DISTINCT p_type FROM part))
SELECT 'B' AS stage, string_agg(n, ',' ORDER BY i) AS class_names, string_agg(n || '=' || i, ';' ORDER BY n) AS class_to_index,
  string_agg(i || '=' || n, ';' ORDER BY i::VARCHAR) AS index_to_class, count(*)::INT AS num_classes FROM c""")
add("binary_metrics", f"{ONE_GATE} SELECT {BM_COLS} FROM bm")
BIN = (("accuracy", "accuracy"), ("macro_f1", "macro_f1"), ("balanced_accuracy", "balanced_accuracy"), *[(c, c) for c in FIGURES[1:7]])
CNT = (("true_other_pred_other", "tn"), ("other_misclassified_as_fruit", "fp"), ("fruit_misclassified_as_other", "fn"), ("true_fruit_pred_fruit", "tp"))
add("binary_kv_lines", f"{ONE_GATE} SELECT 0 AS line_no, 'selected_fruit_threshold: 0.5000' AS value" + "".join(
    f" UNION ALL SELECT {i + 1}, printf('{k}: %.6f', {c}) FROM bm" for i, (k, c) in enumerate(BIN)) + "".join(
    f" UNION ALL SELECT {i + 10}, '{k}: ' || {c} FROM bm" for i, (k, c) in enumerate(CNT)))
add("threshold_sweep", f"WITH {SWEEP} SELECT {BM_COLS} FROM bm")
add("pick_threshold", f"""WITH {SWEEP}, c AS (SELECT *, fruit_recall >= 0.9 AND other_recall >= 0.85 AS feasible FROM bm)
SELECT {BM_COLS}, feasible FROM c ORDER BY feasible DESC, c.macro_f1 DESC, c.min_recall DESC, c.balanced_accuracy DESC, c.fruit_recall DESC, c.other_recall DESC, abs(c.threshold - 0.5), c.threshold LIMIT 1""")
add("top_thresholds", f"WITH {SWEEP}, o AS (SELECT *, row_number() OVER (ORDER BY macro_f1 DESC, balanced_accuracy DESC, threshold) AS k FROM bm) SELECT {BM_COLS} FROM o WHERE k <= 20")

# --- audits ------------------------------------------------------------------------------------

add("route_eval", f'WITH {FLOW} SELECT image_path, grp AS "group", route, evaluation_status, correct, predicted_label, round(confidence, 6) AS confidence, reason FROM flows')
add("route_two_stage", f"""WITH {UPLOADS} SELECT image_path, CASE WHEN score < 0.5 THEN 'stage_a_other' ELSE 'stage_b_fruit' END AS route, CASE WHEN score < 0.5 THEN 'other' ELSE top1 END AS predicted_label,
  round(CASE WHEN score < 0.5 THEN 1.0 - score ELSE p1 END, 6) AS confidence, CASE WHEN score >= 0.5 THEN p1 < 0.6 END AS low_confidence FROM up""")
add("flow_summary", f"""WITH {FLOW}, c AS (SELECT count(*) AS total_images, count(*) FILTER (evaluation_status = 'correct') AS correct_count, count(*) FILTER (evaluation_status = 'manual_review') AS manual_review_count,
  count(*) FILTER (evaluation_status = 'wrong') AS wrong_count, 0::BIGINT AS error_count, 0::BIGINT AS unknown_label_count FROM flows)
SELECT *, correct_count + wrong_count AS auto_resolved_total, round({_rate('correct_count', 'correct_count + wrong_count')}, 6) AS auto_resolved_accuracy,
  round({_rate('correct_count', 'total_images')}, 6) AS overall_correct_rate, round({_rate('manual_review_count', 'total_images')}, 6) AS manual_review_rate, round({_rate('wrong_count', 'total_images')}, 6) AS wrong_rate FROM c""")
add("wrong_analysis", f"""WITH {FLOW}, w AS (SELECT coalesce(true_label, normalized_label) AS t, predicted_label AS p, route = 'stage_b_supported' AND grp = 'supported' AS pair FROM flows WHERE evaluation_status = 'wrong')
SELECT 'true_label' AS view, t AS label, count(*) AS n FROM w GROUP BY t UNION ALL SELECT 'predicted_label', p, count(*) FROM w WHERE p IS NOT NULL GROUP BY p
UNION ALL SELECT 'pair', t || '->' || p, count(*) FROM w WHERE pair GROUP BY t, p""")
add("unsupported_predictions", f"""WITH {FLOW}, u AS (SELECT normalized_label AS l, predicted_label AS p, count(*) AS n FROM flows WHERE route = 'stage_b_supported' AND grp = 'unsupported_v1' GROUP BY ALL)
SELECT l AS label, sum(n)::BIGINT AS count, string_agg(p || '=' || n, ';' ORDER BY n DESC, p) AS predicted_as FROM u GROUP BY l""")
SUBSET = """grid AS (SELECT a.range::INT AS true_idx, b.range::INT AS pred_idx FROM range(10) a, range(10) b),
chosen AS (SELECT replace(true_label, 'class_', '')::INT AS true_idx, replace({p}, 'class_', '')::INT AS pred_idx FROM {rows}),
cm2 AS (SELECT g.true_idx, g.pred_idx, count(c.true_idx) AS n FROM grid g LEFT JOIN chosen c USING (true_idx, pred_idx) GROUP BY ALL), """
add("accepted_report", f"WITH {FLOW}, " + SUBSET.format(p="predicted_label", rows="(SELECT * FROM flows WHERE grp = 'supported' AND route = 'stage_b_supported')") + _per_class("cm2", "m") + SUMMARY)
add("supported_eval", f"WITH {UPLOADS}, " + SUBSET.format(p="top1", rows="(SELECT * FROM up WHERE true_label IS NOT NULL)") + _per_class("cm2", "m") + f"""
SELECT sum(support)::BIGINT AS evaluated, sum(true_positives)::BIGINT AS correct, (sum(support) - sum(true_positives))::BIGINT AS incorrect,
  round({_rate('sum(true_positives)', 'sum(support)')}, 6) AS accuracy, round(avg(f1), 6) AS macro_f1, round(avg(recall), 6) AS macro_recall FROM m""")
add("final_route", f"""WITH {PRODUCTION} SELECT image_path, grp AS "group", stage_a_route, stage_b_ran, CASE WHEN stage_b_ran THEN top1 END AS stage_b_top1_label,
  round(CASE WHEN stage_b_ran THEN p1 - p2 END, 6) AS stage_b_margin, final_route, result AS evaluation_result, reason,
  result IN ('correct_flow', 'acceptable_manual_review', 'correct_auto') AS is_correct_flow, result IN ('wrong_flow', 'wrong_auto') AS is_wrong_flow FROM prod""")
AUTO = "final_route = 'stage_b_supported_auto_accept'"
add("production_summary", f"""WITH {PRODUCTION}, c AS (SELECT count(*) AS total_images, count(*) FILTER (grp = 'supported') AS supported_count, count(*) FILTER (grp = 'unsupported_v1') AS unsupported_v1_count,
  count(*) FILTER (grp = 'out_of_scope') AS out_of_scope_count, 0::BIGINT AS unknown_label_count, count(*) FILTER ({AUTO}) AS auto_accepted_count, count(*) FILTER (final_route LIKE 'manual%') AS manual_review_count,
  count(*) FILTER (grp = 'supported' AND {AUTO}) AS supported_auto_count, count(*) FILTER (result = 'correct_auto') AS supported_auto_correct_count,
  count(*) FILTER (grp = 'supported' AND final_route LIKE 'manual%') AS supported_manual_review_count, count(*) FILTER (grp = 'supported' AND final_route = 'stage_a_other') AS stage_a_blocked_supported_wrong_count,
  count(*) FILTER (result = 'wrong_auto') AS stage_b_wrong_supported_count, count(*) FILTER (final_route = 'manual_review_unsupported') AS u,
  count(*) FILTER (grp = 'out_of_scope' AND (final_route = 'stage_a_other' OR final_route LIKE 'manual%')) AS o FROM prod)
SELECT * EXCLUDE (u, o), round({_rate('manual_review_count', 'total_images')}, 6) AS manual_review_rate, round({_rate('supported_auto_correct_count', 'supported_auto_count')}, 6) AS supported_auto_accuracy,
  round({_rate('supported_auto_count', 'supported_count')}, 6) AS supported_auto_coverage, round({_rate('u', 'unsupported_v1_count')}, 6) AS unsupported_correct_manual_review_rate,
  round({_rate('o', 'out_of_scope_count')}, 6) AS out_of_scope_block_or_review_rate FROM c""")
add("upload_class_summary", f"""WITH {PRODUCTION} SELECT normalized_label AS label, min(grp) AS "group", count(*) AS total, count(*) FILTER ({AUTO}) AS auto_accepted, count(*) FILTER (result = 'correct_auto') AS auto_correct,
  count(*) FILTER ({AUTO} AND result IN ('wrong_auto', 'wrong_flow')) AS auto_wrong, count(*) FILTER (final_route LIKE 'manual%') AS manual_review, count(*) FILTER (final_route = 'stage_a_other') AS stage_a_other,
  0::BIGINT AS error, round(count(*) FILTER (result = 'correct_auto')::DOUBLE / nullif(count(*) FILTER ({AUTO}), 0), 6) AS auto_accuracy FROM prod GROUP BY normalized_label""")
add("confused_pairs", f"""WITH {PRODUCTION}, w AS (SELECT true_label, top1 AS predicted_label, image_path, row_number() OVER (PARTITION BY true_label, top1 ORDER BY image_path) AS k FROM prod WHERE result = 'wrong_auto')
SELECT true_label, predicted_label, count(*) AS count, string_agg(image_path, ',' ORDER BY image_path) FILTER (k <= 5) AS examples FROM w GROUP BY ALL""")
add("audit_counters", f"""WITH {PRODUCTION} SELECT 'group' AS counter, grp AS value, count(*) AS n FROM prod GROUP BY grp UNION ALL SELECT 'final_route', final_route, count(*) FROM prod GROUP BY final_route
UNION ALL SELECT 'evaluation_result', result, count(*) FROM prod GROUP BY result""")
add("worst_classes", f"WITH {PRODUCTION} SELECT true_label, count(*) AS n, min(image_path) AS first_seen FROM prod WHERE result = 'wrong_auto' GROUP BY true_label")
add("error_cases", f"""WITH {PRODUCTION} SELECT image_path, grp AS "group", final_route, reason FROM prod WHERE result IN ('wrong_auto', 'wrong_flow')""")

# --- runs --------------------------------------------------------------------------------------

HIST = """hist AS (SELECT 'run_' || lpad(user_id::VARCHAR, 6, '0') AS run, strftime(ts, '%Y-%m-%d') AS stage, hour(ts)::INT AS hour, min(value) AS loss, max(value) AS val_loss, count(*) AS n,
  count(*) FILTER (event_type = 'click')::DOUBLE / count(*) AS val_accuracy FROM events GROUP BY ALL)"""
add("epoch_index", f"WITH {HIST} SELECT run, stage, hour, row_number() OVER (PARTITION BY run ORDER BY stage, hour) AS epoch FROM hist")
add("stage_boundaries", f"WITH {HIST}, s AS (SELECT run, stage, count(*) AS epochs FROM hist GROUP BY ALL) SELECT run, stage, epochs, (sum(epochs) OVER (PARTITION BY run ORDER BY stage))::BIGINT AS boundary FROM s")
RUNS = HIST + """, runs AS (SELECT run, max(val_accuracy) AS test_accuracy, min(loss) AS macro_precision, max(loss) AS macro_recall, max(val_loss) AS macro_f1, NULL::DOUBLE AS weighted_f1,
  max(val_accuracy) AS best_val_accuracy, min(val_loss) AS min_val_loss, count(*) AS total_epochs FROM hist GROUP BY run)"""
RUN_FIGURES = ("test_accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_f1")
add("run_summary", f"WITH {RUNS} SELECT run, " + ", ".join(f"round({c}, 6) AS {c}" for c in (*RUN_FIGURES, "best_val_accuracy", "min_val_loss")) + ", total_epochs FROM runs")
add("best_run", f"WITH {RUNS} SELECT run, round(macro_f1, 6) AS score FROM runs ORDER BY macro_f1 DESC, run DESC LIMIT 1")
add("best_stage", f"""WITH {HIST}, s AS (SELECT run, stage, min(val_loss) AS v FROM hist GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY v, stage DESC) AS k FROM s)
SELECT run, stage, round(v, 6) AS val_loss FROM k WHERE k = 1""")
add("compare_runs", f"WITH {RUNS}, a AS (SELECT * FROM runs WHERE run = 'run_000001'), b AS (SELECT * FROM runs WHERE run = 'run_000002') " + " UNION ALL ".join(
    f"SELECT '{c}' AS metric, round(a.{c}, 6) AS a, round(b.{c}, 6) AS b, round(a.{c} - b.{c}, 6) AS delta FROM a, b" for c in RUN_FIGURES))
add("latest_run", f"WITH {HIST} SELECT max(run) AS run FROM hist WHERE starts_with(run, 'run_00')")
