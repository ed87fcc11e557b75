"""One query per operator over the given tables. Every query reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelops.functions import quality, scores, tokens
from labelops.lineage import cut
from labelops.operators import (
    audit,
    boxes,
    cleaning,
    dedup,
    labels,
    learn,
    metrics,
    reports,
    runs,
    split,
    taxonomy,
    threshold,
    validate,
    variants,
)
from labelops.plans import standins as s
from labelops.sources import sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame) -> DataFrame:
    """Six decimals for every floating-point column."""
    kinds = (T.DoubleType, T.FloatType)
    return df.select(*[
        F.round(F.col(f.name).cast("double"), 6).alias(f.name) if isinstance(f.dataType, kinds) else F.col(f.name)
        for f in df.schema.fields
    ])


def map_text(col: str) -> Column:
    """MAP as ``k=v;k=v`` in key order."""
    entries = F.array_sort(F.map_entries(col))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";")


# --- names -------------------------------------------------------------------------------------


@query
def tokens_of_names(spark, sf):
    part = s.table(spark, sf, "part").select(
        F.lit("part").alias("source"), F.col("p_partkey").alias("id"), F.concat("p_name", F.lit(" "), "p_brand", F.lit("_C ")).alias("name")
    )
    docs = s.table(spark, sf, "documents").select(F.lit("documents").alias("source"), F.col("doc_id").alias("id"), F.col("text").alias("name"))
    return part.unionByName(docs).select(
        "source", "id", F.md5(tokens.basic_token(F.col("name"))).alias("basic"), F.md5(tokens.safe_token(F.col("name"), "image")).alias("safe")
    )


KNOWN = (*s.ADJECTIVES[:4], *s.PART_CLASSES[::2])


def _part_name() -> Column:
    return F.concat(F.initcap("p_name"), F.lit(" "), "p_brand", F.lit("_"), F.col("p_size").cast("string"))


@query
def known_class(spark, sf):
    return s.table(spark, sf, "part").select("p_partkey", tokens.resolve_known(_part_name(), KNOWN).alias("known"))


@query
def merge_class(spark, sf):
    return s.table(spark, sf, "part").select(
        "p_partkey", tokens.merge_class(_part_name(), s.PART_RULES, s.PART_CLASSES).alias("merged")
    )


@query
def loader_label(spark, sf):
    aliases = {**{c: c for c in s.PART_CLASSES[::2]}, "hot": "heated"}
    return s.table(spark, sf, "part").select(
        "p_partkey", tokens.clean_label(_part_name(), aliases).alias("label"),
        tokens.binary_label(F.when(F.col("p_type") == "PROMO", "Other ").otherwise(F.col("p_name")), {"other": "other"}).alias("is_real"),
    )


@query
def taxonomy_plan(spark, sf):
    raw = s.table(spark, sf, "part").select(F.col("p_name").alias("raw_class"))
    plan = taxonomy.taxonomy_plan(taxonomy.raw_mapping(raw, s.PART_RULES, s.PART_CLASSES), ("ring", "plate"), ("old_rod",))
    return plan.select("class", "raw_classes", F.array_join("sources", ",").alias("sources"), "problem")


@query
def output_folders(spark, sf):
    names = {"small_ring": ("Small Ring", "nhan nho"), "hot_plate": ("hot plate", "bep")}
    counts = s.table(spark, sf, "part").groupBy("p_name").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("p_name", tokens.folder_name(tokens.class_metadata(F.col("p_name"), names), F.col("n")).alias("folder"))


@query
def ascii_fold(spark, sf):
    counts = s.words(spark, sf).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    return taxonomy.ascii_token(counts, "word").groupBy("lang", "ascii_token").agg(F.sum("n").alias("n"))


@query
def map_upload_label(spark, sf):
    names = s.table(spark, sf, "part").select("p_partkey", F.concat(F.lit(" "), F.initcap("p_name")).alias("raw_label"))
    mapped = taxonomy.map_upload_label(
        names, [c for c in s.PART_CLASSES if c.endswith(("ring", "rod", "bolt"))], ("hot_plate", "old_plate"), ("red_widget",), {"small_plate": "small_ring"}
    )
    return mapped.select("p_partkey", "normalized_label", "true_label", "group")


@query
def weak_names(spark, sf):
    wanted = s.table(spark, sf, "part").select(F.concat(F.upper("p_type"), F.lit(" ")).alias("requested"))
    return taxonomy.resolve_unique_prefix(wanted, ["economy_a", "promo", "small_b", "standard_c", "promo_x"])


@query
def weak_flags(spark, sf):
    part = s.table(spark, sf, "part").select("p_partkey", F.lower("p_type").alias("class"))
    weak = taxonomy.resolve_unique_prefix(part.select(F.substring_index("class", "e", 1).alias("requested")), ["promo", "small", "larg_e"])
    return taxonomy.is_weak(part, weak)


# --- cleaning ----------------------------------------------------------------------------------


def _rows(spark, sf):
    return cleaning.clean(s.items(spark, sf))


@query
def quality_gate(spark, sf):
    w, h = F.col("width"), F.col("height")
    reason = quality.quality_reason(w, h)
    return s.items(spark, sf).select(
        "file_name", reason.alias("reason"), quality.blur_reason(F.col("sharpness")).alias("blur"),
        F.array_join(quality.quality_warnings(reason), ",").alias("warnings"), quality.quality_error(reason, True).alias("error"),
    )


@query
def clean_cascade(spark, sf):
    return _rows(spark, sf).select("file_name", "class", "reason")


@query
def raw_class_stats(spark, sf):
    return reports.raw_class_stats(_rows(spark, sf)).withColumn("skip_reasons", map_text("skip_reasons"))


@query
def output_class_stats(spark, sf):
    stats = reports.output_class_stats(_rows(spark, sf)).withColumn("skip_reasons", map_text("skip_reasons"))
    return stats.withColumn("source_raw_classes", F.array_join("source_raw_classes", ","))


@query
def small_classes(spark, sf):
    rows = _rows(spark, sf).select(F.col("raw_class").alias("class"), F.col("reason").isNull().alias("accepted"))
    return validate.small_classes(rows, 10)


@query
def unique_names(spark, sf):
    part = s.table(spark, sf, "part").select(
        F.col("p_type").alias("class"), F.col("p_brand").alias("raw_class"), F.col("p_partkey").alias("path"),
        F.concat("p_name", F.lit("."), F.col("p_size").cast("string")).alias("file_name"),
    )
    return reports.unique_names(part, (), ("raw_class", "file_name", "path")).select("path", "class", "output_name")


@query
def dedup_exact(spark, sf):
    return dedup.dedup_exact(s.items(spark, sf)).select("class", "file_name", "content_hash")


@query
def dup_counts(spark, sf):
    rows = s.items(spark, sf).select("class", "file_name", "content_hash")
    return dedup.duplicate_counts(rows, dedup.dedup_exact(rows))


@query
def copies_marked(spark, sf):
    rows = s.items(spark, sf).select("class", "file_name", "content_hash", "path")
    return dedup.mark_copies(rows, ["content_hash"], dedup.LISTING, ["path"]).select("path", "is_copy")


@query
def dup_preview(spark, sf):
    rows = s.items(spark, sf).select("class", "file_name", "content_hash", "path")
    copies = dedup.mark_copies(rows, ["content_hash"], dedup.LISTING, ["path"]).where("is_copy")
    return validate.preview(copies, ["class"], dedup.listing_order("file_name"), 30).select("class", "file_name")


@query
def near_dups(spark, sf):
    rows = s.simhashes(spark, sf).withColumnsRenamed({"lang": "class", "simhash": "phash"})
    return dedup.drop_near_dups(rows.withColumn("file_name", F.lpad(F.col("doc_id").cast("string"), 12, "0")), 3, order=("file_name",)).select(
        "class", "doc_id", "phash"
    )


# --- splits ------------------------------------------------------------------------------------


@query
def split_sizes(spark, sf):
    docs = s.items(spark, sf).select("class")
    part = s.table(spark, sf, "part").select(F.concat_ws("/", "p_type", "p_brand").alias("class"))
    return split.split_sizes(docs.unionByName(part), keep_small=True)


@query
def stratified_split(spark, sf):
    # the names alone are needed, so the scans stay narrow without a written listing
    return split.stratified_split(s.items(spark, sf)).select("class", "file_name", "split")


@query
def split_counts(spark, sf):
    return split.split_counts(s.split_items(spark, sf))


@query
def split_overlap(spark, sf):
    return validate.leak_report(s.split_items(spark, sf))


def _loose_split(spark, sf):
    """A split by time-like order that leaves holes in small classes."""
    rows = s.items(spark, sf).withColumn("class", F.col("raw_class"))
    m = F.pmod(F.col("path"), F.lit(17))
    return rows.withColumn("split", F.when(m < 12, "train").when(m < 15, "val").otherwise("test"))


@query
def class_alignment(spark, sf):
    return validate.class_alignment(_loose_split(spark, sf))


@query
def class_policy(spark, sf):
    return validate.class_policy(s.items(spark, sf), ("de", "en", "xx"), ("fr", "yy"))


@query
def class_order(spark, sf):
    return validate.check_class_order(s.split_items(spark, sf), ("de", "en", "es", "it", "fr"))


@query
def validation_summary(spark, sf):
    return validate.validation_summary(s.split_items(spark, sf), ("de", "en", "xx"), ("fr",))


@query
def ab_match(spark, sf):
    rows = s.items(spark, sf).select("class", "file_name", "content_hash", "width")
    return variants.match_variants(rows, rows.where("width > 500"))[1]


@query
def ab_missing(spark, sf):
    rows = s.items(spark, sf).select("class", "file_name", "content_hash", "width")
    return variants.missing_preview(variants.pair_variants(rows, rows.where("width > 500")), 30).select("class", "file_name", "side")


@query
def name_sets(spark, sf):
    rows = s.items(spark, sf)
    return validate.name_sets(rows.where("width > 400"), rows.where("height > 300"), ["class", "file_name"])


@query
def class_diff(spark, sf):
    rows = s.items(spark, sf).select(F.concat_ws("_", "raw_class", F.col("path") % 50).alias("class"), "width")
    return validate.class_diff(rows.where("width >= 800"), rows.where("width < 800"))


@query
def reconcile(spark, sf):
    plan = s.split_items(spark, sf).select("split", "class", "file_name", "width")
    written = plan.where("width > 300").withColumn("split", F.when(F.col("width") > 9000, "val").otherwise(F.col("split")))
    return validate.reconcile(plan, written)


@query
def subset(spark, sf):
    rows = s.split_items(spark, sf).withColumn("class", F.when(F.col("class") == "de", "Other ").otherwise(F.col("class")))
    return split.split_counts(taxonomy.drop_other(rows))


@query
def supported(spark, sf):
    return split.split_counts(taxonomy.supported_only(s.split_items(spark, sf), ("fr",)))


@query
def missing_names(spark, sf):
    return taxonomy.missing_names(s.items(spark, sf), ("fr", "zz", "en", "aa"))


@query
def snapshot(spark, sf):
    rows = s.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("path"), F.col("event_type").alias("class"), F.col("user_id").alias("length"), "ts"
    )
    return validate.snapshot(rows, stamp=F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


# --- geometry ----------------------------------------------------------------------------------


@query
def letterbox(spark, sf):
    w, h = (F.col("p_size") * 13 + 1).cast("int"), (F.pmod(F.col("p_partkey"), F.lit(900)) + 1).cast("int")
    return s.table(spark, sf, "part").select("p_partkey", quality.letterbox(w, h, 320, 320).alias("b")).select("p_partkey", "b.*")


def _lines(spark, sf):
    """Line items as boxes in a 400 x 320 image; line 7 has no box."""
    x, y = F.pmod("l_partkey", F.lit(200)).cast("int"), F.pmod("l_suppkey", F.lit(150)).cast("int")
    cw = (F.pmod(F.col("l_partkey") * 7, F.lit(300)) - 20).cast("int")
    ch = (F.pmod(F.col("l_suppkey") * 3, F.lit(200)) - 10).cast("int")
    rows = s.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", x.alias("x"), y.alias("y"), cw.alias("cw"), ch.alias("ch"),
        F.pmod(F.col("l_partkey") * F.col("l_linenumber"), F.lit(700)).cast("int").alias("area"),
        (F.col("l_tax") * 400).alias("texture"), (F.col("l_discount") * 140).alias("contrast"),
        (F.col("l_tax") * 0.08).alias("edge_density"), F.lit(400).alias("width"), F.lit(320).alias("height"),
    )
    x2, y2 = F.col("x") + F.col("cw"), F.col("y") + F.col("ch")
    box = F.struct(F.col("x").alias("x1"), F.col("y").alias("y1"), x2.alias("x2"), y2.alias("y2"))
    return rows.withColumn("bbox", F.when(F.col("l_linenumber") != 7, box))


@query
def crop_decision(spark, sf):
    grown = quality.expand_bbox(F.col("bbox"), F.col("width"), F.col("height"), 0.16)
    out = quality.crop_decision(_lines(spark, sf).withColumn("grown", grown), "grown")
    return out.groupBy("l_linenumber", "crop.reason", "crop.applied").agg(
        F.count(F.lit(1)).alias("n"), F.sum("crop.bbox.x1").alias("x1"), F.sum("crop.bbox.y1").alias("y1"),
        F.sum("crop.bbox.x2").alias("x2"), F.sum("crop.bbox.y2").alias("y2"),
        F.max("crop.area_ratio").alias("area_ratio"), F.max("crop.texture").alias("texture"),
    )


@query
def choose_crop(spark, sf):
    zero = F.lit(0)
    other = F.struct(zero.alias("x1"), zero.alias("y1"), F.col("area").alias("x2"), F.floor(F.col("area") / 3).cast("int").alias("y2"))
    rows = _lines(spark, sf).withColumn("saliency", other).withColumnRenamed("bbox", "contour")
    return quality.choose_crop(rows).groupBy("crop.method", "crop.applied", "crop.reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum("crop.bbox.x2").alias("x2"), F.min("crop.area_ratio").alias("area_ratio")
    )


def _components(spark, sf):
    return _lines(spark, sf).select(
        F.col("l_orderkey").alias("image_id"), F.col("width").alias("w"), F.col("height").alias("h"),
        F.col("l_linenumber").alias("label"), "x", "y", "cw", "ch", "area",
    )


@query
def bbox_union(spark, sf):
    return boxes.bbox_union(_components(spark, sf)).select("image_id", "bbox.*")


@query
def bbox_largest(spark, sf):
    return boxes.bbox_largest(_components(spark, sf)).select("image_id", "bbox.*")


@query
def crop_stats(spark, sf):
    out = quality.crop_decision(_lines(spark, sf))
    rows = out.select(F.concat(F.lit("c"), F.col("l_linenumber").cast("string")).alias("class"), "crop.reason", "crop.applied")
    return reports.crop_summary(rows).withColumn("reasons", map_text("reasons"))


def _uncropped() -> Column:
    """The class of a crop row; one class has its crops under a name the report does not list."""
    return F.when(F.col("class") == "es", "not listed").otherwise(F.col("class")).alias("class")


@query
def dataset_report(spark, sf):
    rows = _rows(spark, sf)
    crops = s.items(spark, sf).select(
        _uncropped(), F.coalesce(quality.quality_reason(F.col("width"), F.col("height")), F.lit("crop_applied")).alias("reason"),
        quality.quality_reason(F.col("width"), F.col("height")).isNull().alias("applied"),
    )
    report = reports.dataset_report(reports.output_class_stats(rows), reports.crop_stats(crops))
    return report.select("class", "raw_images", "valid_images", "skipped_images", "crop_success", "kept_original", "crop_failed", map_text("crop_reasons").alias("crop_reasons"))


@query
def report_totals(spark, sf):
    rows = _rows(spark, sf)
    crops = s.items(spark, sf).select(_uncropped(), F.lit("no_bbox").alias("reason"), F.lit(False).alias("applied"))
    return reports.report_totals(reports.dataset_report(reports.output_class_stats(rows), reports.crop_stats(crops)))


# --- labels and scores -------------------------------------------------------------------------


@query
def label_index(spark, sf):
    part = s.table(spark, sf, "part").select("p_partkey", F.initcap("p_type").alias("class"))
    return labels.label_index(part)


@query
def one_hot(spark, sf):
    vec = labels.one_hot(labels.checked_label(F.col("label"), s.K), s.K)
    return s.table(spark, sf, "embeddings").select("vec_id", F.array_join(F.transform(vec, lambda v: v.cast("int")), "").alias("one_hot"))


@query
def class_weights(spark, sf):
    return rounded(labels.class_weights(s.table(spark, sf, "part"), "p_brand", (0.8, 1.2)))


@query
def binary_weights(spark, sf):
    return rounded(labels.class_weights(s.gate(spark, sf), "truth", classes=2))


@query
def top_k(spark, sf):
    best = scores.top_k(F.col("probs"), s.NAMES, 3)
    return rounded(s.scored(spark, sf).select("vec_id", F.posexplode_outer(best).alias("place", "b")).select("vec_id", "place", "b.*"))


@query
def margin(spark, sf):
    return rounded(s.scored(spark, sf).select("vec_id", scores.top2_margin(F.col("probs"), s.NAMES).alias("m")).select("vec_id", "m.*"))


@query
def with_fallback(spark, sf):
    m = scores.top2_margin(F.col("probs"), s.NAMES)
    rows = s.scored(spark, sf).select("vec_id", m.alias("m"))
    return rows.select("vec_id", scores.with_fallback(F.col("m.top1_label"), F.col("m.top1_confidence"), 0.6, "other").alias("f")).select("vec_id", "f.*")


@query
def check_scores(spark, sf):
    return validate.score_violations(s.scored(spark, sf), s.K)


@query
def sanity_loss(spark, sf):
    return rounded(metrics.sanity_loss(s.scored(spark, sf)))


@query
def batches(spark, sf):
    return split.batches(s.table(spark, sf, "embeddings").select("vec_id"), 32, ["vec_id"], epoch=3).select("vec_id", "batch")


@query
def batch_plan(spark, sf):
    return split.batch_plan(s.table(spark, sf, "embeddings"), 32, True)


# --- metrics -----------------------------------------------------------------------------------


def _matrix(spark, sf):
    return metrics.confusion(s.predicted(spark, sf), s.K)


def _class_metrics(spark, sf):
    return metrics.with_names(metrics.class_metrics(_matrix(spark, sf)), s.NAMES, "class_idx", "class_name")


@query
def confusion(spark, sf):
    return _matrix(spark, sf)


@query
def class_metrics(spark, sf):
    return rounded(_class_metrics(spark, sf))


@query
def summary_metrics(spark, sf):
    return rounded(metrics.summary_metrics(_class_metrics(spark, sf)))


@query
def weak_classes(spark, sf):
    return rounded(metrics.weak_classes(_class_metrics(spark, sf), "recall_or_f1", 0.4)).select("class_name", "recall", "f1")


@query
def weak_by_recall(spark, sf):
    return rounded(metrics.weak_classes(_class_metrics(spark, sf), "recall", 0.4)).select("class_name", "recall", "f1")


@query
def top_confusions(spark, sf):
    return rounded(metrics.top_confusions(_matrix(spark, sf), 3))


@query
def top_confusions_high_index(spark, sf):
    return rounded(metrics.top_confusions(_matrix(spark, sf), 3, "desc"))


@query
def confusion_pairs(spark, sf):
    return metrics.confusion_pairs(_matrix(spark, sf), s.NAMES)


@query
def error_analysis(spark, sf):
    out = metrics.error_analysis(_matrix(spark, sf), s.NAMES, 3)
    told = F.array_join(F.transform("top_confusions", lambda c: F.concat(c["class_name"], F.lit("="), c["count"].cast("string"))), ";")
    return rounded(out.withColumn("top_confusions", told))


@query
def directed_pairs(spark, sf):
    return rounded(metrics.directed_pairs(metrics.error_analysis(_matrix(spark, sf), s.NAMES, 3)))


@query
def hard_class_lines(spark, sf):
    return sinks.hard_class_lines(metrics.error_analysis(_matrix(spark, sf), s.NAMES, 2))


@query
def class_kv_lines(spark, sf):
    return sinks.class_kv(metrics.summary_metrics(_class_metrics(spark, sf)), "stage2", 0.5)


@query
def label_manifest(spark, sf):
    out = sinks.label_manifest(validate.class_index(s.table(spark, sf, "part"), "p_type"))
    return out.select("stage", F.array_join("class_names", ",").alias("class_names"), map_text("class_to_index").alias("class_to_index"), map_text("index_to_class").alias("index_to_class"), "num_classes")


@query
def binary_metrics(spark, sf):
    return rounded(threshold.binary_metrics(s.gate(spark, sf), 0.5))


@query
def binary_kv_lines(spark, sf):
    return sinks.binary_kv(threshold.binary_metrics(s.gate(spark, sf), 0.5))


@query
def threshold_sweep(spark, sf):
    return rounded(threshold.threshold_sweep(s.gate(spark, sf)))


@query
def pick_threshold(spark, sf):
    return rounded(threshold.pick_threshold(threshold.threshold_sweep(s.gate(spark, sf))))


@query
def top_thresholds(spark, sf):
    return rounded(threshold.top_thresholds(threshold.threshold_sweep(s.gate(spark, sf))))


# --- audits ------------------------------------------------------------------------------------


@query
def route_eval(spark, sf):
    return rounded(
        s.flow_rows(spark, sf).select("image_path", "group", "route", "evaluation_status", "correct", "predicted_label", "confidence", "reason")
    )


@query
def route_two_stage(spark, sf):
    m = scores.top2_margin(F.col("probs"), s.NAMES)
    rows = s.uploads(spark, sf).select("image_path", "score", m.alias("m"))
    r = scores.route_two_stage(F.col("score"), F.col("m.top1_label"), F.col("m.top1_confidence"), 0.5, 0.6)
    return rounded(rows.select("image_path", r.alias("r")).select("image_path", "r.*"))


@query
def flow_summary(spark, sf):
    return rounded(audit.flow_summary(s.flow_rows(spark, sf)))


@query
def wrong_analysis(spark, sf):
    return audit.wrong_analysis(s.flow_rows(spark, sf))


@query
def unsupported_predictions(spark, sf):
    out = audit.unsupported_predictions(s.flow_rows(spark, sf))
    told = F.array_join(F.transform(F.map_entries("predicted_as"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";")
    return out.withColumn("predicted_as", told)


@query
def accepted_report(spark, sf):
    return rounded(audit.accepted_report(s.flow_rows(spark, sf), s.NAMES)[1])


@query
def supported_eval(spark, sf):
    rows = s.uploads(spark, sf).withColumn("predicted_label", s.name_of(metrics.prediction(F.col("probs"))))
    return rounded(audit.supported_eval(cut(rows), s.NAMES))


@query
def final_route(spark, sf):
    return rounded(
        s.production_rows(spark, sf).select(
            "image_path", "group", "stage_a_route", "stage_b_ran", "stage_b_top1_label", "stage_b_margin", "final_route",
            "evaluation_result", "reason", "is_correct_flow", "is_wrong_flow",
        )
    )


@query
def production_summary(spark, sf):
    return rounded(audit.production_summary(s.production_rows(spark, sf)))


@query
def upload_class_summary(spark, sf):
    return rounded(audit.upload_class_summary(s.production_rows(spark, sf)))


@query
def confused_pairs(spark, sf):
    return audit.confused_pairs(s.production_rows(spark, sf)).withColumn("examples", F.array_join("examples", ","))


@query
def audit_counters(spark, sf):
    return audit.counted(s.production_rows(spark, sf), "group", "final_route", "evaluation_result")


@query
def worst_classes(spark, sf):
    return audit.wrong_supported_by_class(s.production_rows(spark, sf))


@query
def error_cases(spark, sf):
    return audit.outcome_slices(s.production_rows(spark, sf))["error_cases"].select("image_path", "group", "final_route", "reason")


# --- runs --------------------------------------------------------------------------------------


def _epochs(spark, sf):
    """Histories with the place of each epoch inside its stage: at most 24 hours per run and day."""
    place = F.row_number().over(Window.partitionBy("run", "stage_pos").orderBy("hour")) - 1
    return s.history(spark, sf).withColumn("i", place)


def _run_rows(spark, sf):
    """Per run its summary and test metrics taken from its last validation figures."""
    hist = s.history(spark, sf)
    tests = hist.groupBy("run").agg(F.max("val_accuracy").alias("test_accuracy"), F.min("loss").alias("macro_precision"), F.max("loss").alias("macro_recall"), F.max("val_loss").alias("macro_f1"))
    long = tests.unpivot(["run"], ["test_accuracy", "macro_precision", "macro_recall", "macro_f1"], "metric", "value")
    report = long.where("metric <> 'macro_f1'")
    return runs.metric_rows(runs.run_summary(hist), runs.normalize_metrics(report, long.where("metric in ('macro_f1', 'macro_recall')")))


@query
def epoch_index(spark, sf):
    return runs.epoch_index(_epochs(spark, sf)).select("run", "stage", "hour", "epoch")


@query
def stage_boundaries(spark, sf):
    return runs.stage_boundaries(_epochs(spark, sf)).select("run", "stage", "epochs", "boundary")


@query
def run_summary(spark, sf):
    return rounded(_run_rows(spark, sf))


@query
def best_run(spark, sf):
    return rounded(runs.best_run(_run_rows(spark, sf)))


@query
def best_stage(spark, sf):
    return rounded(runs.best_stage(s.history(spark, sf)))


@query
def compare_runs(spark, sf):
    return rounded(runs.compare_runs(_run_rows(spark, sf), "run_000001", "run_000002"))


@query
def latest_run(spark, sf):
    return runs.latest_run(s.history(spark, sf), "run_00", "run")


# --- learning ----------------------------------------------------------------------------------


def _features(spark, sf):
    rows = s.table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").alias("features"), F.col("label").cast("string").alias("class"))
    return cut(split.stratified_split(rows, key=("vec_id",)).withColumn("truth", (F.col("label") != 9).cast("int")))


@query
def centroid_scores(spark, sf):
    rows = s.scored(spark, sf).select("vec_id", F.posexplode_outer("probs").alias("class_idx", "p"))
    return rounded(rows)


def _improved(model) -> Column:
    losses = model.summary.objectiveHistory
    return F.lit(losses[-1] < losses[0]).alias("loss_fell")


@query
def fit_gate(spark, sf):
    """What every fit must give: the test rows of both sides, a result for every point of the grid, a lower loss than at the start."""
    gate = learn.fit_gate(_features(spark, sf))
    points = gate.sweep.agg(F.count(F.lit(1)).alias("thresholds"))
    sides = gate.test.select((F.col("tn") + F.col("fp")).alias("n_other"), (F.col("fn") + F.col("tp")).alias("n_fruit"), _improved(gate.model))
    return sides.crossJoin(F.broadcast(points))


@query
def fit_classes(spark, sf):
    """What every fit must give: the test rows of every class, and a lower loss than at the start."""
    fitted = learn.fit_classes(_features(spark, sf), s.K)
    return fitted.metrics.select("class_idx", "support", _improved(fitted.model))


@query
def fit_gate_report(spark, sf):
    """The fitted gate's report: the threshold chosen on val, and all metrics and confusion cells on test."""
    gate = learn.fit_gate(_features(spark, sf))
    return rounded(gate.test)


@query
def fit_classes_report(spark, sf):
    """The fitted class model's report: per class its metrics and its row of the confusion matrix."""
    fitted = learn.fit_classes(_features(spark, sf), s.K)
    cells = fitted.matrix.groupBy(F.col("true_idx").alias("class_idx")).agg(F.array_sort(F.collect_list(F.struct("pred_idx", "n"))).alias("cells"))
    cells = cells.select("class_idx", F.array_join(F.transform("cells", lambda c: c["n"].cast("string")), ",").alias("predicted"))
    return rounded(fitted.metrics.join(cells, "class_idx"))


def _mean_gate():
    """Stand-in gate model: logistic of the mean feature."""
    return lambda batch: 1.0 / (1.0 + np.exp(-20.0 * batch.astype(float).mean(axis=1)))


def _mean_classes():
    """Stand-in class model: softmax over the sums of every tenth feature."""

    def predict(batch):
        e = np.exp(10.0 * np.stack([batch[:, c::10].astype(float).sum(axis=1) for c in range(10)], axis=1))
        return e / e.sum(axis=1, keepdims=True)

    return predict


@query
def score(spark, sf):
    rows = s.table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("features"))
    out = learn.score(rows, _mean_gate, _mean_classes, 0.5, dim=64)
    return rounded(out.select("vec_id", "score", metrics.prediction(F.col("probs")).alias("pred_idx"), F.array_max("probs").alias("confidence")))
