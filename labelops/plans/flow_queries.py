"""Queries of whole flows, of sources as parsers of text columns, and of pixel statistics over the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelops.constants import MERGE_GROUPS, OTHER
from labelops.lineage import cut
from labelops.operators import audit, images, metrics, ranking, reports, runs
from labelops.operators.dedup import listing_order
from labelops.plans import flows
from labelops.plans import standins as s
from labelops.plans.queries import _lines, _rows, _uncropped, map_text, query, rounded
from labelops.sources import readers, sinks

# --- texts of sources --------------------------------------------------------------------------


def _names(spark, sf) -> DataFrame:
    """Per brand its part names in order, with a blank before each."""
    names = F.array_sort(F.collect_set(F.concat(F.lit(" "), "p_name")))
    return s.table(spark, sf, "part").groupBy("p_brand").agg(names.alias("names")).withColumn("form", F.size("names") % 3)


@query
def class_name_texts(spark, sf):
    text = (
        F.when(F.col("form") == 0, F.to_json("names"))
        .when(F.col("form") == 1, F.to_json(F.struct(F.col("names").alias("class_names"))))
        .otherwise(F.concat(F.array_join("names", "\n"), F.lit("\n\n")))
    )
    rows = _names(spark, sf).select("p_brand", text.alias("text"))
    return rows.select("p_brand", F.posexplode(readers.parse_class_names(F.col("text"))).alias("pos", "class_name"))


@query
def manifest_texts(spark, sf):
    names = F.transform("names", lambda n: F.trim(n))
    places = F.transform(names, lambda n, i: F.struct(n, i))
    text = F.to_json(F.struct(
        F.lit("B").alias("stage"), names.alias("class_names"), F.map_from_entries(places).alias("class_to_index"), F.size(names).alias("num_classes"),
        F.array(F.lit(320), F.lit(320)).alias("image_size"), F.lit(0.5).alias("fruit_threshold"),
    ))
    rows = _names(spark, sf).select("p_brand", readers.parse_manifest(text).alias("m")).select("p_brand", "m.*")
    return rows.select(
        "p_brand", "stage", F.array_join("class_names", ",").alias("class_names"), map_text("class_to_index").alias("class_to_index"), "num_classes",
        F.array_join("image_size", ",").alias("image_size"), "fruit_threshold",
    )


@query
def manifest_drift(spark, sf):
    """Manifests some of which have further fields, and some of which lack one the schema has."""
    names = F.transform("names", lambda n: F.trim(n))
    usual = F.to_json(F.struct(names.alias("class_names"), F.when(F.col("form") > 0, F.array(F.lit(320), F.lit(320))).alias("image_size")))
    more = F.when(F.col("form") == 1, F.concat(F.lit(', "epochs": '), F.size("names").cast("string"), F.lit(', "notes": {"by": "'), F.col("p_brand"), F.lit('", "ok": true}}')))
    text = F.concat(F.substring(usual, F.lit(1), F.length(usual) - 1), F.coalesce(more, F.lit("}")))
    rows = _names(spark, sf).select("p_brand", readers.parse_open_manifest(text).alias("m"))
    return rows.select("p_brand", F.size("m.class_names").alias("n"), F.array_join("m.image_size", ",").alias("image_size"), map_text("m.unknown").alias("unknown"))


@query
def weak_class_texts(spark, sf):
    names = F.transform("names", lambda n: F.upper(n))
    text = F.when(F.col("form") == 0, F.to_json(names)).otherwise(F.to_json(F.struct(F.array_append(names, F.lit(" ")).alias("weak_classes"))))
    return _names(spark, sf).select("p_brand", F.explode(readers.parse_weak_classes(text)).alias("requested"))


def _text(col: str) -> Column:
    return F.col(col).cast("string")


@query
def kv_metric_lines(spark, sf):
    lines = F.array(
        F.concat(F.lit("loss: "), _text("loss")), F.concat(F.lit(" epochs :  "), _text("n"), F.lit(" ")), F.lit("selected_stage: stage2"),
        F.lit("started: 10:30"), F.lit("no colon"),
    )
    return readers.parse_kv_metrics(s.history(spark, sf).select("run", F.explode(lines).alias("value")))


def _report(*columns: str) -> Column:
    """Lines of a text report; the second but last is too short to hold an average."""
    a, b, c, d = map(_text, columns)
    return F.array(
        F.concat(F.lit("    accuracy      "), a, F.lit("  10")), F.concat_ws(" ", F.lit("macro avg"), b, c, d, F.lit("10")),
        F.concat_ws("   ", F.lit("weighted avg"), d, c, b, F.lit("10")), F.lit("macro avg 1.0"), F.lit("apple 0.5 0.5 0.5 10"),
    )


@query
def report_metric_lines(spark, sf):
    rows = s.history(spark, sf).select("run", F.explode(_report("val_accuracy", "loss", "val_loss", "n")).alias("value"))
    return readers.parse_report_metrics(rows)


def _history_texts(spark, sf) -> DataFrame:
    """One JSON text per run: three stages, the epochs in order of time, the last validation loss of each missing."""
    stage = F.get(F.array(F.lit("stage1"), F.lit("stage2"), F.lit("extra")), F.pmod("stage_pos", F.lit(3)))
    rows = s.history(spark, sf).select("run", stage.alias("key"), F.struct("stage_pos", "hour", "n", "val_accuracy", "loss", "val_loss").alias("e"))
    epochs = rows.groupBy("run", "key").agg(F.array_sort(F.collect_list("e")).alias("e"))
    body = F.struct(
        F.transform("e", lambda e: e["n"].cast("double")).alias("accuracy"), F.transform("e", lambda e: e["val_accuracy"]).alias("val_accuracy"),
        F.transform("e", lambda e: e["loss"]).alias("loss"), F.transform(F.slice("e", F.lit(1), F.size("e") - 1), lambda e: e["val_loss"]).alias("val_loss"),
    )
    stages = F.map_from_entries(F.collect_list(F.struct("key", body)))
    texts = epochs.groupBy("run").agg(F.to_json(stages).alias("value"))
    return texts.select("run", F.concat(F.lit('{"config": {"input_shape": [224, 224, 3]}, '), F.substring("value", 2, 1 << 30)).alias("value"))


@query
def history_texts(spark, sf):
    return rounded(readers.parse_history(_history_texts(spark, sf)))


@query
def history_more_metrics(spark, sf):
    """Histories with a metric the fixed schema lacks, one of its entries no number, and a value that is no list."""
    hours = s.history(spark, sf).groupBy("run").agg(F.array_sort(F.collect_list(F.struct("stage_pos", "hour", "loss"))).alias("e"))
    listed = F.array_join(F.transform("e", lambda e: e["loss"].cast("string")), ", ")
    text = F.concat(F.lit('{"config": {"top3": [1]}, "stage1": {"loss": [1.0], "top3": ['), listed, F.lit(', "none"], "lr": 0.001}, "note": "x"}'))
    return rounded(readers.parse_more_metrics(hours.select("run", text.alias("value"))))


@query
def model_family(spark, sf):
    name = F.when(F.col("p_size") % 4 == 0, F.concat("p_name", F.lit("_MobileNetV2"))).when(F.col("p_size") % 4 != 3, F.col("p_name"))
    shape = F.when(F.col("p_size") % 5 != 4, F.array(F.lit(224), F.when(F.col("p_size") % 3 == 0, 224).otherwise(320), F.lit(3)))
    return s.table(spark, sf, "part").select("p_partkey", runs.is_family(name, shape).alias("is_family"))


@query
def listing_rank(spark, sf):
    rows = s.items(spark, sf).select("class", "raw_class", "file_name")
    return ranking.rank_by_order(rows, ["class"], listing_order("raw_class", "file_name")).select("class", "file_name", F.col("rank").cast("long").alias("rank"))


# --- texts of sinks ----------------------------------------------------------------------------


@query
def csv_cells(spark, sf):
    return sinks.csv_cells(reports.output_class_stats(_rows(spark, sf)), ("class", "raw_images", "source_raw_classes"))


@query
def report_json(spark, sf):
    crops = s.items(spark, sf).select(_uncropped(), F.lit("no_bbox").alias("reason"), F.lit(False).alias("applied"))
    report = reports.dataset_report(reports.output_class_stats(_rows(spark, sf)), reports.crop_stats(crops))
    return sinks.report_json(reports.report_totals(report))


@query
def json_lines(spark, sf):
    return sinks.json_lines(s.production_rows(spark, sf).select("image_path", "group", "stage_b_top1_label", "reason"))


# --- pixels ------------------------------------------------------------------------------------


def _images(spark, sf) -> DataFrame:
    """Embeddings as gray images of 8 x 8 pixels, with a box."""
    entry = lambda x: F.least(F.lit(255), F.greatest(F.lit(0), F.floor(x.cast("double") * 512 + 128))).cast("int")
    data = F.unhex(F.array_join(F.transform("embedding", lambda x: F.lpad(F.hex(entry(x)), 2, "0")), ""))
    image = F.struct(F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(1).alias("nChannels"), data.alias("data"))
    x1, y1 = F.pmod("vec_id", F.lit(4)).cast("int"), F.pmod("vec_id", F.lit(3)).cast("int")
    box = F.struct(x1.alias("x1"), y1.alias("y1"), (2 * x1 + 1).alias("x2"), (y1 + 4).alias("y2"))
    return s.table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("path"), image.alias("image"), box.alias("bbox"))


@query
def image_profile(spark, sf):
    rows = _images(spark, sf)
    files = rows.select("path", F.sha2("image.data", 256).alias("content_hash"))
    return rounded(images.image_profile(rows, files)).select("path", "content_hash", "width", "height", "channels", "sharpness", "phash")


@query
def rgb_pixels(spark, sf):
    return images.to_rgb(_images(spark, sf)).select("path", "width", "height", F.hex("rgb").alias("rgb"))


@query
def box_contrast(spark, sf):
    return rounded(images.color_contrast(_images(spark, sf)))


# --- flows -------------------------------------------------------------------------------------


@query
def flow_clean(spark, sf):
    stats = flows.clean_dataset(s.items(spark, sf)).class_stats
    return stats.withColumn("skip_reasons", map_text("skip_reasons")).withColumn("source_raw_classes", F.array_join("source_raw_classes", ","))


@query
def flow_crop(spark, sf):
    rows = _lines(spark, sf).withColumn("class", F.concat(F.lit("c"), _text("l_linenumber"))).withColumn("sharpness", F.col("area").cast("double"))
    return flows.crop_audit(rows)[1].withColumn("reasons", map_text("reasons"))


def _split(spark, sf) -> flows.SplitResult:
    return flows.split_dataset(cut(s.items(spark, sf)))


@query
def flow_split(spark, sf):
    return _split(spark, sf).counts


@query
def flow_subset(spark, sf):
    rows = _split(spark, sf).rows.withColumn("class", F.when(F.col("class") == "de", "Other ").otherwise(F.col("class")))
    return flows.build_subset(rows)[1]


@query
def flow_supported(spark, sf):
    out = flows.build_supported(_split(spark, sf).rows, ("fr",))
    return out.counts.withColumn("side", F.lit("supported")).unionByName(out.unsupported_counts.withColumn("side", F.lit("unsupported")))


@query
def flow_ab(spark, sf):
    rows = cut(s.items(spark, sf).select("class", "file_name", "content_hash", "width"))
    return flows.ab_datasets(rows, rows.withColumn("width", F.col("width") + 1), required=("de", "en"), forbidden=("xx",)).manifest


@query
def flow_validate(spark, sf):
    named = F.get(F.array(*[F.lit(c) for c in (*MERGE_GROUPS, OTHER)]), F.pmod("path", F.lit(len(MERGE_GROUPS) + 1)).cast("int"))
    main = flows.split_dataset(cut(s.items(spark, sf).withColumn("class", named))).rows
    return flows.validate_dataset(main, main.where(F.col("class") != OTHER))


@query
def flow_loader(spark, sf):
    rows = s.items(spark, sf).withColumn("class", F.when(F.col("path") % 2 == 0, "even").otherwise("odd"))
    return flows.clean_splits(flows.split_dataset(cut(rows)).rows)[0].select("split", "class", "file_name")


@query
def flow_labels(spark, sf):
    rows = s.items(spark, sf).select("path", F.when(F.col("class") == "es", "Other ").otherwise(F.initcap("class")).alias("class"))
    views = [flows.label_views(rows, m).select("path", F.lit(m).alias("view"), F.col("label").cast("int").alias("label")) for m in ("multiclass", "binary", "no_other")]
    return reduce(DataFrame.unionByName, views)


@query
def flow_uploads(spark, sf):
    return flows.audit_uploads(s.uploads(spark, sf), s.NAMES, 0.3, 0.6)["counters"]


@query
def flow_production(spark, sf):
    return flows.audit_production(s.uploads(spark, sf), s.NAMES)["counters"]


@query
def flow_supported_eval(spark, sf):
    out = flows.eval_supported(s.uploads(spark, sf), s.NAMES)["unsupported"]
    told = F.array_join(F.transform(F.map_entries("predicted_as"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";")
    return out.withColumn("predicted_as", told)


@query
def flow_confusion(spark, sf):
    stored = metrics.confusion(s.predicted(spark, sf), s.K)
    return flows.analyze_confusion(s.NAMES, matrix=stored)["pairs"]


@query
def flow_runs(spark, sf):
    """Histories and both kinds of metric file as texts; the key/value file has the last word, and its own accuracy key."""
    tests = s.history(spark, sf).groupBy("run").agg(
        F.max("val_accuracy").alias("a"), F.min("loss").alias("b"), F.max("loss").alias("c"), F.max("val_loss").alias("d"), F.min("val_accuracy").alias("e")
    )
    report = readers.parse_report_metrics(tests.select("run", F.explode(_report("a", "b", "c", "d")).alias("value")))
    lines = F.array(F.concat(F.lit("test_accuracy_reference_only: "), _text("e")), F.concat(F.lit("macro_f1: "), _text("c")), F.lit("selected_stage: stage1"))
    kv = readers.parse_kv_metrics(tests.select("run", F.explode(lines).alias("value")))
    return rounded(flows.compare_run_tables(readers.parse_history(_history_texts(spark, sf)), report, kv)["rows"])


# --- every branch of the outcome tables --------------------------------------------------------


def _rough(spark, sf) -> DataFrame:
    """Uploads of which some have an unknown label, no gate score or no class scores."""
    every = lambda n: F.pmod("vec_id", F.lit(n)) == 0
    return s.uploads(spark, sf).withColumns({
        "group": F.when(every(11), "unknown_label").otherwise(F.col("group")),
        "score": F.when(~every(13), F.col("score")),
        "probs": F.when(~every(17), F.col("probs")),
    })


@query
def flow_reasons(spark, sf):
    return cut(flows.routed_uploads(_rough(spark, sf), s.NAMES, 0.3, 0.6)).select("image_path", "group", "route", "evaluation_status", "reason")


@query
def production_reasons(spark, sf):
    return cut(flows.routed_production(_rough(spark, sf), s.NAMES)).select("image_path", "group", "final_route", "evaluation_result", "reason")


@query
def upload_slices(spark, sf):
    slices = audit.outcome_slices(cut(flows.routed_uploads(_rough(spark, sf), s.NAMES, 0.3, 0.6)))
    return reduce(DataFrame.unionByName, [rows.select(F.lit(name).alias("slice"), "image_path") for name, rows in slices.items()])
