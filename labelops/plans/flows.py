"""Dataset-level flows: compositions of operators a user calls.

A flow that reads its input more than once checkpoints the one expensive frame; guards are one small
row of counts, read at the end."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelops.constants import (
    CLEAN_EXTENSIONS,
    LOADER_EXTENSIONS,
    MERGE_GROUPS,
    OTHER,
    PRE_MERGE_NAMES,
    SPLITS,
    UNSUPPORTED_V1,
)
from labelops.functions.quality import CropRules, Quality, blur_reason, crop_decision, expand_bbox, quality_reason
from labelops.functions.scores import Bands, final_route, flow_outcome, needs_class_model, production_outcome
from labelops.functions.scores import route_eval, route_stage_a, top2_margin, top_k
from labelops.functions.tokens import binary_label, clean_label, is_other, merge_class
from labelops.lineage import cut, join_on, stored, stored_observed
from labelops.operators import audit, metrics, reports, runs, split, validate, variants
from labelops.operators.cleaning import clean
from labelops.operators.dedup import dedup_exact, duplicate_counts
from labelops.operators.labels import label_index
from labelops.operators.taxonomy import drop_other, missing_names, raw_mapping, supported_only
from labelops.operators.taxonomy import taxonomy_plan
from labelops.plans import audit_files
from labelops.sources import publish, readers, sinks
from labelops.sources.scans import scan_labelled


def _require_none(findings: DataFrame, what: str) -> None:
    example = findings.first()
    if example is not None:
        raise ValueError(f"{what}: {example}")


def check_plan(plan: DataFrame) -> None:
    """Raise on the first class that breaks the taxonomy."""
    _require_none(plan.where(F.col("problem").isNotNull()), "taxonomy problem")


# --- cleaning, crops, splits -------------------------------------------------------------------


@dataclass
class Cleaned:
    rows: DataFrame
    kept: DataFrame
    raw_stats: DataFrame
    class_stats: DataFrame


def clean_dataset(
    items: DataFrame, cfg: Quality = Quality(), extensions: Sequence[str] = CLEAN_EXTENSIONS, tolerance: int = 0,
    row_key: Sequence[str] = ("path",),
) -> Cleaned:
    """Raw rows (raw_class, file_name, path, width, height, sharpness, phash) to cleaned rows and stats.

    The rows are written once, since the taxonomy check, the gates and the duplicate check each read
    them and pixels are costly to look at. Kept rows carry their new, unique ``file_name`` and the old
    one as ``source_file_name``."""
    items = cut(items)
    check_plan(taxonomy_plan(raw_mapping(items)))
    merged = items.withColumn("class", merge_class(F.col("raw_class")))
    rows = cut(clean(merged, cfg, extensions, tolerance, row_key=row_key))
    kept = reports.unique_names(rows.where(F.col("reason").isNull()).drop("reason")).withColumnsRenamed(
        {"file_name": "source_file_name", "output_name": "file_name"}
    )
    return Cleaned(rows, kept, reports.raw_class_stats(rows), reports.output_class_stats(rows))


def crop_audit(items: DataFrame, quality: Quality = Quality(), cfg: CropRules = CropRules()) -> tuple[DataFrame, DataFrame]:
    """Crop decision per image and statistics with the grand total.

    Needs width, height, sharpness, bbox and the three signals. Unreadable images fail; images below
    the quality gates stay uncropped with that reason. The rows are written once for both results."""
    w, h = F.col("width"), F.col("height")
    gate = F.coalesce(
        F.when(F.coalesce(w, F.lit(-1)) < 0, "corrupted_image"),
        quality_reason(w, h, quality),
        blur_reason(F.col("sharpness"), quality.min_sharpness),
    )
    grown = expand_bbox(F.col("bbox"), w, h, cfg.padding)
    rows = cut(
        crop_decision(items.withColumn("_grown", grown), "_grown", cfg=cfg)
        .withColumn("_gate", gate)
        .withColumn("reason", F.coalesce("_gate", "crop.reason"))
        .withColumn("applied", F.col("_gate").isNull() & F.col("crop.applied"))
        .drop("_grown", "_gate")
    )
    return rows, reports.crop_summary(rows)


@dataclass
class SplitResult:
    rows: DataFrame
    counts: DataFrame
    duplicates: DataFrame
    leaks: DataFrame


def split_dataset(
    items: DataFrame, ratios: Sequence[float] = split.RATIOS, seed: int = 42, root: str | None = None,
    clean_output: bool = False,
) -> SplitResult:
    """Remove exact copies, split every class, check for leaks, optionally publish."""
    kept = cut(dedup_exact(items))
    duplicates = duplicate_counts(items, kept, minimum=len(SPLITS))
    rows = cut(split.stratified_split(kept, ratios, seed))
    leaks = validate.leak_report(rows).where("shared_keys > 0")
    _require_none(leaks, "split leak")
    if root is not None:
        sinks.write_splits(rows, root, clean_output)
    return SplitResult(rows, split.split_counts(rows), duplicates, leaks)


def build_subset(rows: DataFrame, root: str | None = None, clean_output: bool = False) -> tuple[DataFrame, DataFrame]:
    """Split dataset without the ``other`` class: rows and counts."""
    _require_none(validate.class_alignment(rows).where(~F.col("aligned")), "classes differ between splits")
    if rows.where(is_other(F.col("class"))).isEmpty():
        raise ValueError("the source has no 'other' class to drop")
    subset = drop_other(rows)
    counts = split.split_counts(subset)
    if root is not None:
        sinks.write_splits(subset, root, clean_output)
        sinks.write_class_names(validate.class_index(subset), root.rstrip("/") + "_class_names")
    return subset, counts


@dataclass
class Supported:
    rows: DataFrame
    counts: DataFrame
    unsupported_counts: DataFrame


def build_supported(
    rows: DataFrame, unsupported: Sequence[str] = UNSUPPORTED_V1, root: str | None = None, clean_output: bool = False
) -> Supported:
    """Supported classes of an ``other``-free split dataset, with counts of what was left out."""
    _require_none(validate.class_alignment(rows).where(~F.col("aligned")), "classes differ between splits")
    _require_none(validate.class_policy(rows, (), (OTHER,)), "class must not be in the source")
    _require_none(missing_names(rows, unsupported), "unsupported class not in the source")
    kept = supported_only(rows, unsupported)
    _require_none(validate.leak_report(kept).where("shared_keys > 0"), "split leak")
    left_out = split.split_counts(rows.where(F.col("class").isin(list(unsupported))))
    if root is not None:
        sinks.write_splits(kept, root, clean_output)
        sinks.write_class_names(validate.class_index(kept), root.rstrip("/") + "_class_names")
    return Supported(kept, split.split_counts(kept), left_out)


@dataclass
class Variants:
    manifest: DataFrame
    a: DataFrame
    b: DataFrame
    report: DataFrame


def ab_datasets(
    a: DataFrame, b: DataFrame, ratios: Sequence[float] = split.RATIOS, seed: int = 42,
    required: Sequence[str] = tuple(MERGE_GROUPS), forbidden: Sequence[str] = PRE_MERGE_NAMES,
) -> Variants:
    """Two variants of one dataset on the same split manifest, ``other`` left out."""
    _require_none(validate.class_diff(a, b), "class on one side only")
    _require_none(validate.class_policy(a, required, forbidden), "taxonomy problem")
    a, b = drop_other(a), drop_other(b)
    pairs = cut(variants.pair_variants(a, b))
    kept = cut(variants.matched_unique(pairs))
    report = variants.match_report(pairs, kept, strict=True)
    manifest = cut(split.stratified_split(kept, ratios, seed)).select("class", "file_name", "split")
    keys = list(variants.KEYS)
    return Variants(manifest, join_on(a, manifest, keys), join_on(b, manifest, keys), report)


def validate_dataset(
    main: DataFrame, subset: DataFrame, names: Sequence[str] | None = None, before: DataFrame | None = None,
    after: DataFrame | None = None,
) -> DataFrame:
    """All checks of the main and the ``other``-free dataset as two rows; raises when one fails."""
    if before is not None and after is not None:
        validate.assert_unchanged(before, after)
    required = tuple(MERGE_GROUPS)
    rows = validate.validation_summary(main, (*required, OTHER), PRE_MERGE_NAMES).withColumn("dataset", F.lit("main")).unionByName(
        validate.validation_summary(subset, required, (*PRE_MERGE_NAMES, OTHER)).withColumn("dataset", F.lit("subset"))
    )
    if names is not None:
        _require_none(validate.check_class_order(subset, names).where(~F.col("ok")), "class order differs")
    rows = cut(rows)
    _require_none(rows.where(~F.col("valid")), "dataset is not valid")
    return rows


def clean_splits(
    items: DataFrame, cfg: Quality = Quality(), extensions: Sequence[str] = LOADER_EXTENSIONS, tolerance: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Load-time cleaning of all splits: accepted rows and small classes; raises on empty classes and leaks.

    Duplicates are looked for inside one class of one split."""
    scoped = items.withColumn("_scope", F.concat_ws("/", "split", "class"))
    rows = cut(
        clean(scoped, cfg, extensions, tolerance, group="_scope", order=("file_name",), row_key=("path",)).drop("_scope")
    )
    flagged = rows.withColumn("accepted", F.col("reason").isNull()).withColumn("class", F.concat_ws("/", "split", "class"))
    small = validate.small_classes(flagged)
    _require_none(small.where("empty"), "class without accepted images")
    accepted = rows.where(F.col("reason").isNull())
    leaks = validate.split_overlap(accepted, F.col("content_hash"), "content")
    _require_none(leaks.where("shared_keys > 0 and left_split <> right_split"), "split leak")
    return accepted, small


def label_views(rows: DataFrame, mode: str = "multiclass") -> DataFrame:
    """Add the integer label of a view: ``multiclass``, ``binary`` or ``no_other``."""
    if mode == "binary":
        return rows.withColumn("label", binary_label(F.col("class")))
    named = rows.withColumn("class_name", clean_label(F.col("class")))
    if mode == "no_other":
        named = named.where(F.col("class_name") != OTHER)
    elif mode != "multiclass":
        raise ValueError(f"unknown label view: {mode}")
    clash = named.groupBy("class_name").agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a <> b")
    _require_none(clash, "several folders share one label")
    return label_index(named)


# --- audits ------------------------------------------------------------------------------------


def _error(df: DataFrame) -> Column | None:
    """Rows may bring an ``error`` text (unreadable or, in strict mode, of low quality)."""
    return F.col("error") if "error" in df.columns else None


def routed_uploads(scored: DataFrame, names: Sequence[str], gate: float = 0.5, floor: float = 0.6, k: int = 3) -> DataFrame:
    """Scored uploads (group, true_label, normalized_label, score, probs) with route and outcome."""
    confidence = F.array_max("probs")
    rows = scored.withColumn("route", route_eval(F.col("score"), confidence, gate, floor, _error(scored)))
    ran = F.col("route").isin("low_confidence", "stage_b_supported")
    rows = rows.withColumn("top_k", F.when(ran, top_k(F.col("probs"), names, k)))
    best = F.get("top_k", F.lit(0))
    rows = rows.withColumn("predicted_label", best["label"]).withColumn("confidence", F.coalesce(best["confidence"], F.lit(0.0)))
    outcome = flow_outcome(F.col("group"), F.col("route"), F.col("true_label"), F.col("predicted_label"))
    return rows.withColumn("_o", outcome).select("*", "_o.*").drop("_o")


def audit_uploads(
    scored: DataFrame, names: Sequence[str], gate: float = 0.5, floor: float = 0.6, root: str | None = None
) -> dict[str, DataFrame]:
    """Single-threshold audit: routed rows, written once with the summary's figures counted on the way, and all other summaries.

    With ``root`` the audit's files are written there (``audit_files.write_uploads``)."""
    rows, counts = stored_observed(routed_uploads(scored, names, gate, floor), *audit.flow_counts())
    per_class, accepted = audit.accepted_report(rows, names)
    out = {
        "rows": rows,
        "summary": audit.flow_rates(counts),
        "counters": audit.counted(rows, "route", "group", "evaluation_status"),
        "wrong": audit.wrong_analysis(rows),
        "unsupported": audit.unsupported_predictions(rows),
        "accepted_classes": per_class,
        "accepted_summary": accepted,
        **audit.outcome_slices(rows),
    }
    if root is not None:
        audit_files.write_uploads(out, root, gate, floor)
    return out


def routed_production(scored: DataFrame, names: Sequence[str], cfg: Bands = Bands()) -> DataFrame:
    """Scored uploads (group, true_label, score, probs) with bands, final route and outcome."""
    group, p = F.col("group"), F.col("score")
    ran = F.coalesce(needs_class_model(group, p, cfg), F.lit(False))
    rows = (
        scored.withColumn("stage_a_route", route_stage_a(p, cfg))
        .withColumn("stage_b_ran", ran)
        .withColumn("_m", F.when(ran, top2_margin(F.col("probs"), names)))
    )
    for c in ("top1_label", "top1_confidence", "top2_label", "top2_confidence", "margin"):
        rows = rows.withColumn(f"stage_b_{c}", F.col("_m")[c])
    route = final_route(group, p, F.col("stage_b_top1_confidence"), F.col("stage_b_margin"), cfg, _error(scored))
    rows = rows.drop("_m").withColumn("final_route", route)
    outcome = production_outcome(group, F.col("final_route"), F.col("true_label"), F.col("stage_b_top1_label"))
    return rows.withColumn("_o", outcome).select("*", "_o.*").drop("_o")


def audit_production(scored: DataFrame, names: Sequence[str], cfg: Bands = Bands(), root: str | None = None) -> dict[str, DataFrame]:
    """Banded audit: routed rows, written once with the summary's figures counted on the way, and all other summaries.

    With ``root`` the audit's files are written there (``audit_files.write_production``)."""
    rows, counts = stored_observed(routed_production(scored, names, cfg), *audit.production_counts())
    out = {
        "rows": rows,
        "summary": audit.production_rates(counts),
        "counters": audit.counted(rows, "group", "final_route", "evaluation_result"),
        "classes": audit.upload_class_summary(rows),
        "confused_pairs": audit.confused_pairs(rows),
        "worst_classes": audit.wrong_supported_by_class(rows),
        **audit.outcome_slices(rows),
    }
    if root is not None:
        audit_files.write_production(out, root, {
            "stage_a_fruit_threshold": cfg.accept, "stage_a_other_threshold": cfg.reject, "stage_b_confidence_threshold": cfg.confidence, "stage_b_margin_threshold": cfg.margin,
        })
    return out


def eval_supported(scored: DataFrame, names: Sequence[str], floor: float = 0.6, k: int = 3, root: str | None = None) -> dict[str, DataFrame]:
    """Class model alone on labelled uploads: rows, supported metrics, predictions for other labels.

    With ``root`` its files are written there (``audit_files.write_supported``)."""
    best = F.get("top_k", F.lit(0))
    rows = stored(
        scored.withColumn("top_k", top_k(F.col("probs"), names, k))
        .withColumn("predicted_label", best["label"])
        .withColumn("confidence", best["confidence"])
        .withColumn("low_confidence", F.col("confidence") < floor)
        .withColumn("correct", F.when(F.col("true_label").isNotNull(), F.col("predicted_label") == F.col("true_label")))
    )
    out = {
        "rows": rows,
        "summary": audit.supported_eval(rows, names),
        "counters": audit.counted(rows, "group"),
        "unsupported": audit.unsupported_predictions(rows, F.col("true_label").isNull()),
    }
    if root is not None:
        audit_files.write_supported(out, root, names)
    return out


# --- analysis of models and runs ---------------------------------------------------------------


def analyze_confusion(
    names: Sequence[str], labels: DataFrame | None = None, matrix: DataFrame | None = None, k: int = 5, pairs: int = 10
) -> dict[str, DataFrame]:
    """Confusion analysis from labels (true_idx, pred_idx) or from a stored long-form matrix."""
    if matrix is None:
        if labels is None:
            raise ValueError("need labels or a matrix")
        matrix = metrics.confusion(labels, len(names))
    matrix = cut(matrix)
    analysis = metrics.error_analysis(matrix, names, k)
    return {
        "matrix": matrix,
        "analysis": analysis,
        "directed_pairs": metrics.directed_pairs(analysis),
        "pairs": metrics.confusion_pairs(matrix, names, pairs),
        "summary": metrics.summary_metrics(metrics.class_metrics(matrix)),
        "hard_lines": sinks.hard_class_lines(analysis),
    }


def compare_run_tables(history: DataFrame, report: DataFrame, kv: DataFrame) -> dict[str, DataFrame]:
    """Summary table and best run from epochs and the metrics (run, metric, value) of both kinds of metric file."""
    rows = runs.metric_rows(runs.run_summary(history), runs.normalize_metrics(report, kv))
    return {"rows": rows, "best": runs.best_run(rows), "epochs": runs.epoch_index(history), "stages": runs.best_stage(history)}


def compare_training_runs(spark: SparkSession, folder: str, history_name: str = "history.json") -> dict[str, DataFrame]:
    """Summary table and best run of all run folders ``<folder>/<run>/``."""
    return compare_run_tables(
        readers.read_history(spark, f"{folder}/*/{history_name}"),
        readers.read_report_metrics(spark, f"{folder}/*/classification_report.txt"),
        readers.read_kv_metrics(spark, f"{folder}/*/test_results.txt"),
    )


# --- rebuild -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class RebuildPaths:
    """Folders of a rebuild; ``cleaned`` is ``<main>_cleaned`` unless given. No output may lie inside the source."""

    raw: str
    main: str
    subset: str
    report: str
    cleaned: str | None = None
    outputs: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        raw = self.raw.rstrip("/") + "/"
        object.__setattr__(self, "cleaned", self.cleaned or self.main.rstrip("/") + "_cleaned")
        object.__setattr__(self, "outputs", (self.main, self.subset, self.report, self.cleaned))
        for out in self.outputs:
            if (out.rstrip("/") + "/").startswith(raw):
                raise ValueError(f"output may not be inside the source: {out}")


def rebuild(stage: str, items: DataFrame, paths: RebuildPaths, crops: DataFrame | None = None, seed: int = 42, clean_output: bool = False) -> DataFrame:
    """One stage of the dataset rebuild on a profiled listing of ``paths.raw``.

    ``preprocess`` publishes the cleaned rows at ``paths.cleaned`` (``publish.read_published``) and writes the cleaning-and-crop report;
    ``crop`` writes the report with crop figures only; ``split`` writes the main and the ``other``-free split
    datasets and returns the checks. A source that changed meanwhile is an error that names its files."""
    if stage == "split":
        # taken before anything is written, and again from a fresh listing afterwards
        before = stored(scan_labelled(items.sparkSession, paths.raw))
        main = split_dataset(items, seed=seed, root=paths.main, clean_output=clean_output)
        subset, _ = build_subset(main.rows, paths.subset, clean_output)
        validate.require_same_files(before, stored(scan_labelled(items.sparkSession, paths.raw)))
        return validate_dataset(main.rows, subset)
    if stage not in ("preprocess", "crop"):
        raise ValueError(f"unknown stage: {stage}")
    if stage == "preprocess" and sinks.path_exists(items.sparkSession, paths.cleaned) and not clean_output:
        raise FileExistsError(f"output exists, pass clean_output to replace it: {paths.cleaned}")
    items = cut(items)
    crops = crop_audit(items if crops is None else crops)[1].where(F.col("class").isNotNull())
    if stage == "preprocess":
        cleaned = clean_dataset(items)
        publish.Draft(cleaned.kept, paths.cleaned).commit(source=paths.raw)
        publish.expire(items.sparkSession, paths.cleaned)
        stats = cleaned.class_stats
    else:
        merged = raw_mapping(items)
        empty = F.lit(None).cast("bigint")
        stats = taxonomy_plan(merged).select(
            "class", F.col("sources").alias("source_raw_classes"), empty.alias("raw_images"), empty.alias("valid_images"),
            empty.alias("skipped_images"), F.create_map().cast("map<string,bigint>").alias("skip_reasons"),
        )
    report = cut(reports.dataset_report(stats, crops))
    sinks.write_report(reports.report_payload(report), paths.report)
    return reports.report_totals(report)
