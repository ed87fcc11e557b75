"""What an audit leaves in a folder: predictions, per-class table, error cases and confused pairs as CSV, JSON lines, a JSON report.

All of it is written from the routed rows, which were written once, with their figures counted on the way."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelops.sources import sinks

# Columns of the CSV files, in file order.
PRODUCTION_FIELDS = (
    "image_path", "raw_label", "normalized_label", "true_label", "group", "stage_a_fruit_probability", "stage_a_route", "stage_b_top1_label",
    "stage_b_top1_confidence", "stage_b_top2_label", "stage_b_top2_confidence", "stage_b_margin", "final_route", "evaluation_result", "reason",
    "is_correct_flow", "is_wrong_flow", "stage_b_ran", "top_k", "warnings", "error",
)
CLASS_FIELDS = ("label", "group", "total", "auto_accepted", "auto_correct", "auto_wrong", "manual_review", "stage_a_other", "error", "auto_accuracy")
PAIR_FIELDS = ("true_label", "predicted_label", "count", "examples")
UPLOAD_FIELDS = (
    "image_path", "raw_label", "normalized_label", "truth_label", "truth_status", "stage_a_fruit_probability", "stage_a_threshold", "stage_b_threshold",
    "route", "evaluation_status", "correct", "predicted_label", "confidence", "reason", "top_k", "warnings", "error",
)
SUPPORTED_FIELDS = (
    "image_path", "raw_label", "normalized_label", "expected_label", "status", "predicted_label", "confidence", "low_confidence", "correct", "top_k", "warnings",
)
# Names that files use for columns of the library.
FILE_NAMES = {"score": "stage_a_fruit_probability"}
UPLOAD_NAMES = {**FILE_NAMES, "true_label": "truth_label", "group": "truth_status"}
SUPPORTED_NAMES = {"true_label": "expected_label", "group": "status"}


def file_rows(rows: DataFrame, fields: Sequence[str], names: Mapping[str, str], **constants) -> DataFrame:
    """The rows under the names of a file, in its order; what they do not have is empty."""
    rows = rows.withColumnsRenamed({k: v for k, v in names.items() if k in rows.columns and v not in rows.columns})
    rows = rows.withColumns({k: F.lit(v) for k, v in constants.items()}) if constants else rows
    return rows.select(*[F.col(f) if f in rows.columns else F.lit(None).cast("string").alias(f) for f in fields])


def _json_rows(rows: DataFrame) -> DataFrame:
    """Rows as a list of a report, at most a handful: one row with the array ``rows``."""
    return rows.agg(F.collect_list(F.struct("*")).alias("rows"))


def _counts(counters: DataFrame, name: str) -> Column:
    """MAP value -> n of one counter; a missing value is counted as ``none``."""
    entries = F.array_sort(F.collect_list(F.struct(F.coalesce("value", F.lit("none")).alias("value"), "n")))
    return counters.where(F.col("counter") == name).agg(F.map_from_entries(entries).alias("m")).scalar()


def _by_count(table: DataFrame, key: str) -> Column:
    """MAP key -> n of a class-sized table, as an object in key order."""
    entries = F.array_sort(F.collect_list(F.struct(F.coalesce(key, F.lit("none")).alias("key"), "n")))
    return table.agg(F.map_from_entries(entries).alias("m")).scalar()


def _top(table: DataFrame, col: str) -> Column:
    """The value with the highest count; of equal ones the first."""
    return table.agg(F.min_by(col, F.struct((-F.col("n")).alias("n"), col)).alias("v")).scalar()


def write_production(out: Mapping[str, DataFrame], root: str, thresholds: Mapping[str, float], mode: str = "overwrite") -> None:
    """Four CSV files and the summary of the banded audit."""
    base = root.rstrip("/")
    sinks.write_csv(file_rows(out["rows"], PRODUCTION_FIELDS, FILE_NAMES), f"{base}/upload_flow_predictions.csv", PRODUCTION_FIELDS, mode=mode)
    sinks.write_csv(out["classes"], f"{base}/upload_flow_per_class_summary.csv", CLASS_FIELDS, single=True, mode=mode)
    sinks.write_csv(file_rows(out["error_cases"], PRODUCTION_FIELDS, FILE_NAMES), f"{base}/upload_flow_error_cases.csv", PRODUCTION_FIELDS, mode=mode)
    sinks.write_csv(out["confused_pairs"], f"{base}/upload_flow_confused_pairs.csv", PAIR_FIELDS, single=True, mode=mode)
    sinks.write_report(production_report(out, thresholds), f"{base}/upload_flow_summary.json", mode)


def production_report(out: Mapping[str, DataFrame], thresholds: Mapping[str, float]) -> DataFrame:
    """One row: figures, thresholds, counters, wrong classes and the ten most confused pairs."""
    worst = out["worst_classes"].select("true_label", "n")
    return out["summary"].select(
        "*", F.struct(*[F.lit(float(v)).alias(k) for k, v in thresholds.items()]).alias("thresholds"),
        _json_rows(out["confused_pairs"].limit(10)).scalar().alias("top_confused_pairs"),
        _top(worst, "true_label").alias("most_wrong_class"), _by_count(worst, "true_label").alias("wrong_supported_by_class"),
        *[_counts(out["counters"], c).alias(f"{c}_counts") for c in ("group", "final_route", "evaluation_result")],
    )


def write_uploads(out: Mapping[str, DataFrame], root: str, gate: float, floor: float, mode: str = "overwrite") -> None:
    """Predictions as CSV and JSON lines, and the report of the single-threshold audit; its image lists are JSON lines of their own."""
    base = root.rstrip("/")
    rows = file_rows(out["rows"], UPLOAD_FIELDS, UPLOAD_NAMES, stage_a_threshold=float(gate), stage_b_threshold=float(floor))
    sinks.write_csv(rows, f"{base}/upload_flow_predictions.csv", UPLOAD_FIELDS, mode=mode)
    sinks.write_jsonl(rows, f"{base}/upload_flow_predictions.jsonl", mode)
    for name in ("gate_blocked_wrong", "class_wrong", "review", "errors"):
        sinks.write_jsonl(file_rows(out[name], UPLOAD_FIELDS, UPLOAD_NAMES), f"{base}/{name}.jsonl", mode)
    sinks.write_report(uploads_report(out, gate, floor), f"{base}/upload_flow_report.json", mode)


def uploads_report(out: Mapping[str, DataFrame], gate: float, floor: float) -> DataFrame:
    wrong = {v: out["wrong"].where(F.col("view") == v) for v in ("true_label", "predicted_label", "pair")}
    figures = F.struct(
        *out["summary"].columns, *[_counts(out["counters"], c).alias(f"{name}_counts") for c, name in (("route", "route"), ("group", "truth_status"), ("evaluation_status", "evaluation_status"))]
    )
    views = F.struct(
        _top(wrong["true_label"], "label").alias("most_wrong_class"), _by_count(wrong["true_label"], "label").alias("wrong_by_true_label"),
        _by_count(wrong["predicted_label"], "label").alias("wrong_by_predicted_label"), _by_count(wrong["pair"], "label").alias("stage_b_confused_pairs"),
    )
    return out["summary"].select(
        figures.alias("summary"), views.alias("wrong_analysis"), F.lit(float(gate)).alias("stage_a_threshold"), F.lit(float(floor)).alias("stage_b_threshold"),
        _json_rows(out["unsupported"].orderBy("label")).scalar().alias("unsupported_v1_auto_predictions"),
        _json_rows(out["accepted_summary"]).scalar().alias("stage_b_supported_report"), _json_rows(out["accepted_classes"]).scalar().alias("stage_b_supported_classes"),
    )


def write_supported(out: Mapping[str, DataFrame], root: str, names: Sequence[str], mode: str = "overwrite") -> None:
    """Predictions as CSV and JSON lines, and the report of the class model alone."""
    base = root.rstrip("/")
    rows = file_rows(out["rows"], SUPPORTED_FIELDS, SUPPORTED_NAMES)
    sinks.write_csv(rows, f"{base}/upload_predictions.csv", SUPPORTED_FIELDS, mode=mode)
    sinks.write_jsonl(rows, f"{base}/upload_predictions.jsonl", mode)
    report = out["summary"].select(
        F.struct(*out["summary"].columns).alias("supported_eval"), _counts(out["counters"], "group").alias("status_counts"),
        _json_rows(out["unsupported"].orderBy("label")).scalar().alias("unsupported_or_out_of_scope"), F.array(*[F.lit(n) for n in names]).alias("class_names"),
    )
    sinks.write_report(report, f"{base}/upload_eval_report.json", mode)
