"""Upload-audit summaries: one partial aggregate each over the routed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelops.functions.scores import is_review, safe_rate
from labelops.operators.metrics import class_metrics, confusion, summary_metrics
from labelops.operators.ranking import first_rows

AUTO = "stage_b_supported_auto_accept"


def counted(df: DataFrame, *cols: str) -> DataFrame:
    """Long-form counters: (counter, value, n) for each column, in one pass over the rows."""
    pre = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    pairs = F.array(*[F.struct(F.lit(c).alias("counter"), F.col(c).cast("string").alias("value")) for c in cols])
    return pre.select(F.inline(pairs), "_n").groupBy("counter", "value").agg(F.sum("_n").alias("n"))


def most_common(df: DataFrame, col: str, pos: str) -> DataFrame:
    """Values by count, ties by first appearance."""
    return (
        df.groupBy(col)
        .agg(F.count(F.lit(1)).alias("n"), F.min(pos).alias("first_seen"))
        .orderBy(F.col("n").desc(), "first_seen", col)
    )


def most_common_map(df: DataFrame, key: str, n: str = "n") -> Column:
    """Aggregate: MAP key -> n of a small counter table, largest first."""
    entries = F.array_sort(F.collect_list(F.struct((-F.col(n)).alias("o"), F.col(key).alias("k"))))
    return F.map_from_entries(F.transform(entries, lambda e: F.struct(e["k"], (-e["o"]).alias("n"))))


def upload_class_summary(rows: DataFrame) -> DataFrame:
    """Per true (or normalised) label: totals, automatic decisions, reviews, blocks, errors."""
    route, result = F.col("final_route"), F.col("evaluation_result")
    auto = route == AUTO
    out = rows.groupBy(F.coalesce("true_label", "normalized_label").alias("label")).agg(
        F.min("group").alias("group"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(auto).alias("auto_accepted"),
        F.count_if(auto & (result == "correct_auto")).alias("auto_correct"),
        F.count_if(auto & result.isin("wrong_auto", "wrong_flow")).alias("auto_wrong"),
        F.count_if(is_review(route)).alias("manual_review"),
        F.count_if(route == "stage_a_other").alias("stage_a_other"),
        F.count_if(route == "error").alias("error"),
    )
    return out.withColumn(
        "auto_accuracy",
        F.when(F.col("auto_accepted") > 0, F.col("auto_correct") / F.col("auto_accepted")),
    )


def confused_pairs(rows: DataFrame, order: Sequence[str] = ("image_path",), examples: int = 5) -> DataFrame:
    """Directed wrong pairs among accepted supported rows with up to 5 example paths in input order."""
    wrong = rows.where(
        (F.col("final_route") == AUTO) & (F.col("group") == "supported")
        & (F.col("true_label") != F.col("stage_b_top1_label"))
    ).select("true_label", F.col("stage_b_top1_label").alias("predicted_label"), *dict.fromkeys([*order, "image_path"]))
    pair = ["true_label", "predicted_label"]
    counts = wrong.groupBy(*pair).agg(F.count(F.lit(1)).alias("count"))
    shown = (
        first_rows(wrong, pair, list(order), examples)
        .groupBy(*pair)
        .agg(F.array_sort(F.collect_list(F.struct(*order, F.col("image_path").alias("_path")))).alias("_rows"))
    )
    paths = F.transform("_rows", lambda s: s["_path"]).alias("examples")
    return counts.join(shown, pair).orderBy(F.col("count").desc(), F.col("_rows")[0]).select(*pair, "count", paths)


def production_counts() -> list[Column]:
    """The counts of the banded flow, as aggregates over its rows."""
    group, route, result = F.col("group"), F.col("final_route"), F.col("evaluation_result")
    auto, review = route == AUTO, is_review(route)
    supported, unsupported, outside = group == "supported", group == "unsupported_v1", group == "out_of_scope"
    return [
        F.count(F.lit(1)).alias("total_images"),
        F.count_if(supported).alias("supported_count"),
        F.count_if(unsupported).alias("unsupported_v1_count"),
        F.count_if(outside).alias("out_of_scope_count"),
        F.count_if(group == "unknown_label").alias("unknown_label_count"),
        F.count_if(auto).alias("auto_accepted_count"),
        F.count_if(review).alias("manual_review_count"),
        F.count_if(supported & auto).alias("supported_auto_count"),
        F.count_if(supported & auto & (result == "correct_auto")).alias("supported_auto_correct_count"),
        F.count_if(supported & review).alias("supported_manual_review_count"),
        F.count_if(supported & (route == "stage_a_other")).alias("stage_a_blocked_supported_wrong_count"),
        F.count_if(supported & auto & (result == "wrong_auto")).alias("stage_b_wrong_supported_count"),
        F.count_if(unsupported & (route == "manual_review_unsupported")).alias("_unsupported_ok"),
        F.count_if(outside & ((route == "stage_a_other") | review)).alias("_outside_ok"),
    ]


def production_rates(counts: DataFrame) -> DataFrame:
    """The row of counts with its rates."""

    def rate(a: str, b: str) -> Column:
        return safe_rate(F.col(a), F.col(b))

    return (
        counts.withColumn("manual_review_rate", rate("manual_review_count", "total_images"))
        .withColumn("supported_auto_accuracy", rate("supported_auto_correct_count", "supported_auto_count"))
        .withColumn("supported_auto_coverage", rate("supported_auto_count", "supported_count"))
        .withColumn("unsupported_correct_manual_review_rate", rate("_unsupported_ok", "unsupported_v1_count"))
        .withColumn("out_of_scope_block_or_review_rate", rate("_outside_ok", "out_of_scope_count"))
        .drop("_unsupported_ok", "_outside_ok")
    )


def production_summary(rows: DataFrame) -> DataFrame:
    """One row of production figures of the banded flow."""
    return production_rates(rows.agg(*production_counts()))


def wrong_supported_by_class(rows: DataFrame, pos: str = "image_path") -> DataFrame:
    """Wrongly accepted supported rows per true label; the first row is the worst class."""
    return most_common(rows.where(F.col("evaluation_result") == "wrong_auto"), "true_label", pos)


def flow_counts() -> list[Column]:
    """The counts of the single-threshold flow, as aggregates over its rows."""
    states = ("correct", "manual_review", "wrong", "error", "unknown_label")
    return [F.count(F.lit(1)).alias("total_images"), *[F.count_if(F.col("evaluation_status") == s).alias(f"{s}_count") for s in states]]


def flow_rates(counts: DataFrame) -> DataFrame:
    """The row of counts with its rates."""
    n = counts.withColumn("auto_resolved_total", F.col("correct_count") + F.col("wrong_count"))
    return (
        n.withColumn("auto_resolved_accuracy", safe_rate(F.col("correct_count"), F.col("auto_resolved_total")))
        .withColumn("overall_correct_rate", safe_rate(F.col("correct_count"), F.col("total_images")))
        .withColumn("manual_review_rate", safe_rate(F.col("manual_review_count"), F.col("total_images")))
        .withColumn("wrong_rate", safe_rate(F.col("wrong_count"), F.col("total_images")))
    )


def flow_summary(rows: DataFrame) -> DataFrame:
    """One row of figures of the single-threshold flow."""
    return flow_rates(rows.agg(*flow_counts()))


def wrong_analysis(rows: DataFrame) -> DataFrame:
    """Wrong rows counted by true label, by predicted label and by accepted supported pair.

    The rows are first reduced to (label, prediction) counts; the three views are taken from those."""
    truth = F.coalesce("true_label", "normalized_label")
    pair = (F.col("route") == "stage_b_supported") & (F.col("group") == "supported")
    pre = (
        rows.where(F.col("evaluation_status") == "wrong")
        .groupBy(truth.alias("t"), F.col("predicted_label").alias("p"), pair.alias("is_pair"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    views = F.array(
        F.struct(F.lit("true_label").alias("view"), F.col("t").alias("label")),
        F.struct(F.lit("predicted_label").alias("view"), F.col("p").alias("label")),
        F.struct(
            F.lit("pair").alias("view"), F.when(F.col("is_pair"), F.concat("t", F.lit("->"), "p")).alias("label")
        ),
    )
    return (
        pre.select(F.inline(views), "_n").where(F.col("label").isNotNull()).groupBy("view", "label").agg(F.sum("_n").alias("n"))
    )


def unsupported_predictions(rows: DataFrame, keep: Column | None = None) -> DataFrame:
    """What rows without a usable label were predicted as: label, count and MAP prediction -> count."""
    if keep is None:
        keep = (F.col("route") == "stage_b_supported") & (F.col("group") == "unsupported_v1")
    pre = (
        rows.where(keep & F.col("predicted_label").isNotNull())
        .groupBy(F.col("normalized_label").alias("label"), "predicted_label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return pre.groupBy("label").agg(
        F.sum("n").alias("count"), most_common_map(pre, "predicted_label").alias("predicted_as")
    )


def label_report(rows: DataFrame, names: Sequence[str], keep: Column) -> tuple[DataFrame, DataFrame]:
    """Per-class metrics and summary over the kept rows with labels in ``names``."""
    order = F.create_map(*[F.lit(x) for i, n in enumerate(names) for x in (n, i)])
    indexed = rows.where(keep).select(
        F.try_element_at(order, F.col("true_label")).alias("true_idx"),
        F.try_element_at(order, F.col("predicted_label")).alias("pred_idx"),
    ).where(F.col("true_idx").isNotNull() & F.col("pred_idx").isNotNull())
    metrics = class_metrics(confusion(indexed, len(names)))
    return metrics, summary_metrics(metrics)


def accepted_report(rows: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Metrics over accepted supported rows only."""
    return label_report(rows, names, (F.col("group") == "supported") & (F.col("route") == "stage_b_supported"))


def supported_eval(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row: evaluated, correct, incorrect, accuracy, macro f1 and macro recall of mapped rows."""
    per_class, _ = label_report(rows, names, F.col("true_label").isNotNull())
    n, hits = F.sum("support"), F.sum("true_positives")
    return per_class.agg(
        n.alias("evaluated"), hits.alias("correct"), (n - hits).alias("incorrect"), safe_rate(hits, n).alias("accuracy"),
        F.avg("f1").alias("macro_f1"), F.avg("recall").alias("macro_recall"),
    )


def outcome_slices(rows: DataFrame) -> dict[str, DataFrame]:
    """Filtered views over one routed frame; persist it before reading several of them."""
    cols = set(rows.columns)
    out = {}
    if "evaluation_result" in cols:
        out["error_cases"] = rows.where(F.col("evaluation_result").isin("wrong_auto", "wrong_flow", "error"))
    if "evaluation_status" in cols:
        wrong, route = F.col("evaluation_status") == "wrong", F.col("route")
        out["gate_blocked_wrong"] = rows.where((route == "stage_a_other") & wrong)
        out["class_wrong"] = rows.where((F.col("group") == "supported") & (route == "stage_b_supported") & wrong)
        out["review"] = rows.where(route == "low_confidence")
        out["errors"] = rows.where(route == "error")
    return out
