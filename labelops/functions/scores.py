"""Score vectors, routing bands and outcome tables as native columns; no shuffles."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bands:
    """Default production thresholds."""

    accept: float = 0.52
    reject: float = 0.01
    confidence: float = 0.85
    margin: float = 0.15

    def __post_init__(self):
        if not 0 <= self.reject < self.accept:
            raise ValueError("need 0 <= reject < accept")
        if not (0 <= self.confidence <= 1 and 0 <= self.margin <= 1):
            raise ValueError("confidence and margin must be in [0, 1]")


def safe_rate(n: Column, d: Column) -> Column:
    """n / d, 0.0 when the denominator is 0."""
    return F.coalesce(F.try_divide(n.cast("double"), d.cast("double")), F.lit(0.0))


def scores_ok(probs: Column, k: int) -> Column:
    return F.coalesce(F.size(probs) == k, F.lit(False))


def top_k(probs: Column, names: Sequence[str] | None = None, k: int = 3, classes: int | None = None) -> Column:
    """ARRAY<STRUCT<class_index, label, confidence>>, best first, lower index first on ties."""
    known = len(names) if names is not None else classes
    k = max(1, k if known is None else min(k, known))
    ordered = F.array_sort(F.transform(probs, lambda p, i: F.struct((-p).alias("s"), i.alias("i"))))
    labels = F.array(*[F.lit(n) for n in names]) if names is not None else None

    def entry(x: Column) -> Column:
        label = F.get(labels, x["i"]) if labels is not None else x["i"].cast("string")
        return F.struct(x["i"].alias("class_index"), label.alias("label"), (-x["s"]).alias("confidence"))

    return F.transform(F.slice(ordered, 1, k), entry)


def top2_margin(probs: Column, names: Sequence[str] | None = None) -> Column:
    """STRUCT<top1_label, top1_confidence, top2_label, top2_confidence, margin>."""

    def told(best: Column) -> Column:
        first, second = F.get(best, F.lit(0)), F.get(best, F.lit(1))
        return F.struct(
            first["label"].alias("top1_label"),
            first["confidence"].alias("top1_confidence"),
            second["label"].alias("top2_label"),
            second["confidence"].alias("top2_confidence"),
            (first["confidence"] - second["confidence"]).alias("margin"),
        )

    return F.get(F.transform(F.array(top_k(probs, names, 2)), told), F.lit(0))


def with_fallback(label: Column, confidence: Column, threshold: float, fallback: str) -> Column:
    unsure = confidence < threshold
    return F.struct(F.when(unsure, F.lit(fallback)).otherwise(label).alias("label"), unsure.alias("used_fallback"))


def route_two_stage(p: Column, label: Column, confidence: Column, gate: float = 0.5, floor: float = 0.6) -> Column:
    """STRUCT<route, predicted_label, confidence, low_confidence> of the gate-then-class router."""
    blocked = p < gate
    return F.struct(
        F.when(blocked, "stage_a_other").otherwise("stage_b_fruit").alias("route"),
        F.when(blocked, F.lit("other")).otherwise(label).alias("predicted_label"),
        F.when(blocked, 1.0 - p).otherwise(confidence).alias("confidence"),
        F.when(~blocked, confidence < floor).alias("low_confidence"),
    )


def route_eval(p: Column, confidence: Column, gate: float, floor: float, error: Column | None = None) -> Column:
    route = F.when(p < gate, "stage_a_other").when(confidence < floor, "low_confidence").otherwise("stage_b_supported")
    missing = p.isNull() | ((p >= gate) & confidence.isNull())
    if error is not None:
        missing = missing | error.isNotNull()
    return F.when(missing, "error").otherwise(route)


def route_stage_a(p: Column, cfg: Bands = Bands()) -> Column:
    return (
        F.when(p >= cfg.accept, "stage_a_fruit")
        .when(p <= cfg.reject, "stage_a_other")
        .otherwise("manual_review_stage_a_uncertain")
    )


def route_stage_b(confidence: Column, margin: Column, cfg: Bands = Bands()) -> Column:
    return (
        F.when(confidence < cfg.confidence, "manual_review_low_confidence")
        .when(margin < cfg.margin, "manual_review_ambiguous")
        .otherwise("stage_b_supported_auto_accept")
    )


def needs_class_model(group: Column, p: Column, cfg: Bands = Bands()) -> Column:
    """Rows for which the class model is run at all."""
    return ~group.isin("unsupported_v1", "unknown_label") & (p >= cfg.accept)


def final_route(
    group: Column, p: Column, confidence: Column, margin: Column, cfg: Bands = Bands(), error: Column | None = None
) -> Column:
    gate = route_stage_a(p, cfg)
    failed = p.isNull() if error is None else (error.isNotNull() | p.isNull())
    return (
        F.when(failed, "error")
        .when(group == "unsupported_v1", "manual_review_unsupported")
        .when(group == "unknown_label", "manual_review_unknown_label")
        .when(gate != "stage_a_fruit", gate)
        .when(confidence.isNull(), "error")
        .otherwise(route_stage_b(confidence, margin, cfg))
    )


def is_review(route: Column) -> Column:
    return route.startswith("manual_review")


def flow_outcome(status: Column, route: Column, truth: Column, predicted: Column) -> Column:
    """STRUCT<evaluation_status, correct, reason> of the single-threshold flow."""

    def row(result: str, correct: bool | None, reason: str) -> Column:
        return F.struct(
            F.lit(result).alias("evaluation_status"),
            F.lit(correct).cast("boolean").alias("correct"),
            F.lit(reason).alias("reason"),
        )

    accepted = route == "stage_b_supported"
    return (
        F.when(route == "error", row("error", None, "image_error"))
        .when(
            (status == "unknown_label") & (route == "low_confidence"),
            row("manual_review", None, "unknown_label_manual_review"),
        )
        .when(status == "unknown_label", row("unknown_label", None, "unknown_true_label"))
        .when(route == "low_confidence", row("manual_review", None, "low_confidence_manual_review"))
        .when(
            (route == "stage_a_other") & (status == "out_of_scope"),
            row("correct", True, "stage_a_correctly_blocked_other"),
        )
        .when(route == "stage_a_other", row("wrong", False, "stage_a_blocked_real_fruit"))
        .when(
            accepted & (status == "supported") & (predicted == truth),
            row("correct", True, "stage_b_correct_supported_class"),
        )
        .when(accepted & (status == "supported"), row("wrong", False, "stage_b_wrong_supported_class"))
        .when(
            accepted & (status == "out_of_scope"),
            row("wrong", False, "stage_a_false_pass_other_then_stage_b_accepted"),
        )
        .when(
            accepted & (status == "unsupported_v1"), row("wrong", False, "unsupported_v1_auto_accepted_as_supported")
        )
        .otherwise(row("unknown_label", None, "unhandled_case"))
    )


def production_outcome(group: Column, route: Column, truth: Column, predicted: Column) -> Column:
    """STRUCT<evaluation_result, reason, is_correct_flow, is_wrong_flow> of the banded flow."""

    def row(result: str, reason: str, right: bool = False, wrong: bool = False) -> Column:
        return F.struct(
            F.lit(result).alias("evaluation_result"),
            F.lit(reason).alias("reason"),
            F.lit(right).alias("is_correct_flow"),
            F.lit(wrong).alias("is_wrong_flow"),
        )

    accepted, review, blocked = route == "stage_b_supported_auto_accept", is_review(route), route == "stage_a_other"
    unsupported, outside = group == "unsupported_v1", group == "out_of_scope"
    supported, unknown = group == "supported", group == "unknown_label"
    return (
        F.when(route == "error", row("error", "image_error_or_unreadable"))
        .when(
            unsupported & (route == "manual_review_unsupported"),
            row("correct_flow", "unsupported_class_routed_to_manual_review", right=True),
        )
        .when(unsupported & accepted, row("wrong_flow", "unsupported_class_auto_accepted_as_supported", wrong=True))
        .when(unsupported, row("manual_review", "unsupported_class_manual_review", right=True))
        .when(outside & blocked, row("correct_flow", "out_of_scope_blocked_by_stage_a", right=True))
        .when(outside & review, row("acceptable_manual_review", "out_of_scope_sent_to_manual_review", right=True))
        .when(outside & accepted, row("wrong_flow", "out_of_scope_auto_accepted_as_supported", wrong=True))
        .when(outside, row("unknown_evaluation", "unhandled_out_of_scope_case"))
        .when(supported & review, row("manual_review", "supported_class_sent_to_manual_review"))
        .when(supported & blocked, row("wrong_flow", "supported_class_blocked_as_other_by_stage_a", wrong=True))
        .when(
            supported & accepted & (predicted == truth),
            row("correct_auto", "supported_class_auto_accepted_correctly", right=True),
        )
        .when(supported & accepted, row("wrong_auto", "supported_class_auto_accepted_wrong_class", wrong=True))
        .when(supported, row("unknown_evaluation", "unhandled_supported_case"))
        .when(unknown & review, row("manual_review", "unknown_label_sent_to_manual_review"))
        .when(unknown & accepted, row("unknown_evaluation", "unknown_label_auto_accepted"))
        .when(unknown, row("unknown_evaluation", "unknown_label_case"))
        .otherwise(row("unknown_evaluation", "unknown_group_case"))
    )
