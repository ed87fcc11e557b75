"""Files of the audits against the frames they come from."""

import csv
import json

import pytest

from labelops.lineage import stored_observed
from labelops.operators import audit
from labelops.plans import audit_files, flows
from tests.conftest import rows

NAMES = ["a", "b"]


@pytest.fixture
def scored(spark):
    data = [("1", "supported", "a", "a", 0.9, [0.95, 0.05]), ("2", "supported", "a", "a", 0.9, [0.05, 0.95]), ("3", "out_of_scope", None, "other", 0.0, None),
            ("4", "unsupported_v1", None, "mango", 0.9, [0.99, 0.01]), ("5", "unknown_label", None, "kiwi", None, None), ("6, \"x\"", "supported", "b", "b", 0.9, [0.5, 0.5])]
    return spark.createDataFrame(data * 1, "image_path string, group string, true_label string, normalized_label string, score double, probs array<double>").repartition(3)


def table(folder):
    out = []
    for p in sorted(folder.glob("part-*")):
        with p.open(newline="") as f:
            out += list(csv.DictReader(f))
    return out


def lines(folder):
    return [json.loads(x) for p in sorted(folder.glob("part-*")) for x in p.read_text().splitlines()]


def test_production_files(spark, scored, tmp_path):
    out = flows.audit_production(scored, NAMES, root=str(tmp_path))
    assert out["summary"].first() == audit.production_summary(out["rows"]).first()
    found = table(tmp_path / "upload_flow_predictions.csv")
    assert tuple(found[0]) == audit_files.PRODUCTION_FIELDS
    want = {r["image_path"]: r for r in out["rows"].collect()}
    assert {r["image_path"] for r in found} == set(want)
    for r in found:
        w = want[r["image_path"]]
        assert (r["final_route"], r["true_label"] or None, r["reason"]) == (w["final_route"], w["true_label"], w["reason"])
        assert r["stage_a_fruit_probability"] == ("" if w["score"] is None else str(w["score"]))
    classes = {r["label"]: r for r in table(tmp_path / "upload_flow_per_class_summary.csv")}
    assert {k: int(v["total"]) for k, v in classes.items()} == {r["label"]: r["total"] for r in out["classes"].collect()}
    assert [(r["true_label"], r["predicted_label"], json.loads(r["examples"])) for r in table(tmp_path / "upload_flow_confused_pairs.csv")] == [("a", "b", ["2"])]
    assert {r["image_path"] for r in table(tmp_path / "upload_flow_error_cases.csv")} == {r["image_path"] for r in out["error_cases"].collect()}
    (report,) = lines(tmp_path / "upload_flow_summary.json")
    summary = out["summary"].first().asDict()
    assert {k: report[k] for k in summary} == summary
    assert report["group_counts"] == {"out_of_scope": 1, "supported": 3, "unknown_label": 1, "unsupported_v1": 1}
    assert report["most_wrong_class"] == "a" and report["wrong_supported_by_class"] == {"a": 1} and report["thresholds"]["stage_b_margin_threshold"] == 0.15
    assert report["top_confused_pairs"] == [{"count": 1, "examples": ["2"], "predicted_label": "b", "true_label": "a"}]


def test_upload_files(spark, scored, tmp_path):
    out = flows.audit_uploads(scored, NAMES, root=str(tmp_path))
    assert out["summary"].first() == audit.flow_summary(out["rows"]).first()
    found = table(tmp_path / "upload_flow_predictions.csv")
    assert tuple(found[0]) == audit_files.UPLOAD_FIELDS and {(r["stage_a_threshold"], r["stage_b_threshold"]) for r in found} == {("0.5", "0.6")}
    as_json = {r["image_path"]: r for r in lines(tmp_path / "upload_flow_predictions.jsonl")}
    assert {p: r["route"] for p, r in as_json.items()} == {r["image_path"]: r["route"] for r in out["rows"].collect()} == {r["image_path"]: r["route"] for r in found}
    for r in found:
        assert json.loads(r["top_k"] or "null") == as_json[r["image_path"]].get("top_k")
    (report,) = lines(tmp_path / "upload_flow_report.json")
    assert report["summary"]["total_images"] == 6 and report["wrong_analysis"]["stage_b_confused_pairs"] == {"a->b": 1}
    assert report["unsupported_v1_auto_predictions"] == [{"count": 1, "label": "mango", "predicted_as": {"a": 1}}]
    assert {r["image_path"] for r in lines(tmp_path / "class_wrong.jsonl")} == {r["image_path"] for r in out["class_wrong"].collect()}


def test_supported_files(spark, scored, tmp_path):
    out = flows.eval_supported(scored.where("probs is not null"), NAMES, root=str(tmp_path))
    found = table(tmp_path / "upload_predictions.csv")
    assert tuple(found[0]) == audit_files.SUPPORTED_FIELDS
    assert {(r["image_path"], r["predicted_label"]) for r in found} == {(r["image_path"], r["predicted_label"]) for r in out["rows"].collect()}
    (report,) = lines(tmp_path / "upload_eval_report.json")
    assert report["supported_eval"]["evaluated"] == out["summary"].first()["evaluated"] and report["class_names"] == NAMES


def test_figures_of_nothing(spark, scored):
    table_, counts = stored_observed(scored.limit(0), *audit.production_counts()[:2])
    assert table_.count() == 0 and rows(counts) == [(0, 0)]
    many, counts = stored_observed(spark.range(100_000), *[audit.F.count(audit.F.lit(1)).alias("n"), audit.F.sum("id").alias("total")])
    assert rows(counts) == [(100_000, sum(range(100_000)))] and many.count() == 100_000
