import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from labelops.operators import audit, labels, metrics, threshold
from tests.conftest import rows


def matrix(spark, m):
    return spark.createDataFrame([(i, j, n) for i, row in enumerate(m) for j, n in enumerate(row)], "true_idx int, pred_idx int, n bigint")


def test_golden_confusion_metrics(spark):
    cm = matrix(spark, [[8, 2, 0], [1, 5, 4], [0, 0, 0]])
    per = metrics.with_names(metrics.class_metrics(cm), ["a", "b", "c"], "class_idx", "class_name")
    out = {r["class_idx"]: [round(r[c], 6) for c in ("precision", "recall", "f1")] for r in per.collect()}
    assert out == {0: [0.888889, 0.8, 0.842105], 1: [0.714286, 0.5, 0.588235], 2: [0.0, 0.0, 0.0]}
    s = metrics.summary_metrics(per).first()
    got = [round(s[c], 6) for c in ("accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_precision", "weighted_recall", "weighted_f1")]
    assert got == [0.65, 0.534392, 0.433333, 0.47678, 0.801587, 0.65, 0.71517]
    assert [r["class_idx"] for r in metrics.weak_classes(per, "recall").collect()] == [2, 1]
    assert sorted(r["class_idx"] for r in metrics.weak_classes(per).collect()) == [1, 2]


def test_dense_matrix_and_label_check(spark):
    df = spark.createDataFrame([(0, 0), (0, 2), (2, 2)], "true_idx int, pred_idx int")
    cm = metrics.confusion(df, 3)
    assert cm.count() == 9 and cm.agg(F.sum("n")).first()[0] == 3
    with pytest.raises(PySparkException, match="not a label"):
        metrics.confusion(df, 2).collect()
    with pytest.raises(PySparkException, match="not a label"):
        spark.createDataFrame([(1.5,)], "x double").select(labels.checked_label(F.col("x"), 3)).collect()


def test_pair_ties_sort_names_descending(spark):
    cm = matrix(spark, [[5, 2, 1], [1, 5, 3], [2, 0, 5]])
    out = rows(metrics.confusion_pairs(cm, ["a", "b", "c"]), "first", "second", "n")
    assert out == [("b", "c", 3), ("a", "c", 3), ("a", "b", 3)]


def test_top_confusion_ties(spark):
    cm = matrix(spark, [[5, 2, 2], [0, 1, 0], [0, 0, 1]])
    assert rows(metrics.top_confusions(cm, 1), "true_idx", "pred_idx") == [(0, 1)]
    assert rows(metrics.top_confusions(cm, 1, "desc"), "true_idx", "pred_idx") == [(0, 2)]


def test_threshold_golden(spark):
    df = spark.createDataFrame(list(zip([0, 0, 1, 1, 1], [0.1, 0.55, 0.52, 0.7, 0.9])), "truth int, score double")
    m = threshold.binary_metrics(df, 0.53).first()
    assert (m["tn"], m["fp"], m["fn"], m["tp"]) == (1, 1, 1, 2) and round(m["macro_f1"], 6) == 0.583333 and m["min_recall"] == 0.5
    sweep = threshold.threshold_sweep(df)
    assert sweep.count() == 51 and sweep.agg(F.max("threshold")).first()[0] == 0.8000000000000005
    best = threshold.pick_threshold(sweep).first()
    assert best["threshold"] == 0.5500000000000003 and not best["feasible"] and (best["tn"], best["fp"], best["fn"], best["tp"]) == (2, 0, 1, 2)
    for t in (0.3, 0.3 + 22 * (0.31 - 0.3), 0.8000000000000005):
        one = threshold.binary_metrics(df, t).select("tn", "fp", "fn", "tp").first()
        same = sweep.where(F.abs(F.col("threshold") - t) < 1e-12).select("tn", "fp", "fn", "tp").first()
        assert one == same


def test_sweep_on_grid_edges(spark):
    grid = threshold.Sweep().grid
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(grid)] + [(1, 0.0), (0, 1.0)], "truth int, score double")
    got = {r["threshold"]: (r["tp"], r["fp"]) for r in threshold.threshold_sweep(df).collect()}
    data = [(i % 2, v) for i, v in enumerate(grid)] + [(1, 0.0), (0, 1.0)]
    assert got == {t: (sum(y == 1 and v >= t for y, v in data), sum(y == 0 and v >= t for y, v in data)) for t in grid}


def test_class_weights(spark):
    df = spark.range(100).select(F.when(F.col("id") < 10, "a").when(F.col("id") < 40, "b").otherwise("c").alias("class"))
    assert {r["class"]: round(r["weight"], 6) for r in labels.class_weights(df).collect()} == {"a": 3.333333, "b": 1.111111, "c": 0.555556}
    assert {r["class"]: round(r["weight"], 6) for r in labels.class_weights(df, clip=(0.8, 1.2)).collect()} == {"a": 1.2, "b": 1.111111, "c": 0.8}
    two = spark.range(100).select((F.col("id") >= 20).cast("int").alias("class"))
    assert {r["class"]: r["weight"] for r in labels.class_weights(two, classes=2).collect()} == {0: 2.5, 1: 0.625}
    with pytest.raises(PySparkException, match="expected 3 classes"):
        labels.class_weights(two, classes=3).collect()


def test_most_common_and_summary_rates(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("a", 3), ("b", 4), ("c", 5)], "v string, pos int")
    assert rows(audit.most_common(df, "v", "pos"), "v", "n") == [("b", 2), ("a", 2), ("c", 1)]
    empty = spark.createDataFrame([], "evaluation_status string")
    assert audit.flow_summary(empty).first()["auto_resolved_accuracy"] == 0.0


def test_published_run_comparison(spark):
    from labelops.operators import runs

    cols = "run string, test_accuracy double, macro_precision double, macro_recall double, macro_f1 double, weighted_f1 double"
    df = spark.createDataFrame([("new", 0.808891, 0.869927, 0.793904, 0.802252, 0.814055), ("old", 0.750307, 0.7818, 0.7234, 0.7113, 0.7417)], cols)
    out = {r["metric"]: round(r["delta"], 4) for r in runs.compare_runs(df, "new", "old").collect()}
    assert out == {"test_accuracy": 0.0586, "macro_precision": 0.0881, "macro_recall": 0.0705, "macro_f1": 0.0910, "weighted_f1": 0.0724}
    assert runs.best_run(df).first()["run"] == "new"


def test_published_upload_audit(spark):
    """159 uploads, 90 accepted (89 supported, 16 of them wrong), 66 reviewed, one supported row blocked."""
    auto = "stage_b_supported_auto_accept"
    groups = [(73, "supported", auto, "correct_auto"), (16, "supported", auto, "wrong_auto"), (1, "out_of_scope", auto, "wrong_flow"),
              (66, "supported", "manual_review_low_confidence", "manual_review"), (1, "supported", "stage_a_other", "wrong_flow"), (2, "out_of_scope", "stage_a_other", "correct_flow")]
    data = [(g, r, e) for n, g, r, e in groups for _ in range(n)]
    s = audit.production_summary(spark.createDataFrame(data, "group string, final_route string, evaluation_result string")).first()
    assert (s["total_images"], s["auto_accepted_count"], s["stage_b_wrong_supported_count"], s["stage_a_blocked_supported_wrong_count"]) == (159, 90, 16, 1)
    assert round(s["manual_review_rate"], 4) == 0.4151 and round(s["supported_auto_accuracy"], 4) == 0.8202
