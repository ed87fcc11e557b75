import numpy as np
import pytest
from pyspark.sql import functions as F

from labelops.operators import learn, metrics
from labelops.plans import flows
from tests.conftest import rows

RAW = ("Apple", "Mango_c", "ridged gourd", "bitter gourd", "jackfruit", "red mulberry", "other")


@pytest.fixture(scope="module")
def items(spark):
    """Profiled raw files: 40 per folder, a few of each failing one gate."""
    i = F.col("id")
    n = F.floor(i / len(RAW)).cast("int")
    df = spark.range(40 * len(RAW)).select(
        F.get(F.array(*[F.lit(r) for r in RAW]), (i % len(RAW)).cast("int")).alias("raw_class"),
        F.concat(F.lit("img "), n.cast("string"), F.when(n == 3, ".txt").otherwise(".jpg")).alias("file_name"),
        F.concat(F.lit("/raw/"), i.cast("string")).alias("path"),
        F.when(n == 5, -1).when(n == 6, 50).otherwise(320).alias("width"), F.lit(320).alias("height"),
        F.when(n == 7, 1.0).otherwise(500.0).alias("sharpness"),
        F.when(n == 9, F.xxhash64(i - len(RAW))).otherwise(F.xxhash64(i)).alias("phash"),
        F.sha2(i.cast("string"), 256).alias("content_hash"), F.lit(10).cast("bigint").alias("length"),
        F.timestamp_seconds(i).alias("mtime"),
    )
    return df


def test_clean_dataset(items):
    out = flows.clean_dataset(items)
    stats = {r["class"]: r for r in out.class_stats.collect()}
    assert set(stats) == {"apple", "mango", "gourd", "jackfruit_cempedak", "mulberry", "other"}
    assert stats["apple"]["skip_reasons"] == {"unsupported_extension": 1, "corrupted_image": 1, "image_too_small": 1, "blurry_image": 1, "duplicate_image": 1}
    assert (stats["gourd"]["raw_images"], stats["gourd"]["valid_images"]) == (80, 70)
    assert stats["gourd"]["source_raw_classes"] == ["bitter gourd", "ridged gourd"]
    assert out.kept.count() == 7 * 35 and out.kept.select("class", "file_name").distinct().count() == 7 * 35
    assert all(name.startswith("apple__img_") for (name,) in rows(out.kept.where("class = 'apple'"), "file_name"))


def test_unplanned_merge_is_an_error(items):
    extra = items.where("raw_class = 'Apple'").withColumn("raw_class", F.lit("apple_tao_9"))
    with pytest.raises(ValueError, match="unplanned_merge"):
        flows.clean_dataset(items.unionByName(extra))


def split_source(items):
    return flows.clean_dataset(items).kept.select("class", "file_name", "content_hash", "path", "length", "mtime")


def test_split_subset_supported_and_checks(spark, items, tmp_path):
    source = split_source(items)
    main = flows.split_dataset(source, root=str(tmp_path / "main"))
    total = {r["class"]: r["total"] for r in main.counts.collect()}
    assert total[None] == 245 and total["gourd"] == 70
    with pytest.raises(FileExistsError):
        flows.split_dataset(source, root=str(tmp_path / "main"))
    subset, counts = flows.build_subset(main.rows, str(tmp_path / "sub"))
    assert subset.where("class = 'other'").isEmpty() and counts.where("class is null").first()["total"] == 210
    names = sorted(r["class"] for r in subset.select("class").distinct().collect())
    checks = flows.validate_dataset(main.rows, subset, names)
    assert checks.count() == 2 and checks.where("not valid").isEmpty()
    with pytest.raises(ValueError, match="class order"):
        flows.validate_dataset(main.rows, subset, names[::-1])
    sup = flows.build_supported(subset, ("gourd", "mango"))
    assert sorted(r["class"] for r in sup.rows.select("class").distinct().collect()) == ["apple", "jackfruit_cempedak", "mulberry"]
    assert sup.unsupported_counts.where("class is null").first()["total"] == 105
    with pytest.raises(ValueError, match="unsupported class not in the source"):
        flows.build_supported(subset, ("gourd", "typo"))
    leaky = main.rows.unionByName(main.rows.where("split = 'train'").limit(1).withColumn("split", F.lit("val")))
    with pytest.raises(ValueError, match="not valid"):
        flows.validate_dataset(leaky, subset, names)


def test_ab_datasets(items):
    source = split_source(items)
    out = flows.ab_datasets(source, source.where("file_name not like '%_11.jpg'"))
    report = {r["class"]: r for r in out.report.collect()}
    assert report["apple"]["missing_in_b"] == 1 and report["gourd"]["missing_in_b"] == 2 and "other" not in report
    assert out.manifest.count() == out.a.count() == out.b.count() == 204
    with pytest.raises(ValueError, match="one side only"):
        flows.ab_datasets(source, source.where("class <> 'apple'"))


def test_clean_splits_and_views(items):
    i = F.col("n")
    df = items.select("*", F.regexp_extract("file_name", "[0-9]+", 0).cast("int").alias("n")).withColumn("class", F.col("raw_class")).withColumn(
        "split", F.when(i < 20, "train").when(i < 30, "val").otherwise("test"))
    accepted, small = flows.clean_splits(df)
    assert accepted.count() == 7 * 35 and small.count() == 0
    with pytest.raises(ValueError, match="split leak"):
        flows.clean_splits(df.withColumn("content_hash", F.when(i.isin(1, 25), F.lit("same")).otherwise(F.col("content_hash"))))
    views = {m: flows.label_views(accepted, m) for m in ("binary", "multiclass", "no_other")}
    assert sorted(r["label"] for r in views["binary"].select("label").distinct().collect()) == [0, 1]
    assert views["no_other"].select("label").distinct().count() == 6 and views["multiclass"].agg(F.max("label")).first()[0] == 6


def test_crop_audit_and_rebuild(spark, items, tmp_path, monkeypatch):
    crops = items.withColumn("class", F.lower("raw_class")).withColumn("bbox", F.expr("named_struct('x1', 60, 'y1', 60, 'x2', 260, 'y2', 260)")).withColumns(
        {"texture": F.lit(30.0), "contrast": F.lit(0.0), "edge_density": F.lit(0.0)})
    decisions, summary = flows.crop_audit(crops)
    total = summary.where("class is null").first()
    assert (total["total"], total["failed"], total["cropped"]) == (280, 7, 7 * 37)
    assert decisions.where("reason = 'image_too_small' and applied").isEmpty()
    for name in ("apple/a.jpg", "kiwi/b.png"):
        (tmp_path / "raw" / name).parent.mkdir(parents=True)
        (tmp_path / "raw" / name).write_bytes(b"x")
    paths = flows.RebuildPaths(str(tmp_path / "raw"), str(tmp_path / "m"), str(tmp_path / "s"), str(tmp_path / "r"))
    totals = flows.rebuild("preprocess", items, paths, crops.withColumn("class", F.replace("class", F.lit("_c"), F.lit("")))).first()
    assert totals["raw_images"] == 280 and totals["valid_images"] == 245
    assert flows.rebuild("crop", items, paths, crops).first()["raw_images"] == 0
    assert flows.rebuild("split", split_source(items), paths).count() == 2
    build = flows.build_subset

    def meddle(*args):
        (tmp_path / "raw" / "apple" / "new.jpg").write_bytes(b"y")
        return build(*args)

    monkeypatch.setattr(flows, "build_subset", meddle)
    with pytest.raises(ValueError, match="source changed"):
        flows.rebuild("split", split_source(items), paths, clean_output=True)
    with pytest.raises(ValueError, match="inside the source"):
        flows.RebuildPaths("/raw", "/raw/x", "/s", "/r")


def test_audits(spark):
    names = ["a", "b"]
    data = [("1", "supported", "a", "a", 0.9, [0.95, 0.05]), ("2", "supported", "a", "a", 0.9, [0.05, 0.95]), ("3", "out_of_scope", None, "other", 0.0, None),
            ("4", "unsupported_v1", None, "mango", 0.9, [0.99, 0.01]), ("5", "unknown_label", None, "kiwi", None, None)]
    df = spark.createDataFrame(data, "image_path string, group string, true_label string, normalized_label string, score double, probs array<double>")
    out = flows.audit_production(df, names)
    s = out["summary"].first()
    assert (s["total_images"], s["supported_auto_accuracy"], s["out_of_scope_block_or_review_rate"], s["unknown_label_count"]) == (5, 0.5, 1.0, 1)
    assert rows(out["confused_pairs"]) == [("a", "b", 1, ["2"])] and out["error_cases"].count() == 2
    flow = flows.audit_uploads(df, names)
    assert flow["summary"].first()["error_count"] == 1 and flow["errors"].count() == 1 and flow["class_wrong"].count() == 1
    assert rows(flow["unsupported"]) == [("mango", 1, {"a": 1})]
    sup = flows.eval_supported(df.where("probs is not null"), names)
    assert sup["summary"].first()["accuracy"] == 0.5 and rows(sup["unsupported"], "label", "count") == [("mango", 1)]


def test_analyze_confusion(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1)], "true_idx int, pred_idx int")
    out = flows.analyze_confusion(["a", "b"], df)
    again = flows.analyze_confusion(["a", "b"], matrix=out["matrix"])
    assert out["summary"].first() == again["summary"].first() and rows(out["pairs"], "first", "second", "n") == [("a", "b", 1)]


def double_first():
    return lambda batch: batch[:, 0].astype(float) * 2


def two_classes():
    def predict(batch):
        if (batch[:, 0] < 0.25).any():
            raise AssertionError("class model ran on a blocked row")
        return np.stack([batch[:, 0], 1 - batch[:, 0]], axis=1).astype(float)

    return predict


def test_score_runs_the_class_model_only_after_the_gate(spark):
    df = spark.createDataFrame([(i, [i / 10.0, 0.5]) for i in range(8)], "id int, features array<double>")
    out = {r["id"]: r for r in learn.score(df, double_first, two_classes, 0.5, dim=2).collect()}
    assert len(out) == 8 and out[1]["probs"] is None and out[4]["score"] == pytest.approx(0.8) and out[4]["probs"] == pytest.approx([0.4, 0.6])


def test_fits(spark):
    rng = np.random.default_rng(0)
    data = [(i, i % 3, [float(x) for x in rng.normal(0, 0.3, 3) + np.eye(3)[i % 3]], ("train", "train", "val", "test")[i // 3 % 4]) for i in range(240)]
    df = spark.createDataFrame(data, "id int, label int, features array<double>, split string").withColumn("truth", (F.col("label") > 0).cast("int"))
    gate = learn.fit_gate(df, max_iter=20)
    assert gate.test.first()["accuracy"] > 0.85 and 0.3 <= gate.threshold <= 0.81
    model = learn.fit_classes(df, 3, max_iter=20)
    assert model.summary.first()["accuracy"] > 0.85 and model.matrix.count() == 9
    scores = learn.centroid_scores(df, learn.centroids(df, 3, features="features"), 3, "features")
    hit = scores.select((metrics.prediction(F.col("probs")) == F.col("label")).cast("int").alias("h")).agg(F.avg("h")).first()[0]
    assert hit > 0.9 and scores.where(F.abs(F.aggregate("probs", F.lit(0.0), lambda a, b: a + b) - 1) > 1e-9).isEmpty()
