import json
import os
import struct
import zlib

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from labelops.operators import images, metrics, runs, threshold, validate
from labelops.sources import readers, scans, sinks
from tests.conftest import rows


def png(path, pixels):
    """Write an 8-bit PNG from an H x W (x C) array."""
    pixels = np.asarray(pixels, np.uint8)
    if pixels.ndim == 2:
        pixels = pixels[:, :, None]
    h, w, c = pixels.shape
    kind = {1: 0, 3: 2, 4: 6}[c]
    raw = b"".join(b"\0" + pixels[y].tobytes() for y in range(h))

    def chunk(tag, data):
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data))

    path.parent.mkdir(parents=True, exist_ok=True)
    head = struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def noise(seed, h, w, c):
    return np.random.default_rng(seed).integers(0, 256, (h, w, c), np.uint8)


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "raw"
    png(root / "Bell Pepper" / "a b+1.PNG", noise(1, 40, 60, 3))
    png(root / "Bell Pepper" / "flat.png", np.full((40, 40, 3), 77))
    png(root / "mango_c" / "alpha.png", noise(2, 32, 32, 4))
    png(root / "mango_c" / "gray.png", noise(3, 64, 32, 1))
    (root / "mango_c" / "broken.jpg").write_bytes(b"0123456789")
    (root / "mango_c" / "note.txt").write_text("x")
    (root / "mango_c" / ".hidden.png").write_bytes(b"x")
    png(root / "mango_c" / "deep" / "inside.png", noise(4, 8, 8, 3))
    return root


def test_labelled_scans(spark, tree):
    out = scans.scan_labelled(spark, str(tree), content_hash=True)
    assert sorted(rows(out, "class", "file_name")) == [("Bell Pepper", "a b+1.PNG"), ("Bell Pepper", "flat.png"), ("mango_c", "alpha.png"), ("mango_c", "broken.jpg"), ("mango_c", "gray.png")]
    assert out.where("length(content_hash) <> 64").isEmpty()
    everything = scans.scan_labelled(spark, str(tree), keep_unsupported=True)
    assert ("mango_c", "note.txt") in rows(everything, "class", "file_name") and everything.count() == 6
    assert [r["file_name"] for r in scans.stable_order(out.where("class = 'mango_c'"), "file_name").collect()] == ["alpha.png", "broken.jpg", "gray.png"]
    uploads = scans.scan_uploads(spark, str(tree))
    assert uploads.count() == 6 and {r["raw_label"] for r in uploads.collect()} == {"Bell Pepper", "mango_c"}
    snap = validate.snapshot(everything)
    assert snap.first()["file_count"] == 6
    validate.assert_unchanged(snap, validate.snapshot(everything.repartition(3)))
    with pytest.raises(ValueError):
        validate.assert_unchanged(snap, validate.snapshot(out))


def test_split_scan(spark, tmp_path):
    for split, cls, name in (("train", "a", "1.jpg"), ("train", "b", "2.jpg"), ("val", "a", "3.jpg"), ("extra", "a", "4.jpg")):
        p = tmp_path / split / cls / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(name.encode())
    out = scans.scan_splits(spark, str(tmp_path))
    assert sorted(rows(out, "split", "class", "file_name")) == [("train", "a", "1.jpg"), ("train", "b", "2.jpg"), ("val", "a", "3.jpg")]
    listing = scans.split_listing(out)
    assert {(r["split"], r["class"]): r["files"] for r in listing.collect()} == {("train", "a"): 1, ("train", "b"): 1, ("train", None): 2, ("val", "a"): 1, ("val", None): 1}


def test_image_profile(spark, tree):
    files = scans.scan_labelled(spark, str(tree), content_hash=True)
    pixels = scans.scan_images(spark, str(tree))
    profile = {r["file_name"]: r for r in images.image_profile(pixels, files).collect()}
    assert (profile["a b+1.PNG"]["width"], profile["a b+1.PNG"]["height"], profile["a b+1.PNG"]["channels"]) == (60, 40, 3)
    assert profile["flat.png"]["sharpness"] == 0.0 and profile["broken.jpg"]["width"] == -1 and profile["broken.jpg"]["phash"] is None
    assert profile["gray.png"]["channels"] == 1 and profile["alpha.png"]["channels"] == 4
    reasons = {r["path"].rsplit("/", 1)[1]: r["reason"] for r in pixels.collect()}
    assert reasons["broken.jpg"] == "corrupted_image" and reasons["gray.png"] is None
    rgb = {r["path"].rsplit("/", 1)[1]: r["rgb"] for r in images.to_rgb(pixels).collect()}
    assert bytes(rgb["a b+1.PNG"]) == noise(1, 40, 60, 3).tobytes()
    assert bytes(rgb["gray.png"]) == np.repeat(noise(3, 64, 32, 1), 3, axis=2).tobytes() and rgb["broken.jpg"] is None
    a = noise(2, 32, 32, 4).astype(float)
    assert np.abs(np.frombuffer(rgb["alpha.png"], np.uint8).reshape(32, 32, 3) - a[:, :, :3] * a[:, :, 3:] / 255).max() <= 1


def test_pixel_functions():
    lum = np.arange(30).reshape(5, 6) ** 2 % 17
    lap = np.zeros((5, 6))
    mirror = lambda i, n: -i if i < 0 else 2 * n - 2 - i if i >= n else i
    for y in range(5):
        for x in range(6):
            near = [lum[mirror(y + dy, 5), mirror(x + dx, 6)] for dy, dx in ((0, 1), (0, -1), (1, 0), (-1, 0))]
            lap[y, x] = sum(near) - 4 * lum[y, x]
    assert images.laplacian_variance(lum) == pytest.approx(lap.var())
    assert images.gray(np.full((1, 1, 3), 255, np.uint8))[0, 0] == 255
    big = np.kron(noise(5, 32, 32, 1)[:, :, 0], np.ones((4, 4)))
    assert images.letterboxed(big) == pytest.approx(noise(5, 32, 32, 1)[:, :, 0])
    assert images.dct_hash(big) == images.dct_hash(noise(5, 32, 32, 1)[:, :, 0].astype(float))
    wide = images.letterboxed(np.full((10, 40), 9.0))
    assert wide[:12].max() == 0 and wide[12:20].min() == pytest.approx(9.0)


def test_pixels_and_reason_from_one_reading(spark, tree):
    """Every file is opened and decoded once, and no row is moved."""
    from labelops.plans import file_queries

    found = images.to_rgb(scans.scan_images(spark, str(tree)), "reason")
    got = {r["path"].rsplit("/", 1)[1]: (r["width"], r["reason"]) for r in found.collect()}
    assert got["broken.jpg"] == (-1, "corrupted_image") and got["gray.png"] == (32, None)
    if os.path.isdir("/root/testdata/sf0.001"):
        plan = file_queries.scan_images(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [image") == 1 and "Join" not in plan


def test_files_of_the_rebuild_come_from_one_reading(spark, monkeypatch):
    """Texts are not joined to their own rows, and their files are dealt over all cores in several turns."""
    from labelops.plans import file_queries

    seen = []

    def stop(rows, root):
        seen.append(rows)
        raise InterruptedError

    monkeypatch.setattr(file_queries.folders, "write_files", stop)
    if os.path.isdir("/root/testdata/sf0.001"):
        with pytest.raises(InterruptedError):
            file_queries.flow_rebuild(spark, "/root/testdata/sf0.001")
        assert "Join" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
        assert seen[0].rdd.getNumPartitions() > spark.sparkContext.defaultParallelism


def test_hash_of_a_tie_at_the_median():
    """Coefficients (4, 0) and (0, 4) are equal but for the last digit, and are the two in the middle; the value is that of the SQL."""
    pixels = bytes.fromhex(
        "956715454a6865a955c5531922c689b2a0a5823a3d5c801117bf6eaf404f8a814dfaab6b691ba9ecb33c8086ffc1a464617a3e70ebb60c26c37a23c546553ef2"
    )
    assert images.dct_hash(np.frombuffer(pixels, np.uint8).reshape(8, 8).astype(np.int64)) == -5754409983586795679


def test_color_contrast(spark, tmp_path):
    pixels = np.zeros((100, 100, 3), np.uint8)
    pixels[30:70, 30:70] = (30, 40, 0)
    png(tmp_path / "i" / "x.png", pixels)
    df = scans.scan_images(spark, str(tmp_path / "i")).withColumn("bbox", F.expr("named_struct('x1', 30, 'y1', 30, 'x2', 70, 'y2', 70)"))
    assert images.color_contrast(df).first()["contrast"] == pytest.approx(50.0)
    assert images.color_contrast(df.withColumn("bbox", F.expr("cast(null as struct<x1:int,y1:int,x2:int,y2:int>)"))).first()["contrast"] == 0.0


def test_class_lists_and_manifests(spark, tmp_path):
    (tmp_path / "a.json").write_text('["b ", "a"]')
    (tmp_path / "b.json").write_text('{"class_names": ["b", "a"], "image_size": [320, 320]}')
    (tmp_path / "c.txt").write_text("b\n\n a \n")
    for f in ("a.json", "b.json", "c.txt"):
        assert sorted(rows(readers.read_class_names(spark, str(tmp_path / f)))) == [(0, "b"), (1, "a")]
    (tmp_path / "bad.txt").write_text("a\na\n")
    (tmp_path / "blank.json").write_text('["a", " "]')
    (tmp_path / "other.json").write_text('{"class_names": ["a", "other"]}')
    for f, word in (("bad.txt", "repeated"), ("blank.json", "blank")):
        with pytest.raises(PySparkException, match=word):
            readers.read_class_names(spark, str(tmp_path / f)).collect()
    assert readers.read_manifest(spark, str(tmp_path / "b.json")).first()["class_names"] == ["b", "a"]
    with pytest.raises(PySparkException, match="forbidden"):
        readers.read_manifest(spark, str(tmp_path / "other.json")).collect()
    (tmp_path / "w.json").write_text('{"weak_classes": [" Apple", ""]}')
    assert rows(readers.read_weak_classes(spark, str(tmp_path / "w.json"))) == [("apple",)]


REPORT = "              precision    recall  f1-score   support\n\n    accuracy                         0.8100       500\n   macro avg     0.8700    0.7900    0.8000       500\nweighted avg     0.8300    0.8100    0.8140       500\n"


def test_runs(spark, tmp_path):
    for run, f1, hist in (("r1", "0.9", {"stage2": {"loss": [2.0], "val_loss": [1.5], "val_accuracy": [0.4]}, "config": {"input_shape": [224, 224, 3]}, "extra": {"loss": [1.0]},
                                         "stage1": {"loss": [4.0, 3.0], "val_loss": [2.5], "accuracy": [0.1, 0.2]}, "note": 5}),
                          ("r2", "0.7", {"stage1": {"loss": [1.0], "val_loss": [1.5]}, "stage2": {"loss": [1.0], "val_loss": [1.5]}})):
        d = tmp_path / run
        d.mkdir()
        (d / "history.json").write_text(json.dumps(hist))
        (d / "test_results.txt").write_text(f"selected_stage: stage2\ntest_accuracy_reference_only: 0.75\nmacro_f1: {f1}\nnote: a: b\n")
        (d / "classification_report.txt").write_text(REPORT)
    from labelops.plans.flows import compare_training_runs

    hist = readers.read_history(spark, str(tmp_path / "r1" / "history.json"))
    got = sorted((r["stage_pos"], r["stage"], r["i"], r["loss"], r["val_loss"]) for r in hist.collect())
    assert got == [(0, "stage1", 0, 4.0, 2.5), (0, "stage1", 1, 3.0, None), (1, "stage2", 0, 2.0, 1.5), (2, "extra", 0, 1.0, None)]
    assert sorted(rows(runs.epoch_index(hist), "stage", "epoch")) == [("extra", 4), ("stage1", 1), ("stage1", 2), ("stage2", 3)]
    out = compare_training_runs(spark, str(tmp_path))
    table = {r["run"].rsplit("/", 1)[1]: r for r in out["rows"].collect()}
    assert table["r1"]["test_accuracy"] == 0.75 and table["r1"]["macro_f1"] == 0.9 and table["r1"]["macro_precision"] == 0.87 and table["r1"]["total_epochs"] == 4
    assert out["best"].first()["run"].endswith("r1")
    assert {r["run"].rsplit("/", 1)[1]: r["stage"] for r in out["stages"].collect()} == {"r1": "stage2", "r2": "stage2"}
    configs = readers.read_run_configs(spark, str(tmp_path / "*" / "history.json"))
    assert {r["run"].rsplit("/", 1)[1]: r["f"] for r in configs.select("run", runs.is_family(F.col("model_path"), F.col("input_shape")).alias("f")).collect()} == {"r1": True, "r2": False}
    delta = {r["metric"]: r["delta"] for r in runs.compare_runs(out["rows"].withColumn("run", F.substring_index("run", "/", -1)), "r1", "r2").collect()}
    assert delta["macro_f1"] == pytest.approx(0.2)


def test_write_splits(spark, tmp_path):
    df = spark.createDataFrame([("train", "007", "a", 1), ("val", "007", "b", 2), ("test", "x", "c", 3)], "split string, class string, file_name string, n int")
    root = str(tmp_path / "out")
    sinks.write_splits(df, root)
    assert sorted(rows(sinks.read_splits(spark, root), "split", "class", "file_name")) == [("test", "x", "c"), ("train", "007", "a"), ("val", "007", "b")]
    with pytest.raises(FileExistsError):
        sinks.write_splits(df, root)
    sinks.write_splits(df.where("n < 3"), root, clean_output=True)
    assert sinks.read_splits(spark, root).count() == 2


def _text(folder):
    return "".join(p.read_text() for p in sorted(folder.glob("part-*")))


def test_small_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", None, ["x"]), ("b", 2, [])], "k string, n int, l array<string>")
    sinks.write_csv(df.coalesce(1), str(tmp_path / "csv"), ["l", "k", "n"])
    assert _text(tmp_path / "csv") == 'l,k,n\n"[""x""]",a,\n[],b,2\n'
    sinks.write_jsonl(df.coalesce(1), str(tmp_path / "jsonl"))
    assert json.loads(_text(tmp_path / "jsonl").splitlines()[1]) == {"k": "b", "n": 2, "l": []}
    sinks.write_report(spark.createDataFrame([(2, 1)], "z int, a int"), str(tmp_path / "rep"))
    assert list(json.loads(_text(tmp_path / "rep"))) == ["a", "created_at", "z"]
    classes = validate.class_index(spark.createDataFrame([("b",), ("A",), ("b",)], "class string"))
    sinks.write_class_names(classes, str(tmp_path / "names"))
    assert _text(tmp_path / "names") == "A\nb\n"
    m = sinks.label_manifest(classes).first()
    assert m["class_to_index"] == {"A": 0, "b": 1} and m["index_to_class"] == {"0": "A", "1": "b"}
    cm = spark.createDataFrame([(0, 0, 1), (0, 1, 3), (1, 0, 0), (1, 1, 5)], "true_idx int, pred_idx int, n bigint")
    lines = [r["value"] for r in sinks.hard_class_lines(metrics.error_analysis(cm, ["a", "b"])).orderBy("class_idx", "line_no").collect()]
    assert lines == ["a | precision=1.0000 | recall=0.2500 | f1=0.4000 | support=4", "  confused_with: b (count=3, rate=0.7500)"]
    gate = spark.createDataFrame([(1, 0.9), (0, 0.1)], "truth int, score double")
    sinks.write_kv_metrics(sinks.binary_kv(threshold.binary_metrics(gate, 0.5)), str(tmp_path / "kv"))
    kv = _text(tmp_path / "kv").splitlines()
    assert len(kv) == 14 and kv[0] == "selected_fruit_threshold: 0.5000" and kv[1] == "accuracy: 1.000000" and kv[-1] == "true_fruit_pred_fruit: 1"
    back = {r["metric"]: r["value"] for r in readers.read_kv_metrics(spark, str(tmp_path / "kv")).collect()}
    assert back["macro_f1"] == 1.0


def test_fields_no_schema_has(spark):
    texts = [('{"class_names": ["a"], "epochs": 3, "notes": {"k": [1, null]}}', {"epochs": "3", "notes": '{"k":[1,null]}'}), ('{"class_names": ["a"]}', {})]
    df = spark.createDataFrame([(t,) for t, _ in texts], "value string")
    assert [r["u"] for r in df.select(readers.parse_open_manifest(F.col("value"))["unknown"].alias("u")).collect()] == [u for _, u in texts]
    odd = spark.createDataFrame([("[1]",), ("{",), (None,), ("{}",)], "value string")
    assert [r["u"] for r in odd.select(readers.unknown_fields(F.col("value"), ["a"]).alias("u")).collect()] == [None, None, None, {}]
    runs_ = spark.createDataFrame([("r", '{"stage1": {"loss": [1], "top3": [0.5, "x", null], "lr": 0.1}, "config": {"top3": [9]}, "n": [1]}'), ("s", "[]"), ("t", None)], "run string, value string")
    assert sorted(rows(readers.parse_more_metrics(runs_)), key=repr) == [("r", "stage1", "top3", 0, 0.5), ("r", "stage1", "top3", 1, None), ("r", "stage1", "top3", 2, None)]
