"""Nothing is lost or replaced without a word."""

import pytest
from pyspark.sql import functions as F

from labelops.functions.quality import extension_reason
from labelops.operators import dedup, learn, validate
from labelops.sources import publish, scans, sinks
from tests.conftest import rows


def test_labels_outside_the_range_are_an_error(spark):
    df = spark.createDataFrame([(0, [1.0]), (1500, [2.0]), (-1, [3.0])], "label int, embedding array<double>")
    with pytest.raises(Exception, match="not a label"):
        learn.centroids(df, 1000).collect()
    assert learn.centroids(df.where("label >= 0"), 1501).count() == 2


def test_paths_that_repeat_the_root_and_relative_roots(spark, tmp_path, monkeypatch):
    for name in ("data/a/1.png", "data/a/2.png", "data/data/3.png"):
        (tmp_path / "data" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "data" / name).write_bytes(b"x")
    found = scans.scan_uploads(spark, str(tmp_path / "data"))
    assert rows(found.orderBy("image_path"), "raw_label") == [("data",)] * 3
    assert scans.scan_labelled(spark, str(tmp_path / "data" / "data")).count() == 3


def test_large_files_keep_their_row(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "small.png").write_bytes(b"x")
    (tmp_path / "a" / "large.png").write_bytes(b"x" * 100)
    out = scans.scan_labelled(spark, str(tmp_path), content_hash=True, max_bytes=10).orderBy("file_name")
    assert [(r["file_name"], r["content_hash"] is None, r["reason"]) for r in out.collect()] == [("large.png", True, "file_too_large"), ("small.png", False, None)]


def test_double_dots_before_the_suffix(spark):
    df = spark.createDataFrame([("a..jpg",), (".jpg",), ("a.b.JPG",), ("a",)], "n string")
    got = df.select("n", extension_reason(F.col("n"), (".jpg", "jpg")).alias("r"))
    assert {r["n"]: r["r"] for r in got.collect()} == {"a..jpg": None, ".jpg": "unsupported_extension", "a.b.JPG": None, "a": "unsupported_extension"}


def test_reconcile_counts_repeats(spark):
    plan = spark.createDataFrame([("train", "a", "x")] * 2 + [("val", "a", "y")], "split string, class string, file_name string")
    written = spark.createDataFrame([("train", "a", "x"), ("val", "a", "y"), ("val", "a", "y")], plan.schema)
    assert sorted(rows(validate.reconcile(plan, written))) == [("train", "a", "x", "not_written"), ("val", "a", "y", "not_planned")]
    assert validate.reconcile(plan, plan.repartition(3)).isEmpty()


def test_failed_publish_keeps_the_old_output(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    df = spark.createDataFrame([("train", "a", "x")], "split string, class string, file_name string")
    sinks.write_splits(df, root)

    def broken(*args):
        raise OSError("no space")

    monkeypatch.setattr(publish, "create_once", broken)
    with pytest.raises(OSError):
        sinks.write_splits(df.withColumn("file_name", F.lit("new")), root, clean_output=True)
    monkeypatch.undo()
    assert rows(sinks.read_splits(spark, root), "file_name") == [("x",)]
    sinks.write_splits(df.withColumn("file_name", F.lit("new")), root, clean_output=True)
    assert rows(sinks.read_splits(spark, root), "file_name") == [("new",)]


def test_equal_listings_are_told_apart_by_path(spark):
    df = spark.createDataFrame([("a", "f", "h", "p2"), ("a", "f", "h", "p1")], "class string, file_name string, content_hash string, path string")
    assert rows(dedup.dedup_exact(df.repartition(2)), "path") == [("p1",)]


def test_fits_need_rows_of_every_class(spark):
    df = spark.createDataFrame([("train", 0, [1.0]), ("train", 1, [2.0]), ("test", 0, [1.0])], "split string, label int, features array<double>")
    with pytest.raises(Exception, match="expected 3 classes"):
        learn.fit_classes(df, 3)


def test_models_run_once_per_row(spark):
    df = spark.range(10).select(F.col("id"), F.array(F.col("id").cast("float")).alias("features"))

    def gate():
        return lambda x: (x[:, 0] >= 5).astype(float)

    def classes():
        return lambda x: __import__("numpy").repeat(x, 2, axis=1).astype(float)

    out = learn.score(df, gate, classes, dim=1)
    assert out.where("probs is not null").count() == 5 and out.count() == 10
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_report_keys_are_in_order_at_every_depth(spark):
    inner = F.struct(F.lit(1).alias("b"), F.lit(2).alias("a"))
    df = spark.range(1).select(inner.alias("z"), F.array(inner).alias("y"), F.create_map(F.lit("k"), inner).alias("x"), F.lit(None).cast("struct<b:int,a:int>").alias("n"))
    want = '{"n":null,"x":{"k":{"a":2,"b":1}},"y":[{"a":2,"b":1}],"z":{"a":2,"b":1}}'
    assert sinks.report_json(df).first()["value"] == want


def test_large_images_come_in_small_batches(spark, monkeypatch):
    """A worker is handed at most the limit in pixels, however many rows that is; results do not depend on it."""
    from labelops.operators import images

    monkeypatch.setattr(images, "BATCH_BYTES", 3_000_000)
    before = spark.conf.get(images.BYTE_LIMIT)
    try:
        side = 600
        image = F.struct(F.lit(side).alias("height"), F.lit(side).alias("width"), F.lit(3).alias("nChannels"), F.unhex(F.repeat(F.lpad(F.hex(F.col("id") % 250), 2, "0"), side * side * 3)).alias("data"))
        table = spark.range(12).repartition(1).select(F.col("id").cast("string").alias("path"), image.alias("image"))

        def sizes(batches):
            for b in batches:
                yield b.assign(n=len(b))[["n"]]

        seen = [r["n"] for r in images.flat_pixels(table).mapInPandas(sizes, "n int").collect()]
        assert sum(1 / n for n in seen) >= 3 and max(seen) <= 4
        assert images.pixel_statistics(table).where("width = 600 and sharpness = 0").count() == 12
    finally:
        spark.conf.set(images.BYTE_LIMIT, before.rstrip("bB"))


def test_broadcasts_are_bounded_in_bytes(spark):
    from labelops import lineage

    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("name"), F.array(F.lit("y" * 500)).alias("names"))
    hinted = lambda d: "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert hinted(lineage.broadcast_if_small(df)) and not hinted(lineage.broadcast_if_small(df, size=100_000)) and not hinted(lineage.broadcast_if_small(df, rows=99))
    assert hinted(lineage.broadcast_if_small(df.limit(0)))
