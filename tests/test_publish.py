"""Distributed listings, published versions and the change finder."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from labelops.operators import validate
from labelops.plans import flows
from labelops.sources import folders, publish, scans, sinks
from tests.conftest import rows


def tree(tmp_path, names):
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(name.encode() * 3)
    return str(tmp_path)


NAMES = ["a/1.jpg", "a/_kept.PNG", "a/.hidden.jpg", ".cache/x.jpg", "a/note.txt", "b c/2.jpeg", "b c/deep/3.png", "b c/deep/er/4.gif", "top.jpg", "é%20/5.bmp", "d/.x/6.jpg"]


def test_listing_has_one_partition_per_prefix(spark, tmp_path):
    root = tree(tmp_path, NAMES)
    listed = folders.list_folder(spark, root)
    assert sorted(rows(listed, "rel", "length")) == sorted((n, 3 * len(n.encode())) for n in NAMES if "/." not in n and n[0] != ".")
    assert listed.rdd.getNumPartitions() == 5  # the root itself, a, b c, d and é%20
    assert folders.list_folder(spark, root, depth=2).rdd.getNumPartitions() == 6
    assert sorted(rows(folders.list_folder(spark, root, ("jpg", "PNG")), "rel")) == [("a/1.jpg",), ("a/_kept.PNG",), ("b c/deep/3.png",), ("top.jpg",)]
    with pytest.raises(Exception):
        folders.list_folder(spark, root + "/missing").collect()
    (tmp_path / "empty").mkdir()
    assert folders.list_folder(spark, root + "/empty").count() == 0


def test_scans_agree_with_the_binary_reader(spark, tmp_path, monkeypatch):
    root = tree(tmp_path, [n for n in NAMES if "/_" not in n and "%" not in n])
    listed = scans.scan_labelled(spark, root, keep_unsupported=True, content_hash=True)
    plain = sorted(rows(listed, "path", "class", "file_name", "length", "content_hash"))
    assert {r[2]: r[4] for r in plain}["1.jpg"] == hashlib.sha256(b"a/1.jpg" * 3).hexdigest()
    monkeypatch.setattr(scans, "can_list", lambda base: False)
    assert sorted(rows(scans.scan_labelled(spark, root, keep_unsupported=True, content_hash=True), "path", "class", "file_name", "length", "content_hash")) == plain


def test_unknown_stores_are_left_to_spark():
    assert not folders.can_list("nowhere://host/folder") and folders.can_list("file:/tmp") and folders.can_list("/tmp")


def test_written_files_come_back(spark, tmp_path):
    df = spark.createDataFrame([("a/x.bin", b"1"), ("a/b/y.bin", None), ("z.bin", b"22")], "rel string, content binary")
    assert sorted(rows(folders.write_files(df, str(tmp_path / "out")))) == [("a/b/y.bin", 0), ("a/x.bin", 1), ("z.bin", 2)]
    assert sorted(rows(folders.list_folder(spark, str(tmp_path / "out")), "rel", "length")) == [("a/b/y.bin", 0), ("a/x.bin", 1), ("z.bin", 2)]
    for bad in ("../x", "/x", "a//b", ".", None):
        with pytest.raises(Exception, match="not a name"):
            folders.write_files(df.limit(1).withColumn("rel", F.lit(bad).cast("string")), str(tmp_path / "out"))


def split_rows(spark, n=3, tag="a"):
    return spark.createDataFrame([(("train", "val", "test")[i % 3], str(i % 2), f"{tag}{i}") for i in range(n)], "split string, class string, file_name string")


def test_versions_and_two_writers(spark, tmp_path):
    root = str(tmp_path / "out")
    assert sinks.write_splits(split_rows(spark), root) == 1
    with pytest.raises(FileExistsError, match="clean_output"):
        sinks.write_splits(split_rows(spark), root)
    # both start from version 1; the second to commit is told so and leaves nothing behind
    one, two = publish.Draft(split_rows(spark, 4, "b"), root), publish.Draft(split_rows(spark, 5, "c"), root)
    assert one.commit() == 2
    with pytest.raises(FileExistsError, match="another writer"):
        two.commit()
    assert publish.read_published(spark, root).count() == 4 and publish.read_published(spark, root, 1).count() == 3
    assert not sinks.path_exists(spark, two.path)
    assert sinks.write_splits(split_rows(spark, 6, "d"), root, clean_output=True) == 3
    assert publish.numbers(spark, root) == [2, 3] and sinks.read_splits(spark, root).count() == 6 and sinks.read_splits(spark, root, version=2).count() == 4


def test_killed_writers(spark, tmp_path):
    root = str(tmp_path / "out")
    sinks.write_splits(split_rows(spark), root)
    dead = publish.Draft(split_rows(spark, 9, "x"), root)  # died before its manifest
    (tmp_path / "out" / publish.MANIFESTS / f"{2:012d}.json").write_text('{"version": 2, "da')  # died in its manifest
    assert sinks.read_splits(spark, root).count() == 3
    with pytest.raises(ValueError, match="not complete"):
        publish.read_published(spark, root, 2)
    assert sinks.write_splits(split_rows(spark, 5, "y"), root, clean_output=True) == 3
    assert sinks.read_splits(spark, root).count() == 5
    assert publish.remove_drafts(spark, root) == [] and publish.remove_drafts(spark, root, 0) == [dead.data]
    assert sinks.read_splits(spark, root).count() == 5 and publish.read_published(spark, root, 1).count() == 3
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, str(tmp_path / "nothing"))


def test_plain_folders_can_still_be_read(spark, tmp_path):
    split_rows(spark).write.partitionBy("split", "class").parquet(str(tmp_path / "old"))
    got = sinks.read_splits(spark, str(tmp_path / "old"))
    assert sorted(rows(got, "class")) == [("0",), ("0",), ("1",)]


def listing(spark, files):
    return spark.createDataFrame(files, "path string, class string, length long, mtime long")



@pytest.mark.parametrize("few", [1000, 0])
def test_change_finder(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(validate, "LISTED_RANGES", few)
    rnd = random.Random(2)
    old = {f"{c}/{i}.jpg": (c, rnd.randint(1, 99), i) for c in ("a", "b", "c") for i in range(400)}
    new = dict(old)
    want = {}
    for p in rnd.sample(sorted(old), 9):
        kind = rnd.choice(["removed", "changed"])
        want[p] = kind
        if kind == "removed":
            del new[p]
        else:
            new[p] = (old[p][0], old[p][1], -1)
    new["d/new.jpg"], want["d/new.jpg"] = ("d", 5, 0), "added"
    flat = lambda d: [(p, *v) for p, v in d.items()]
    before, after = listing(spark, flat(old)), listing(spark, flat(new))
    trees = [validate.snapshot_tree(x, stamp=F.col("mtime")) for x in (before, after)]
    ranges = validate.changed_ranges(*trees)
    got = {(r["level"], r["range"]): (r["files_before"], r["files_after"]) for r in ranges.collect()}
    cell = lambda p: f"{p[0]}/{hashlib.sha256(p.encode()).hexdigest()[:2]}"
    assert {k for k in got if k[0] == 2} == {(2, cell(p)) for p in want}
    assert {k for k in got if k[0] == 1} == {(1, p[0]) for p in want} and got[0, ""] == (1200, len(new)) and got[1, "d"] == (0, 1)
    validate.write_listing(before, str(tmp_path / "kept"))
    kept = spark.read.parquet(str(tmp_path / "kept"))
    files = validate.changed_files(kept, after, ranges, stamp=F.col("mtime"))
    assert {r["path"]: r["change"] for r in files.collect()} == want
    assert validate.changed_ranges(trees[0], validate.snapshot_tree(before.repartition(3), stamp=F.col("mtime"))).isEmpty()
    whole = validate.snapshot(before, stamp=F.col("mtime")).first()
    root = trees[0].where("level = 0").first()
    assert (root["files"], root["bytes"], root["digest"]) == (whole["file_count"], whole["total_bytes"], whole["digest"])
    assert validate.snapshot_tree(before.limit(0), stamp=F.col("mtime")).count() == 0


def test_changed_source_names_its_files(spark, tmp_path):
    root = tree(tmp_path, ["a/1.jpg", "a/2.jpg"])
    before = scans.scan_labelled(spark, root).persist()
    before.count()
    validate.require_same_files(before, scans.scan_labelled(spark, root))
    (tmp_path / "a" / "3.jpg").write_bytes(b"")
    with pytest.raises(ValueError, match=r"source changed in 1 ranges: added .*a/3\.jpg"):
        validate.require_same_files(before, scans.scan_labelled(spark, root))
    before.unpersist()


def test_rebuild_publishes_the_cleaned_rows(spark, tmp_path):
    items = spark.createDataFrame(
        [("apple", f"{i}.jpg", f"/raw/apple/{i}.jpg", 300, 50 if i == 0 else 300, 500.0, f"h{min(i, 3)}", f"c{i}") for i in range(5)],
        "raw_class string, file_name string, path string, width int, height int, sharpness double, phash string, content_hash string",
    )
    crops = items.withColumn("class", F.col("raw_class")).withColumn("bbox", F.expr("cast(null as struct<x1:int,y1:int,x2:int,y2:int>)")).withColumns(
        {"texture": F.lit(0.0), "contrast": F.lit(0.0), "edge_density": F.lit(0.0)})
    paths = flows.RebuildPaths(*[str(tmp_path / n) for n in ("raw", "main", "subset", "report")])
    totals = flows.rebuild("preprocess", items, paths, crops).first()
    assert (totals["raw_images"], totals["valid_images"]) == (5, 3)
    kept = publish.read_published(spark, paths.cleaned)
    assert sorted(rows(kept, "source_file_name", "file_name")) == [(f"{i}.jpg", f"apple__{i}.jpg") for i in (1, 2, 3)]
    assert json.loads("".join(p.read_text() for p in (tmp_path / "report").glob("part-*")))
    with pytest.raises(FileExistsError):
        flows.rebuild("preprocess", items, paths, crops)
    flows.rebuild("preprocess", items.where("file_name <> '2.jpg'"), paths, crops, clean_output=True)
    assert publish.read_published(spark, paths.cleaned).count() == 2
    with pytest.raises(ValueError, match="inside the source"):
        flows.RebuildPaths("/raw", "/m", "/s", "/r", "/raw/cleaned")
