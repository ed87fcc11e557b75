"""Queries over real files: the given tables written as folders of files to the shared folder, and scanned back."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelops.constants import CLEAN_EXTENSIONS, MERGE_GROUPS, OTHER
from labelops.functions.quality import extension_reason
from labelops.lineage import cut, shared_folder
from labelops.operators import images, validate
from labelops.plans import flows
from labelops.plans import standins as s
from labelops.plans.flow_queries import _images
from labelops.plans.queries import query
from labelops.sources import folders, publish, scans, sinks


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4()}"


def _documents(spark, sf) -> DataFrame:
    """Documents as file contents with a name; every 50th is hidden, every 20th lies a folder deeper."""
    name = F.concat(F.lpad(F.col("doc_id").cast("string"), 8, "0"), F.when(F.col("source") == "src7", ".txt").when(F.col("doc_id") % 3 == 0, ".PNG").otherwise(".jpg"))
    name = F.when(F.col("doc_id") % 50 == 0, F.concat(F.lit("."), name)).otherwise(name)
    deep = F.when(F.col("doc_id") % 20 == 1, F.concat(F.lit("more/"), name)).otherwise(name)
    return s.table(spark, sf, "documents").select("doc_id", F.coalesce("lang", F.lit("none")).alias("class"), name.alias("name"), deep.alias("deep"), F.col("text").cast("binary").alias("content"))


def _written(spark, rows: DataFrame, rel: Column) -> str:
    folder = _folder(spark)
    folders.write_files(rows.withColumn("rel", rel), folder)
    return folder


@query
def scan_labelled(spark, sf):
    root = _written(spark, _documents(spark, sf), F.concat_ws("/", "class", "deep"))
    return scans.scan_labelled(spark, root, content_hash=True, max_bytes=4000).select("class", "file_name", "length", "content_hash", "reason")


@query
def scan_unsupported(spark, sf):
    root = _written(spark, _documents(spark, sf), F.concat_ws("/", "class", "deep"))
    found = scans.scan_labelled(spark, root, keep_unsupported=True)
    return found.groupBy("class", extension_reason(F.col("file_name"), CLEAN_EXTENSIONS).alias("reason")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )


@query
def scan_splits(spark, sf):
    part = F.when(F.col("doc_id") % 10 < 6, "train").when(F.col("doc_id") % 10 < 8, "val").when(F.col("doc_id") % 10 == 8, "test").otherwise("spare")
    root = _written(spark, _documents(spark, sf), F.concat_ws("/", part, "class", "name"))
    return scans.split_listing(scans.scan_splits(spark, root)).select("split", "class", "files")


@query
def scan_uploads(spark, sf):
    root = _written(spark, _documents(spark, sf), F.concat_ws("/", "class", "deep"))
    found = scans.scan_uploads(spark, root)
    return found.select("raw_label", F.regexp_extract("image_path", "[^/]+$", 0).alias("file_name"), F.contains("image_path", F.lit("/more/")).alias("deeper"))


def _bitmap(data: Column) -> Column:
    """An 8 x 8 gray image as an uncompressed 24-bit BMP file: header, then rows from the bottom up."""
    header = "424DF6000000000000003600000028000000080000000800000001001800000000" + "00C0000000" + "00" * 16
    digits = F.hex(data)
    row = lambda y: F.transform(F.sequence(F.lit(0), F.lit(7)), lambda x: F.repeat(F.substring(digits, (16 * y + 2 * x + 1).cast("int"), F.lit(2)), 3))
    rows = F.flatten(F.transform(F.sequence(F.lit(7), F.lit(0)), row))
    return F.unhex(F.concat(F.lit(header), F.array_join(rows, "")))


@query
def scan_images(spark, sf):
    files = _images(spark, sf).withColumn("n", F.col("path").cast("long"))
    body = F.when(F.col("n") % 7 == 3, F.lit(b"not an image")).otherwise(_bitmap(F.col("image.data")))
    root = _written(spark, files.withColumn("content", body), F.concat(F.lit("c"), (F.col("n") % 5).cast("string"), F.lit("/"), "path", F.lit(".bmp")))
    found = images.to_rgb(scans.scan_images(spark, root), "reason")
    return found.select(F.regexp_extract("path", "([^/]+)[.]bmp$", 1).alias("name"), F.col("width").cast("int").alias("width"), "reason", F.hex("rgb").alias("rgb"))


@query
def published_splits(spark, sf):
    """A first version of part of the rows, then the whole as the next one; what readers see is the second."""
    rows = s.split_items(spark, sf).select("split", "class", "file_name", "width")
    root = _folder(spark)
    sinks.write_splits(rows.where("split <> 'test'"), root)
    version = sinks.write_splits(rows, root, clean_output=True)
    return sinks.read_splits(spark, root).withColumn("version", F.lit(version))


def _listings(spark, sf) -> tuple[DataFrame, DataFrame]:
    """A listing of the documents, and the same after files were removed, changed and added."""
    docs = s.table(spark, sf, "documents").select(
        F.concat_ws("/", "lang", F.col("doc_id").cast("string")).alias("path"), F.coalesce("lang", F.lit("none")).alias("class"), "doc_id",
        F.octet_length("text").cast("long").alias("length"), F.timestamp_micros(F.col("doc_id") * 1_000_000).alias("mtime"),
    )
    i = F.col("doc_id")
    after = docs.where(i % 97 != 5).withColumn("length", F.col("length") + F.when(i % 89 == 7, 1).otherwise(0)).withColumn(
        "path", F.when(i % 83 == 11, F.concat("path", F.lit("b"))).otherwise(F.col("path"))
    )
    return docs.drop("doc_id"), after.drop("doc_id")


@query
def changed_ranges(spark, sf):
    return validate.changed_ranges(*[validate.snapshot_tree(x) for x in _listings(spark, sf)])


@query
def changed_files(spark, sf):
    before, after = _listings(spark, sf)
    kept = _folder(spark)
    validate.write_listing(before, kept)
    before = spark.read.parquet(kept)
    ranges = validate.changed_ranges(validate.snapshot_tree(before), validate.snapshot_tree(after))
    return validate.changed_files(before, after, ranges)


@query
def flow_rebuild(spark, sf):
    """The split stage on a folder of real files: scan, split, publish, compare the source, check."""
    named = F.get(F.array(*[F.lit(c) for c in (*MERGE_GROUPS, OTHER)]), F.pmod("path", F.lit(len(MERGE_GROUPS) + 1)).cast("int"))
    files = s.items(spark, sf, F.col("text").cast("binary").alias("content")).select("path", named.alias("class"), "file_name", "content")
    # a file takes its time whatever its size, so files are dealt evenly over all cores
    files = files.repartition(4 * spark.sparkContext.defaultParallelism, "path")
    base = _folder(spark)
    folders.write_files(files.withColumn("rel", F.concat_ws("/", "class", "file_name")), f"{base}/raw")
    paths = flows.RebuildPaths(f"{base}/raw", f"{base}/main", f"{base}/subset", f"{base}/report")
    checks = flows.rebuild("split", scans.scan_labelled(spark, paths.raw, content_hash=True), paths)
    published = sinks.read_splits(spark, paths.main).groupBy(F.lit("main").alias("dataset")).agg(F.count(F.lit(1)).alias("published")).unionByName(
        sinks.read_splits(spark, paths.subset).groupBy(F.lit("subset").alias("dataset")).agg(F.count(F.lit(1)).alias("published"))
    )
    return checks.join(published, "dataset")


@query
def flow_rebuild_cleaned(spark, sf):
    """The preprocess stage: cleaned rows as they were published, with their new names."""
    base = _folder(spark)
    items = cut(s.items(spark, sf))
    crops = items.withColumns({"bbox": F.lit(None).cast("struct<x1:int,y1:int,x2:int,y2:int>"), "texture": F.lit(0.0), "contrast": F.lit(0.0), "edge_density": F.lit(0.0)})
    paths = flows.RebuildPaths(f"{base}/raw", f"{base}/main", f"{base}/subset", f"{base}/report")
    flows.rebuild("preprocess", items, paths, crops)
    return publish.read_published(spark, paths.cleaned).select("path", "class", "raw_class", "source_file_name", "file_name")
