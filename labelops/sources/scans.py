"""Labelled folder scans. File names are filtered while listing; content is read only when asked for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelops.constants import CLEAN_EXTENSIONS, LOADER_EXTENSIONS, SPLITS, UPLOAD_EXTENSIONS
from labelops.lineage import stored
from labelops.operators.dedup import listing_order
from labelops.sources.folders import add_digest, can_list, list_folder, qualified


def _extension_glob(extensions: Sequence[str]) -> str:
    """Case-insensitive listing filter, e.g. ``*.{[jJ][pP][gG],[pP][nN][gG]}``."""
    parts = ["".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in e) for e in extensions]
    return "*.{" + ",".join(parts) + "}"


def clean_path(col: Column) -> Column:
    """One spelling of a file path: the scheme with a single slash, nothing percent-encoded."""
    return F.regexp_replace(col, "^file:/+", "file:/")


def decoded_path(col: Column) -> Column:
    """The same for a percent-encoded URI; a literal plus is kept."""
    return clean_path(F.url_decode(F.regexp_replace(col, "\\+", "%2B")))


def _relative(base: str) -> Column:
    """The path below the root; a listed file outside the root as the file system spells it is an error."""
    prefix = base + "/"
    outside = F.raise_error(F.concat(F.lit(f"not below {prefix}: "), F.col("path"))).cast("string")
    return F.when(F.col("path").startswith(prefix), F.substring("path", len(prefix) + 1, 1 << 30)).otherwise(outside)


def _scan(spark: SparkSession, root: str, extensions: Sequence[str] | None, content_hash: bool, max_bytes: int | None, depth: int = 1) -> DataFrame:
    """(path, length, mtime, _rel, ...), listed by the tasks; by Spark's reader where workers have no file system for the scheme."""
    base = qualified(spark, root)
    if not can_list(base):
        return _scan_binary(spark, root, base, extensions, content_hash, max_bytes)
    files = list_folder(spark, root, extensions, depth)
    large = F.col("length") > max_bytes if max_bytes is not None else F.lit(False)
    if content_hash:
        files = add_digest(stored(files), ~large)
    if max_bytes is not None:
        files = files.withColumn("reason", F.when(large, "file_too_large"))
    return files.withColumnRenamed("rel", "_rel")


def _scan_binary(spark: SparkSession, root: str, base: str, extensions: Sequence[str] | None, content_hash: bool, max_bytes: int | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if extensions is not None:
        reader = reader.option("pathGlobFilter", _extension_glob(extensions))
    files = reader.load(root)
    cols = [clean_path(F.col("path")).alias("path"), F.col("modificationTime").alias("mtime"), "length"]
    large = F.col("length") > max_bytes if max_bytes is not None else F.lit(False)
    if content_hash:
        cols.append(F.when(~large, F.sha2("content", 256)).alias("content_hash"))
    if max_bytes is not None:
        cols.append(F.when(large, "file_too_large").alias("reason"))
    return files.select(*cols).withColumn("_rel", _relative(base))


def scan_labelled(
    spark: SparkSession,
    root: str,
    extensions: Sequence[str] = CLEAN_EXTENSIONS,
    keep_unsupported: bool = False,
    content_hash: bool = False,
    max_bytes: int | None = None,
) -> DataFrame:
    """``<root>/<class>/<file>`` as (class, file_name, path, length, mtime[, content_hash]).

    With ``keep_unsupported`` files with another extension stay, so that they can be counted. With ``max_bytes``
    a column ``reason`` says ``file_too_large`` for larger files, and their content hash is NULL."""
    files = _scan(spark, root, None if keep_unsupported else extensions, content_hash, max_bytes)
    return (
        files.where(F.col("_rel").rlike("^[^/]+/[^/]+$"))
        .withColumn("class", F.split_part("_rel", F.lit("/"), F.lit(1)))
        .withColumn("file_name", F.split_part("_rel", F.lit("/"), F.lit(2)))
        .drop("_rel")
    )


def scan_splits(
    spark: SparkSession, root: str, splits: Sequence[str] = SPLITS, extensions: Sequence[str] = LOADER_EXTENSIONS,
    content_hash: bool = False,
) -> DataFrame:
    """``<root>/<split>/<class>/<file>`` with its split."""
    files = _scan(spark, root, extensions, content_hash, None, depth=2)
    parts = F.split("_rel", "/")
    return (
        files.where(F.col("_rel").rlike("^[^/]+/[^/]+/[^/]+$"))
        .select("*", F.get(parts, F.lit(0)).alias("split"), F.get(parts, F.lit(1)).alias("class"),
                F.get(parts, F.lit(2)).alias("file_name"))
        .where(F.col("split").isin(list(splits)))
        .drop("_rel")
    )


def split_listing(files: DataFrame) -> DataFrame:
    """Per split and class: files and latest change; class NULL is the split's total."""
    return files.groupBy("split", "class").agg(
        F.count(F.lit(1)).alias("files"), F.max("mtime").alias("latest_mtime")
    ).rollup("split", "class").agg(F.sum("files").alias("files"), F.max("latest_mtime").alias("latest_mtime")).where(
        F.col("split").isNotNull()
    )


def scan_uploads(spark: SparkSession, root: str, extensions: Sequence[str] = UPLOAD_EXTENSIONS) -> DataFrame:
    """``<root>/<label>/**/<file>`` as (image_path, raw_label)."""
    files = _scan(spark, root, extensions, False, None)
    return files.where(F.col("_rel").contains("/")).select(
        F.col("path").alias("image_path"), F.split_part("_rel", F.lit("/"), F.lit(1)).alias("raw_label")
    )


def scan_images(spark: SparkSession, root: str) -> DataFrame:
    """Decoded images as (path, image, reason). A file that cannot be read has width -1 and a reason."""
    images = spark.read.format("image").option("recursiveFileLookup", True).load(root)
    broken = F.when(F.col("image.width") < 0, "corrupted_image")
    return images.select(decoded_path(F.col("image.origin")).alias("path"), "image", broken.alias("reason"))


def stable_order(df: DataFrame, *cols: str) -> DataFrame:
    """Case-insensitive order, raw names as tie-breaks."""
    return df.orderBy(*listing_order(*cols))
