"""Cleaning and crop statistics, output names and the dataset report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelops.constants import KNOWN_CLASSES
from labelops.functions.tokens import resolve_known
from labelops.lineage import join_on
from labelops.operators.ranking import rank_by_order


def sorted_map(key: str, value: str) -> Column:
    """Aggregate: MAP with keys in order. Used on tables that are already one row per key."""
    entry = F.struct(F.col(key).alias("key"), F.col(value).alias("value"))
    return F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col(key).isNotNull(), entry))))


def _reason_counts(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    """One pass over the rows: counts per group and reason (a small, fixed set of reasons)."""
    return df.groupBy(*groups, "reason").agg(F.count(F.lit(1)).alias("n"))


def _roll_up(counts: DataFrame, groups: Sequence[str]) -> DataFrame:
    kept = F.col("reason").isNull()
    return counts.groupBy(*groups).agg(
        F.sum("n").alias("raw_images"),
        F.sum(F.when(kept, F.col("n")).otherwise(0)).alias("valid_images"),
        F.sum(F.when(kept, F.lit(0)).otherwise(F.col("n"))).alias("skipped_images"),
        sorted_map("reason", "n").alias("skip_reasons"),
    )


def raw_class_stats(cleaned: DataFrame) -> DataFrame:
    """Per raw class: raw, valid and skipped images and MAP reason -> count."""
    return _roll_up(_reason_counts(cleaned, ["raw_class", "class"]), ["raw_class", "class"])


def output_class_stats(cleaned: DataFrame) -> DataFrame:
    """Per merged class: the same figures plus its raw classes."""
    by_raw = _reason_counts(cleaned, ["raw_class", "class"])
    stats = _roll_up(by_raw.groupBy("class", "reason").agg(F.sum("n").alias("n")), ["class"])
    sources = (
        by_raw.select("class", "raw_class").distinct().groupBy("class")
        .agg(F.array_sort(F.collect_list(F.struct(F.lower("raw_class").alias("k"), F.col("raw_class").alias("v")))).alias("s"))
        .select("class", F.transform("s", lambda s: s["v"]).alias("source_raw_classes"))
    )
    return join_on(stats, sources, ["class"])


def crop_stats(crops: DataFrame, totals: bool = False) -> DataFrame:
    """Per class: total, cropped, kept and failed images and MAP reason -> count.

    With ``totals`` a grand-total row (class NULL) is added from the same small counts."""
    counts = crops.groupBy("class", "reason").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("applied")).alias("a")
    )
    if totals:
        counts = counts.unionByName(
            counts.groupBy("reason").agg(F.sum("n").alias("n"), F.sum("a").alias("a"))
            .withColumn("class", F.lit(None).cast("string"))
        )
    failed = F.col("reason") == "corrupted_image"
    return counts.groupBy("class").agg(
        F.sum("n").alias("total"),
        F.sum(F.when(failed, F.lit(0)).otherwise(F.col("a"))).alias("cropped"),
        F.sum(F.when(failed, F.lit(0)).otherwise(F.col("n") - F.col("a"))).alias("kept_original"),
        F.sum(F.when(failed, F.col("n")).otherwise(0)).alias("failed"),
        sorted_map("reason", "n").alias("reasons"),
    )


def crop_summary(crops: DataFrame) -> DataFrame:
    """Per-class crop statistics and the grand total."""
    return crop_stats(crops, totals=True)


def dataset_report(clean: DataFrame, crop: DataFrame) -> DataFrame:
    """Cleaning statistics joined with crop statistics; a class without crops gets zeros."""
    c = crop.select(
        "class", F.col("cropped").alias("crop_success"), "kept_original", F.col("failed").alias("crop_failed"),
        F.col("reasons").alias("crop_reasons"),
    )
    out = join_on(clean, c, ["class"], "left")
    for name in ("crop_success", "kept_original", "crop_failed"):
        out = out.withColumn(name, F.coalesce(name, F.lit(0)))
    return out.withColumn("crop_reasons", F.coalesce("crop_reasons", F.create_map().cast("map<string,bigint>")))


def report_totals(report: DataFrame) -> DataFrame:
    """One row of totals over all classes; missing figures count as 0."""
    names = ("raw_images", "valid_images", "skipped_images", "crop_success", "kept_original", "crop_failed")
    return report.agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names],
        F.count(F.lit(1)).alias("output_class_count"),
    )


def report_payload(report: DataFrame) -> DataFrame:
    """One row for the JSON report: totals and a map of all classes in name order."""
    fields = F.struct(*[c for c in report.columns if c != "class"]).alias("value")
    classes = report.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("class").alias("key"), fields)), by_key)).alias("classes")
    )
    totals = report_totals(report)
    return (
        classes.unionByName(totals.select(F.struct(*totals.columns).alias("totals")), allowMissingColumns=True)
        .agg(F.first("classes", ignorenulls=True).alias("classes"), F.first("totals", ignorenulls=True).alias("totals"))
        .withColumn("schema_version", F.lit(1))
    )


def by_key(a: Column, b: Column) -> Column:
    return F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)


def unique_names(
    kept: DataFrame, known: Sequence[str] = KNOWN_CLASSES, order: Sequence[str] = ("raw_class", "file_name")
) -> DataFrame:
    """Add ``output_name``: ``<raw>__<stem>.jpg``, then ``__0002`` and so on inside a merged class."""
    stem = F.regexp_replace("file_name", "(?<=.)\\.[^.]*$", "")

    def token(col: Column) -> Column:
        name = resolve_known(col, known)
        return F.when(name == "", F.lit("image")).otherwise(name)

    named = kept.withColumn("_base", F.concat(token(F.col("raw_class")), F.lit("__"), token(stem)))
    by = [c for name in order for c in (F.lower(name), F.col(name))]
    ranked = rank_by_order(named, ["class", "_base"], by, "_nth")
    number = F.col("_nth").cast("string")
    padded = F.when(F.length(number) < 4, F.lpad(number, 4, "0")).otherwise(number)
    suffix = F.when(F.col("_nth") == 1, F.lit("")).otherwise(F.concat(F.lit("__"), padded))
    return ranked.withColumn("output_name", F.concat("_base", suffix, F.lit(".jpg"))).drop("_base", "_nth")


def name_clashes(named: DataFrame) -> DataFrame:
    """Output names used twice in a class; expected to be empty."""
    return named.groupBy("class", "output_name").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
