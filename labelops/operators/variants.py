"""Matched file lists of two dataset variants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelops.constants import SPLITS
from labelops.operators.dedup import dedup_exact
from labelops.operators.ranking import first_rows

KEYS = ("class", "file_name")


def pair_variants(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both variants by (class, file_name) with ``side``; the hash is that of variant a."""
    left = a.select(*KEYS, F.col("content_hash").alias("hash_a"), F.lit(True).alias("in_a"))
    right = b.select(*KEYS, F.lit(True).alias("in_b"))
    side = F.when(F.col("in_b").isNull(), "missing_in_b").when(F.col("in_a").isNull(), "missing_in_a").otherwise("both")
    return left.join(right, list(KEYS), "full_outer").select(*KEYS, F.col("hash_a").alias("content_hash"), side.alias("side"))


def matched_unique(pairs: DataFrame) -> DataFrame:
    """Files present in both variants, exact copies (by variant a) removed across classes."""
    return dedup_exact(pairs.where(F.col("side") == "both")).select(*KEYS, "content_hash")


def match_report(pairs: DataFrame, kept: DataFrame, strict: bool = False) -> DataFrame:
    """Per class: files per variant, matched, matched unique, one-sided and duplicate counts."""
    side = F.col("side")
    sides = pairs.groupBy("class").agg(
        F.count_if(side != "missing_in_a").alias("a_files"),
        F.count_if(side != "missing_in_b").alias("b_files"),
        F.count_if(side == "both").alias("matched"),
        F.count_if(side == "missing_in_a").alias("missing_in_a"),
        F.count_if(side == "missing_in_b").alias("missing_in_b"),
    )
    unique = kept.groupBy("class").agg(F.count(F.lit(1)).alias("matched_unique"))
    out = sides.join(unique, "class", "left").withColumn("matched_unique", F.coalesce("matched_unique", F.lit(0)))
    if strict:
        short = F.raise_error(F.concat(F.lit("too few matched files in class "), F.col("class"))).cast("long")
        out = out.withColumn(
            "matched_unique", F.when(F.col("matched_unique") < len(SPLITS), short).otherwise(F.col("matched_unique"))
        )
    return out.withColumn("duplicate_skipped", F.col("matched") - F.col("matched_unique"))


def missing_preview(pairs: DataFrame, n: int = 30) -> DataFrame:
    """Up to n one-sided files per class and side."""
    return first_rows(pairs.where(F.col("side") != "both"), ["class", "side"], ["file_name"], n)


def match_variants(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The matched unique files and the per-class report."""
    pairs = pair_variants(a, b)
    kept = matched_unique(pairs)
    return kept, match_report(pairs, kept)
