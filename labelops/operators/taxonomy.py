"""Taxonomy plan, upload-label mapping and class filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelops.constants import (
    KNOWN_CLASSES,
    MERGE_GROUPS,
    MERGE_RULES,
    OUT_OF_SCOPE,
    PRE_MERGE_NAMES,
    UNSUPPORTED_V1,
    UPLOAD_ALIASES,
)
from labelops.functions.tokens import ascii_token, is_other, lookup, merge_class, resolve_known
from labelops.lineage import broadcast_if_small, cut, join_on, literal_rows


def raw_mapping(
    df: DataFrame, rules: Mapping[str, str] = MERGE_RULES, known: Sequence[str] = KNOWN_CLASSES, raw: str = "raw_class"
) -> DataFrame:
    """One row per raw folder: raw name, clean name, merged class."""
    return df.select(raw).distinct().select(
        F.col(raw).alias("raw_class"),
        resolve_known(F.col(raw), known).alias("clean_class"),
        merge_class(F.col(raw), rules, known).alias("class"),
    )


def taxonomy_plan(
    mapping: DataFrame, targets: Sequence[str] = tuple(MERGE_GROUPS), pre_merge: Sequence[str] = PRE_MERGE_NAMES
) -> DataFrame:
    """Per merged class its raw folders and the rule it breaks, if any.

    ``problem``: blank_name, unplanned_merge (several folders on a class that is no merge target) or
    pre_merge_name (a folded class still in the output)."""
    return (
        mapping.groupBy("class")
        .agg(
            F.count(F.lit(1)).alias("raw_classes"),
            F.transform(
                F.array_sort(F.collect_list(F.struct(F.lower("raw_class").alias("k"), F.col("raw_class").alias("v")))),
                lambda s: s["v"],
            ).alias("sources"),
        )
        .withColumn(
            "problem",
            F.when(F.col("class") == "", "blank_name")
            .when((F.col("raw_classes") > 1) & ~F.col("class").isin(list(targets)), "unplanned_merge")
            .when(F.col("class").isin(list(pre_merge)), "pre_merge_name"),
        )
    )


def map_upload_label(
    df: DataFrame,
    classes: Sequence[str],
    unsupported: Sequence[str] = UNSUPPORTED_V1,
    out_of_scope: Sequence[str] = OUT_OF_SCOPE,
    aliases: Mapping[str, str] = UPLOAD_ALIASES,
    col: str = "raw_label",
) -> DataFrame:
    """Add normalized_label, true_label (supported rows only) and group, in order of precedence."""
    df = ascii_token(df, col, "normalized_label")
    token = F.col("normalized_label")
    name = F.coalesce(lookup(token, aliases), token)
    known = name.isin(list(classes))
    return df.withColumn("true_label", F.when(known, name)).withColumn(
        "group",
        F.when(known, "supported")
        .when(name.isin(list(unsupported)), "unsupported_v1")
        .when(name.isin(list(out_of_scope)), "out_of_scope")
        .otherwise("unknown_label"),
    )


def drop_other(df: DataFrame, col: str = "class") -> DataFrame:
    return df.where(~is_other(F.col(col)))


def supported_only(df: DataFrame, unsupported: Sequence[str], col: str = "class") -> DataFrame:
    return df.where(~F.col(col).isin(list(unsupported)))


def missing_names(df: DataFrame, names: Sequence[str], col: str = "class") -> DataFrame:
    """Requested names that no row carries (a typo guard)."""
    wanted = literal_rows(df.sparkSession, [col], [(n,) for n in names])
    return join_on(wanted, df.select(col).distinct(), [col], "left_anti")


def resolve_unique_prefix(requested: DataFrame, classes: Sequence[str], col: str = "requested") -> DataFrame:
    """Distinct class names for short names: exact, else the one class that starts with ``<name>_``.
    A name with several candidates is an error; one without any is dropped."""
    name = F.lower(F.trim(col))
    listed = F.array(*[F.lit(c) for c in classes])
    hits = F.filter(listed, lambda c: c.startswith(F.concat(name, F.lit("_"))))
    clash = F.raise_error(F.concat(F.lit("several classes start with "), name)).cast("string")
    return (
        requested.where(name != "")
        .select(
            F.when(name.isin(list(classes)), name)
            .when(F.size(hits) == 1, F.get(hits, F.lit(0)))
            .when(F.size(hits) > 1, clash)
            .alias("class_name")
        )
        .where(F.col("class_name").isNotNull())
        .distinct()
    )


def is_weak(df: DataFrame, weak: DataFrame, col: str = "class") -> DataFrame:
    """Add ``is_weak``: the class is one of the resolved weak classes."""
    flagged = cut(weak.select(F.col("class_name").alias(col), F.lit(True).alias("_weak")).distinct())
    return join_on(df, broadcast_if_small(flagged), [col], "left").withColumn("is_weak", F.coalesce("_weak", F.lit(False))).drop("_weak")
