"""The cleaning cascade: one reason per dropped row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelops.constants import CLEAN_EXTENSIONS
from labelops.functions.quality import Quality, blur_reason, extension_reason, quality_reason
from labelops.operators.dedup import drop_near_dups, first_rows, path_last


def gate_reason(cfg: Quality = Quality(), extensions: Sequence[str] = CLEAN_EXTENSIONS, corrupted: str | None = None):
    """First failing gate: extension, unreadable, size/aspect, blur."""
    w, h = F.col("width"), F.col("height")
    broken = F.coalesce(w, F.lit(-1)) < 0
    if corrupted:
        broken = broken | F.coalesce(F.col(corrupted), F.lit(False))
    return F.coalesce(
        extension_reason(F.col("file_name"), extensions),
        F.when(broken, "corrupted_image"),
        quality_reason(w, h, cfg),
        blur_reason(F.col("sharpness"), cfg.min_sharpness),
    )


def clean(
    df: DataFrame,
    cfg: Quality = Quality(),
    extensions: Sequence[str] = CLEAN_EXTENSIONS,
    tolerance: int = 0,
    hash_col: str = "phash",
    group: str = "class",
    order: Sequence[str] = ("raw_class", "file_name"),
    row_key: Sequence[str] = ("path",),
) -> DataFrame:
    """Add ``reason`` (NULL for kept rows). Only rows that pass every gate take part in the duplicate
    check, and the kept ones come back through their unique row key, so no hash is a join key."""
    gated = df.withColumn("_gate", gate_reason(cfg, extensions))
    needed = list(dict.fromkeys([group, hash_col, *order, *row_key]))
    passed = gated.where(F.col("_gate").isNull()).select(*needed)
    if tolerance == 0:
        kept = first_rows(passed, [group, hash_col], path_last(passed, order))
    else:
        kept = drop_near_dups(passed, tolerance, hash_col, group, order)
    kept = kept.select(*row_key, F.lit(True).alias("_kept"))
    copy = F.when(F.col("_kept").isNull(), "duplicate_image")
    return gated.join(kept, list(row_key), "left").withColumn("reason", F.coalesce("_gate", copy)).drop("_gate", "_kept")
