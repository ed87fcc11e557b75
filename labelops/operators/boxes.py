"""Bounding boxes of foreground components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _share():
    return F.col("area") / F.greatest(F.lit(1), F.col("w").cast("long") * F.col("h"))


def _box():
    x2, y2 = F.col("x") + F.col("cw"), F.col("y") + F.col("ch")
    return F.struct(F.col("x").alias("x1"), F.col("y").alias("y1"), x2.alias("x2"), y2.alias("y2"))


def bbox_union(components: DataFrame, min_share: float = 0.0015) -> DataFrame:
    """Per image the box around all components that are large enough; NULL when none is."""
    big = _share() >= min_share
    agg = components.groupBy("image_id").agg(
        F.min(F.when(big, F.col("x"))).alias("x1"),
        F.min(F.when(big, F.col("y"))).alias("y1"),
        F.max(F.when(big, F.col("x") + F.col("cw"))).alias("x2"),
        F.max(F.when(big, F.col("y") + F.col("ch"))).alias("y2"),
    )
    return agg.select("image_id", F.when(F.col("x1").isNotNull(), F.struct("x1", "y1", "x2", "y2")).alias("bbox"))


def bbox_largest(components: DataFrame, min_share: float = 0.002) -> DataFrame:
    """Per image the box of its largest component, the lowest label (then the box) on a tie; NULL when
    all are tiny."""
    order = F.struct("area", *[-F.col(c) for c in ("label", "x", "y", "cw", "ch")])
    best = F.max_by(_box(), F.when(_share() >= min_share, order))
    return components.groupBy("image_id").agg(best.alias("bbox"))
