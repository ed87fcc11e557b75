"""Connected components of a link table, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelops.lineage import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One rewiring step: hang neighbours of each node onto the smallest of them (and the node itself).

    ``large`` moves the larger neighbours only, otherwise the smaller ones with the node itself.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b").distinct()
    # here every link points from a larger node a to a smaller node b
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    hung = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b")
    return hung.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links between any orderable ids -> (node, root): the smallest id each linked node can reach.

    Large-star and small-star steps in turn until nothing moves; each turn is written to the shared
    folder, so a lost executor costs no earlier turn. Nodes without a link are not listed; a link of a
    node to itself, a repeated link and an empty table are fine; a NULL end is ignored.
    """
    ends = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), F.col("a").alias("x"), F.col("b").alias("y"))
    now = stored(ends.filter("x is not null and y is not null and a <> b").select("a", "b").distinct())
    seal = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seal or mark[0] == 0:
            break
        seal = mark
        now = stored(_stars(_stars(now, True), False))
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
