"""Label indices, one-hot vectors, checked labels and class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelops.lineage import broadcast_if_small, cut, join_on
from labelops.operators.validate import class_index


def label_index(df: DataFrame, col: str = "class") -> DataFrame:
    """Add ``label``: position of the class in the case-insensitive class list.

    The class list is found first, so that the rows meet it by a broadcast and keep their places."""
    index = broadcast_if_small(cut(class_index(df, col).withColumnRenamed("class", col)))
    return join_on(df, index, [col])


def one_hot(label: Column, k: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: (i == label).cast("float"))


def checked_label(col: Column, k: int) -> Column:
    """Integer label from an integer or integral number in [0, k); anything else is an error."""
    fits = (col == F.floor(col)) & (col >= 0) & (col < k)
    bad = F.raise_error(F.concat(F.lit(f"not a label in [0, {k}): "), F.coalesce(col.cast("string"), F.lit("NULL"))))
    return F.when(F.coalesce(fits, F.lit(False)), col.cast("int")).otherwise(bad.cast("int"))


def class_weights(
    df: DataFrame, col: str = "class", clip: tuple[float, float] | None = None, classes: int | None = None
) -> DataFrame:
    """Per class its rows and the balanced weight total / (classes * rows), optionally clipped.

    With two classes this is the binary rule total / (2 * rows). ``classes`` states how many classes
    there must be, so that a class without rows is an error."""
    counts = df.groupBy(F.col(col).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()
    k = F.count(F.lit(1)).over(everything)
    weight = F.sum("n").over(everything) / (k * F.col("n"))
    if classes is not None:
        empty = F.raise_error(F.lit(f"expected {classes} classes with rows")).cast("double")
        weight = F.when(k == classes, weight).otherwise(empty)
    if clip is not None:
        weight = F.least(F.greatest(weight, F.lit(float(clip[0]))), F.lit(float(clip[1])))
    return counts.select("class", "n", weight.alias("weight"))
