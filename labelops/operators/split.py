"""Stratified splits with exact counts, split counts and training batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelops.constants import SPLITS
from labelops.lineage import broadcast_if_small, cut
from labelops.operators.ranking import rank_by_digest, seeded_digest, slice_key, slice_starts

RATIOS = (0.70, 0.15, 0.15)


def check_ratios(ratios: Sequence[float]) -> None:
    if len(ratios) != len(SPLITS) or min(ratios) <= 0 or abs(sum(ratios) - 1.0) > 1e-9:
        raise ValueError(f"ratios must be positive and sum to 1: {ratios}")


def allocate(n: Column, ratios: Sequence[float] = RATIOS) -> Column:
    """STRUCT<train, val, test>: floors, then largest remainders (ties: larger ratio, then split
    order), then empty splits filled from the largest one. Fewer than 3 rows is an error."""
    check_ratios(ratios)
    shares = F.array(*[F.lit(float(r)) for r in ratios])
    ideal = F.transform(shares, lambda r: n.cast("double") * r)
    floors = F.transform(ideal, lambda x: F.floor(x))
    rest = n - F.aggregate(floors, F.lit(0).cast("long"), lambda a, x: a + x)
    order = F.array_sort(
        F.transform(ideal, lambda x, i: F.struct((F.floor(x) - x).alias("f"), (-F.get(shares, i)).alias("r"), i.alias("i")))
    )
    places = F.transform(order, lambda s: s["i"])
    counts = F.transform(floors, lambda x, i: x + F.when(F.array_position(places, i) <= rest, 1).otherwise(0))

    def fill(acc: Column, i: Column) -> Column:
        """Move one row from the (first) largest split to split i when that is empty."""
        donor = F.array_position(acc, F.array_max(acc)) - 1
        moved = F.transform(acc, lambda c, j: c + F.when(j == i, 1).otherwise(0) - F.when(j == donor, 1).otherwise(0))
        return F.when(F.get(acc, i) == 0, moved).otherwise(acc)

    filled = F.aggregate(F.array(*[F.lit(i) for i in range(len(SPLITS))]), counts, fill)
    too_few = F.raise_error(F.lit("a class needs at least 3 rows to fill train, val and test")).cast("long")
    checked = F.when(n < 3, F.array(too_few)).otherwise(filled)
    return F.transform(F.array(checked), lambda c: F.struct(*[F.get(c, F.lit(i)).alias(s) for i, s in enumerate(SPLITS)]))[0]


def split_sizes(df: DataFrame, ratios: Sequence[float] = RATIOS, group: str = "class", keep_small: bool = False) -> DataFrame:
    """Rows of every class and of each of its splits. A class with fewer than 3 rows is an error; with ``keep_small`` its sizes are NULL."""
    n = F.col("n")
    sizes = F.when(n >= len(SPLITS), allocate(F.greatest(n, F.lit(len(SPLITS))), ratios)) if keep_small else allocate(n, ratios)
    sized = df.groupBy(group).agg(F.count(F.lit(1)).alias("n")).withColumn("_s", sizes)
    return sized.select(group, "n", *[F.col(f"_s.{s}").alias(s) for s in SPLITS])


def stratified_split(
    df: DataFrame,
    ratios: Sequence[float] = RATIOS,
    seed: int = 42,
    group: str = "class",
    key: Sequence[str] = ("file_name",),
    digits: int = 3,
) -> DataFrame:
    """Add ``split``: rows in seeded order inside their class; first train, next val, rest test.

    The order key is a hash, so its leading digits cut a class into even slices whose sizes come from
    one small aggregate. A slice that lies wholly inside a split needs no sorting; only the (at most
    two) slices per class that a split boundary runs through are shuffled and numbered row by row.
    The input is read three times (sizes, whole slices, crossed slices), so give it a cheap or
    checkpointed plan. There are at most 16**digits slices per class."""
    digest = seeded_digest(seed, F.col(group), *[F.col(k) for k in key])
    sliced = df.withColumn("_digest", digest).withColumn("_slice", F.substring("_digest", 1, digits))
    starts = cut(slice_starts(sliced.select(group, "_slice"), [group], "_slice"))
    sizes = starts.groupBy(F.col(group).alias("_g")).agg(F.sum("_n").alias("_total"))
    sizes = sizes.select("_g", allocate(F.col("_total"), ratios).alias("_size"))

    def split_at(place: Column) -> Column:
        train, val = F.col("_size.train"), F.col("_size.val")
        return F.when(place < train, "train").when(place < train + val, "val").otherwise("test")

    first, last = split_at(F.col("_before")), split_at(F.col("_before") + F.col("_n") - 1)
    plan = cut(
        starts.join(sizes, F.col(group).eqNullSafe(F.col("_g"))).select(
            slice_key([group], "_slice").alias("_part"), "_before", "_size", F.when(first == last, first).alias("split")
        )
    )
    placed = sliced.withColumn("_part", slice_key([group], "_slice"))
    whole = placed.join(broadcast_if_small(plan.where(F.col("split").isNotNull()).drop("_before", "_size")), "_part")
    inside = F.row_number().over(Window.partitionBy("_part").orderBy("_digest", *key)) - 1
    crossed = (
        placed.join(broadcast_if_small(plan.where(F.col("split").isNull()).drop("split")), "_part")
        .withColumn("split", split_at(F.col("_before") + inside))
        .drop("_before", "_size")
    )
    return whole.unionByName(crossed).drop("_digest", "_slice", "_part")


def split_counts(df: DataFrame, group: str = "class") -> DataFrame:
    """Rows per class and split, plus a total row with class NULL."""
    per_split = [F.count_if(F.col("split") == s).alias(s) for s in SPLITS]
    return df.rollup(group).agg(*per_split, F.count(F.lit(1)).alias("total"))


def batches(
    df: DataFrame, size: int, key: Sequence[str], seed: int = 42, epoch: int = 0, drop_remainder: bool = False,
    digits: int = 3,
) -> DataFrame:
    """Add ``batch``: rows in an order reshuffled per epoch, cut into batches of ``size``."""
    digest = seeded_digest(f"{seed}:{epoch}", *[F.col(k) for k in key])
    out = rank_by_digest(df, [], digest, key, "_place", digits)
    out = out.withColumn("batch", F.floor((F.col("_place") - 1) / size)).drop("_place")
    if drop_remainder:
        sizes = out.groupBy("batch").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == size).drop("_n")
        out = out.join(sizes, "batch", "left_semi")
    return out


def batch_plan(df: DataFrame, size: int, drop_remainder: bool = False) -> DataFrame:
    """One row: examples and expected batches; no batch at all is an error."""
    n = F.col("examples")
    count = F.floor(n / size) if drop_remainder else F.ceil(n / size)
    checked = F.when(count <= 0, F.raise_error(F.lit("no batch to train on")).cast("long")).otherwise(count)
    return df.agg(F.count(F.lit(1)).alias("examples")).withColumn("batches", checked.cast("long"))
