"""Row numbers inside groups of any size.

A plain ``row_number`` window puts a whole group into one task, so one class with a third of all rows
would decide the run time. Here a group is first cut into ordered slices, each slice is numbered on
its own, and the sizes of the earlier slices (a small aggregated table) are added.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelops.lineage import join_on, stored


def slice_starts(sliced: DataFrame, keys: Sequence[str], slice_col: str) -> DataFrame:
    """Per (keys, slice): its size ``_n`` and the number of rows ``_before`` it in the group."""
    earlier = Window.partitionBy(*keys).orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    return (
        sliced.groupBy(*keys, slice_col)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    )


def slice_key(keys: Sequence[str], slice_col: str) -> Column:
    """One text for (keys, slice) that is never NULL: window and join then share one partitioning."""
    return F.to_json(F.struct(*keys, slice_col))


def _number(sliced: DataFrame, starts: DataFrame, keys, slice_col: str, order, out: str) -> DataFrame:
    part = slice_key(keys, slice_col)
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    placed = sliced.withColumn("_part", part).withColumn("_in", inside).join(
        starts.select(part.alias("_part"), "_before"), "_part"
    )
    return placed.withColumn(out, F.col("_in") + F.col("_before")).drop("_in", "_before", "_part", slice_col)


def seeded_digest(seed: Column | str | int, *parts: Column) -> Column:
    """Order key of a reproducible shuffle."""
    seed = seed if isinstance(seed, Column) else F.lit(str(seed))
    return F.sha2(F.concat_ws(":", seed, *[p.cast("string") for p in parts]), 256)


def rank_by_digest(
    df: DataFrame, keys: Sequence[str], digest: Column, tie: Sequence[str], out: str = "rank", digits: int = 3
) -> DataFrame:
    """1-based rank by a SHA-256 key. Slices are its leading hex digits: 16**digits even slices."""
    sliced = df.withColumn("_digest", digest).withColumn("_slice", F.substring("_digest", 1, digits))
    starts = slice_starts(sliced, keys, "_slice")
    return _number(sliced, starts, keys, "_slice", ["_digest", *tie], out).drop("_digest")


def _numbers(keys: Sequence[str], schema: T.StructType):
    """``_k``: the 0-based place of a row among the rows of its group in this task, whose rows come in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count = None, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            ends = np.array([batch.num_rows])
            for k in keys:
                ends = np.union1d(ends, pc.run_end_encode(batch.column(k)).run_ends.to_numpy())
            starts = np.concatenate(([0], ends[:-1]))
            place = np.arange(batch.num_rows, dtype=np.int64) - np.repeat(starts, ends - starts)
            if last == [batch.column(k)[0].as_py() for k in keys]:
                place[: ends[0]] += count
            last, count = [batch.column(k)[-1].as_py() for k in keys], int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], names=[*batch.schema.names, "_k"])

    return run


def rank_by_order(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], out: str = "rank") -> DataFrame:
    """1-based rank by any order, NULL first; NULL keys are a group of their own.

    Rows are shuffled once, by ranges of keys and order, and numbered in the tasks that write them. A group that goes on
    in the next range needs an offset; a range has at most two of these, so the offsets are broadcast and no
    row moves again. The numbered rows are written, because a recomputed range partitioning may cut elsewhere."""
    by = [*keys, *order]
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_slice", F.spark_partition_id())
    schema = T.StructType([*ranged.schema.fields, T.StructField("_k", T.LongType())])
    found = stored(ranged.mapInArrow(_numbers(keys, schema), schema))
    group = Window.partitionBy(*keys)
    before = F.sum("_n").over(group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
    split = found.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", before).where(F.col("_before").isNotNull()).drop("_n")
    placed = join_on(found, F.broadcast(split), [*keys, "_slice"], "left")
    return placed.withColumn(out, F.col("_k") + F.coalesce("_before", F.lit(0)) + 1).drop("_k", "_before", "_slice")


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int = 1) -> DataFrame:
    """The first n rows per group. Spark prunes each map task to n rows per group before the shuffle
    (window group limit), so a hot group sends n rows per task, not its whole content."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
