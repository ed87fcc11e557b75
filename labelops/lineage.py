"""Reliable checkpoints, literal rows and null-safe joins shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate data: spark.checkpoint.dir, or one beside the warehouse where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints").rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Write the frame to the cluster's checkpoint folder and continue from there."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Like ``cut``, but as a Parquet table: compressed, and later steps read only the columns they use.

    The table goes when the session's JVM ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4()}"
    df.write.parquet(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


#: Whether the shuffle files of an execution go with its end instead of waiting for the driver's garbage collection.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Executions inside leave no shuffle files behind; for chains of large steps that are each stored."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def stored_observed(df: DataFrame, *figures: Column) -> tuple[DataFrame, DataFrame]:
    """Like ``stored``, with figures over all rows counted while they are written: the table, and one row of figures.

    Figures are named aggregates that give whole numbers."""
    seen = Observation()
    table = stored(df.observe(seen, *figures))
    found = seen.get
    return table, df.sparkSession.range(1).select(*[F.lit(v).cast("long").alias(k) for k, v in found.items()])


BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 128 << 20


def _row_bytes(df: DataFrame) -> Column:
    """About what a row takes in a broadcast: 16 bytes a field, and the content of texts, binaries and lists."""
    parts = [F.lit(16 * len(df.columns))]
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`").alias("v")))), F.lit(0)))
    return reduce(lambda a, b: a + b, parts).cast("long")


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast of a checkpointed frame after counting its rows and bytes; else leave it alone."""
    seen = df.select(_row_bytes(df).alias("_b")).limit(rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_b"), F.lit(0)).alias("b")).first()
    return F.broadcast(df) if seen["n"] <= rows and seen["b"] <= size else df


def literal_rows(spark: SparkSession, columns: Sequence[str], rows: Sequence[Sequence]) -> DataFrame:
    """A bounded list of constants as a frame, without a Python scan."""
    structs = [F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join that also matches NULL keys and keeps the left key columns."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond: Column = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])
