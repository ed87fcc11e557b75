"""Ordered records of a key: their numbers, and one checksum of their joined texts.

A key may hold a third of all records. Records are therefore dealt by ranges of (key, order), so that a hot key
fills many tasks, and what neighbouring ranges must know of each other is one row per range.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelops.lineage import stored

#: Bytes of joined text that are kept before they are passed on as a piece.
PIECE_BYTES = 1_000_000
#: A key with more than this share of the rows is joined by broadcast; there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 0.001


def numbered(rows: DataFrame, key: str, order: Sequence[Column], out: str = "pos") -> DataFrame:
    """The rows with ``out``, their 0-based place among the rows of their key; NULL is a key of its own.

    One shuffle by ranges, written once. Only a key that goes on in the next range needs an offset, and a range
    has at most two such keys, so the offsets are broadcast.
    """
    names = [f"_o{i}" for i in range(len(order))]
    ranged = rows.withColumns(dict(zip(names, order)))
    by = [F.col(key).asc_nulls_first(), *[F.col(n).asc_nulls_first() for n in names]]
    ranged = ranged.repartitionByRange(*by).sortWithinPartitions(*by).drop(*names).withColumn("_slice", F.spark_partition_id())
    schema = T.StructType([*ranged.schema.fields, T.StructField("_k", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count = None, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = batch.column(key)
            runs = pa.compute.run_end_encode(keys)
            ends = runs.run_ends.to_numpy()
            values = runs.values.to_pylist()
            starts = np.concatenate(([0], ends[:-1]))
            k = np.arange(batch.num_rows, dtype=np.int64) - np.repeat(starts, ends - starts)
            first = (values[0],)
            if first == last:
                k[: ends[0]] += count
            count = int(k[-1]) + 1
            last = (values[-1],)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(k)], names=[*batch.schema.names, "_k"])

    found = stored(ranged.mapInArrow(run, schema))
    sizes = found.groupBy(key, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    # a key in one range alone needs no offset; of the others a range holds at most its first and its last one
    own = Window.partitionBy(key)
    before = F.sum("_n").over(own.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
    split = sizes.withColumns({"_parts": F.count(F.lit(1)).over(own), "_before": before}).filter("_parts > 1 and _before is not null")
    split = split.select(F.col(key).alias("_key"), F.col("_slice").alias("_of"), "_before")
    placed = found.join(F.broadcast(split), F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slice") == F.col("_of")), "left")
    return placed.withColumn(out, F.col("_k") + F.coalesce("_before", F.lit(0))).drop("_key", "_of", "_before", "_slice", "_k")


def joined_sha256(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, sep: str, out: str = "sha256") -> DataFrame:
    """(keys, out): lower-case SHA-256 of the values of each key in order, joined by ``sep``; no key may be NULL.

    Ranges of (keys, order) are joined where they lie. A key that begins and ends inside a range gets its checksum
    there; the pieces of the others meet once and are hashed one after another, never held together.
    """
    by = [F.col(c) for c in (*keys, *order)]
    ranged = rows.select(*keys, *order, F.col(value).alias("_value")).repartitionByRange(*by).sortWithinPartitions(*by)
    ranged = ranged.select(*keys, "_value", F.spark_partition_id().alias("_slice"))
    kept = [ranged.schema[k] for k in keys]
    schema = T.StructType([*kept, T.StructField("_slice", T.IntegerType()), T.StructField("_no", T.LongType()), T.StructField(out, T.StringType()), T.StructField("_piece", T.BinaryType())])
    comma = sep.encode()
    n = len(keys)

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        columns = list(zip(*found)) or [[] for _ in target]
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, target)], schema=target)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, held, no, part, first = None, [], 0, 0, 0, True
        for batch in batches:
            found = []
            columns = [batch.column(i).to_pylist() for i in range(n)]
            part = batch.column(n + 1)[0].as_py() if batch.num_rows else part
            for *key, v in zip(*columns, batch.column(n).to_pylist()):
                if key != now:
                    if now is not None:
                        body = comma.join(parts)
                        if first or no:
                            found.append((*now, part, no, None, body))
                        else:
                            found.append((*now, part, 0, hashlib.sha256(body).hexdigest(), None))
                        first = False
                    now, parts, held, no = key, [], 0, 0
                parts.append(v.encode("utf-8", "surrogatepass"))
                held += len(parts[-1]) + 1
                if held > PIECE_BYTES:
                    found.append((*now, part, no, None, comma.join(parts)))
                    parts, held, no = [], 0, no + 1
            if found:
                yield batch_of(found)
        if now is not None and parts:
            yield batch_of([(*now, part, no, None, comma.join(parts))])

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            found = []
            for *key, piece in zip(*[batch.column(i).to_pylist() for i in range(n)], batch.column(n).to_pylist()):
                if key != now:
                    if now is not None:
                        found.append((*now, 0, 0, state.hexdigest(), None))
                    now, state = key, hashlib.sha256(piece)
                else:
                    state.update(comma)
                    state.update(piece)
            if found:
                yield batch_of(found)
        if now is not None:
            yield batch_of([(*now, 0, 0, state.hexdigest(), None)])

    pieces = stored(ranged.mapInArrow(join, schema))
    ends = pieces.filter(F.col(out).isNull()).repartition(*keys).sortWithinPartitions(*keys, "_slice", "_no").select(*keys, "_piece")
    return pieces.filter(F.col(out).isNotNull()).select(*keys, out).unionByName(ends.mapInArrow(chain, schema).select(*keys, out))


def join_counted(left: DataFrame, right: DataFrame, keys: Sequence[str], count: str, how: str = "inner") -> DataFrame:
    """Join of a written frame with rows of unique keys, whose column ``count`` says how many left rows they meet.

    Keys that meet more than HOT_SHARE of the left rows are few (at most 1 / HOT_SHARE) and are broadcast, so their
    rows stay where they are; the others are dealt by key. Keys are not NULL.
    """
    total = left.count()
    hot = F.broadcast(right.filter(F.col(count) > F.lit(total * HOT_SHARE)))
    cold = right.filter(F.col(count) <= F.lit(total * HOT_SHARE))
    rest = left.join(hot.select(*keys), list(keys), "left_anti").join(cold, list(keys), how)
    return left.join(hot, list(keys)).unionByName(rest)
