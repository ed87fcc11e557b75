"""Exact, per-class and near-duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations
from math import comb

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelops.lineage import broadcast_if_small, cut, join_on, literal_rows
from labelops.operators.ranking import first_rows, rank_by_order

LISTING = ("class", "file_name")


def listing_order(*cols: str) -> list[Column]:
    """Case-insensitive order with the raw name as the tie-break."""
    return [c for name in cols for c in (F.lower(name), F.col(name))]


def path_last(df: DataFrame, order: Sequence[str]) -> list[Column]:
    """The listing order, then the path where there is one, so that no tie is left to the partitioning."""
    return listing_order(*order, *(["path"] if "path" in df.columns and "path" not in order else []))


def dedup_exact(df: DataFrame, key: str = "content_hash", order: Sequence[str] = LISTING) -> DataFrame:
    """First row of every content, across all classes."""
    return first_rows(df, [key], path_last(df, order))


def dedup_in_class(
    df: DataFrame, key: str = "phash", group: str = "class", order: Sequence[str] = ("raw_class", "file_name")
) -> DataFrame:
    """First row of every perceptual hash inside a merged class."""
    return first_rows(df, [group, key], path_last(df, order))


def mark_copies(df: DataFrame, keys: Sequence[str], order: Sequence[str], row_key: Sequence[str]) -> DataFrame:
    """Add ``is_copy``. The kept rows come back through their unique row key, never through the
    group key, so a content shared by a third of all rows does not make a hot join key."""
    needed = list(dict.fromkeys([*keys, *order, *row_key]))
    kept = first_rows(df.select(*needed), keys, listing_order(*order)).select(*row_key, F.lit(True).alias("_kept"))
    return join_on(df, kept, row_key, "left").withColumn("is_copy", F.col("_kept").isNull()).drop("_kept")


def duplicate_counts(
    df: DataFrame, kept: DataFrame, group: str = "class", minimum: int | None = None
) -> DataFrame:
    """Rows, unique rows and removed copies per class; with ``minimum``, raise on a class below it."""
    counts = join_on(
        df.groupBy(group).agg(F.count(F.lit(1)).alias("input_rows")),
        kept.groupBy(group).agg(F.count(F.lit(1)).alias("unique_rows")),
        [group],
        "left",
    ).withColumn("unique_rows", F.coalesce("unique_rows", F.lit(0)))
    if minimum is not None:
        short = F.concat(F.lit("too few unique rows in class "), F.col(group))
        counts = counts.withColumn(
            "unique_rows",
            F.when(F.col("unique_rows") < minimum, F.raise_error(short).cast("long")).otherwise(F.col("unique_rows")),
        )
    return counts.withColumn("duplicates_removed", F.col("input_rows") - F.col("unique_rows"))


# --- near duplicates ---------------------------------------------------------------------------

FLIP_DISTANCE = 6
SLICE = 2000
SALTS = 16


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _key_masks(t: int) -> list[int]:
    """64-bit masks such that two hashes within t bits agree on at least one masked part.

    The bits are cut into more than t blocks; t flipped bits touch at most t of them, so the blocks
    left over agree. More blocks give longer, more selective keys at the price of more copies."""
    blocks = {1: 6, 2: 6, 3: 6, 4: 7, 5: 8, 6: 8}.get(t, t + 1)
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(kept) for kept in combinations(parts, blocks - t)]


def _flip_table(tables: DataFrame, radius: int) -> DataFrame:
    """Per key table, every change of at most ``radius`` bits outside its mask: a fixed number."""
    one = F.lit(1).cast("long")
    bits = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("shiftleft", one, i))
    out = tables.withColumn("free", F.filter(bits, lambda b: b.bitwiseAND(F.col("mask")) == 0)).withColumn(
        "flips", F.array(F.lit(0).cast("long"))
    )
    for _ in range(radius):
        wider = F.transform("flips", lambda f: F.transform(F.col("free"), lambda b: f.bitwiseXOR(b)))
        out = out.withColumn("flips", F.array_distinct(F.concat("flips", F.flatten(wider))))
    return out.select("tbl", F.explode("flips").alias("flip"))


def _flip_count(masks: Sequence[int], radius: int) -> int:
    """Most rows ``_flip_table`` makes of one row."""
    free = max(64 - (m & (1 << 64) - 1).bit_count() for m in masks)
    return sum(comb(free, r) for r in range(radius + 1))


def near_pairs(hashes: DataFrame, t: int, bucket_limit: int | None = None) -> DataFrame:
    """Pairs (group, a, b, pa, pb), a listed before b at the places pa and pb, of distinct hashes with 1..t differing bits.

    ``hashes`` has (group, h, pos): each hash once per group with its place in the listing. Rows meet
    on masked parts of the hash. A bucket of up to ``bucket_limit`` rows is joined directly. A larger
    one is not paired up: both sides list the values within half the distance of their hash and meet
    there, and because hashes are distinct a meeting point can only have a fixed number of them.
    The limit is by default the size from which that list is shorter than the pairs; both find the
    same. The list grows steeply with t, so above FLIP_DISTANCE a large bucket is dealt in even slices
    instead, and every two slices meet under a key of their own: no key holds more than two slices."""
    masks = [_signed(m) for m in _key_masks(t)]
    if bucket_limit is None:
        bucket_limit = 2 * (_flip_count(masks, (t + 1) // 2) + _flip_count(masks, t // 2))
    tables = literal_rows(hashes.sparkSession, ["tbl", "mask"], list(enumerate(masks)))
    bucket = ["group", "tbl", "part"]
    keyed = (
        hashes.select("*", F.posexplode(F.array(*[F.lit(m) for m in masks])).alias("tbl", "mask"))
        .withColumn("part", F.col("h").bitwiseAND(F.col("mask")))
        .withColumn("salt", F.pmod(F.xxhash64("h"), F.lit(SALTS)))
        .drop("mask")
    )
    # Most buckets hold one row and drop out here; the others are repeated per salt, so that the
    # rows of a huge bucket find its size in many tasks.
    sizes = (
        keyed.groupBy(*bucket)
        .agg(F.count(F.lit(1)).alias("size"))
        .where("size > 1")
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    )
    shared = cut(keyed.join(sizes, [*bucket, "salt"]).drop("salt"))

    def meet(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        other = right.select(*on, F.col("h").alias("h2"), F.col("pos").alias("pos2"))
        return (
            left.join(other, on)
            .where((F.col("pos") < F.col("pos2")) & (F.bit_count(F.col("h").bitwiseXOR(F.col("h2"))) <= t))
            .select("group", F.col("h").alias("a"), F.col("h2").alias("b"), F.col("pos").alias("pa"), F.col("pos2").alias("pb"))
        )

    small, large = shared.where(F.col("size") <= bucket_limit), shared.where(F.col("size") > bucket_limit)

    def circle(radius: int) -> DataFrame:
        flips = F.broadcast(_flip_table(tables, radius))
        return large.join(flips, "tbl").withColumn("mid", F.col("h").bitwiseXOR(F.col("flip")))

    def sliced(rows: DataFrame) -> DataFrame:
        slices = F.ceil(F.col("size") / SLICE).cast("int")
        own = F.pmod(F.xxhash64("h"), slices).cast("int")
        cells = F.transform(F.sequence(F.lit(0), slices - 1), lambda k: F.least(own, k) * slices + F.greatest(own, k))
        return rows.withColumn("cell", F.explode(cells))

    pairs = meet(small, small, bucket)
    if t > FLIP_DISTANCE:
        pairs = pairs.unionByName(meet(sliced(large), sliced(large), [*bucket, "cell"]))
    elif not large.isEmpty():
        pairs = pairs.unionByName(meet(circle((t + 1) // 2), circle(t // 2), [*bucket, "mid"]))
    return pairs.distinct()


#: Rounds that settle what no chain holds up; afterwards the listing is settled block by block.
PEEL_ROUNDS = 3
#: Pairs whose later row lies in one block: what a task settles one by one.
BLOCK_PAIRS = 500_000


def _without(pairs: DataFrame, gone: DataFrame, ends: Sequence[str]) -> DataFrame:
    """Pairs none of whose given ends is gone."""
    gone = broadcast_if_small(gone)
    for end in ends:
        pairs = pairs.join(gone.withColumnRenamed("h", end), ["group", end], "left_anti")
    return pairs


def _one_by_one(group: tuple[pa.Scalar, ...], pairs: pa.Table) -> pa.Table:
    """The rule itself, over one block of one group: rows in listing order, each dropped if an earlier kept one is near it.

    A pair without ``a`` says that a kept row of an earlier block is near ``b``."""
    inside = pairs.filter(pc.is_valid(pairs.column("pa"))).sort_by([("pa", "ascending")])
    gone = set(pairs.filter(pc.is_null(pairs.column("pa"))).column("pb").to_pylist())
    for x, y in zip(inside.column("pa").to_pylist(), inside.column("pb").to_pylist()):
        if x not in gone:
            gone.add(y)
    names = dict(zip(pairs.column("pb").to_pylist(), pairs.column("b").to_pylist()))
    found = sorted(gone)
    return pa.table({"group": pa.array([group[0].as_py()] * len(found), pairs.schema.field("group").type), "h": pa.array([names[x] for x in found], pa.int64())})


def _by_blocks(pairs: DataFrame, block_pairs: int) -> DataFrame:
    """Hashes (group, h) dropped, settled in blocks of the listing, one after another.

    A group is cut by rank so that about ``block_pairs`` pairs end in each block; a block is settled against the rows kept in earlier
    ones, in one task a group, and its own kept rows then mark their later neighbours. There are as many rounds as
    blocks of the largest group, however long a chain of near rows is."""
    by_rank = rank_by_order(pairs.select("group", "pb"), ["group"], ["pb"], "rank")
    starts = by_rank.groupBy("group", F.floor((F.col("rank") - 1) / block_pairs).cast("int").alias("block")).agg(F.min("pb").alias("from_pos"))
    # rows of equal rank belong to the block that begins last at or before them
    edges = cut(starts.where("block > 0").groupBy("group").agg(F.sort_array(F.collect_set("from_pos")).alias("edges")))
    placed = join_on(pairs, broadcast_if_small(edges), ["group"], "left")
    block = lambda pos: F.size(F.filter(F.coalesce("edges", F.array().cast("array<bigint>")), lambda e: e <= F.col(pos)))
    placed = cut(placed.withColumns({"block_a": block("pa"), "block_b": block("pb")}).drop("edges"))
    last = placed.agg(F.max("block_b")).first()[0]
    schema = T.StructType([pairs.schema["group"], T.StructField("h", T.LongType())])
    marks = placed.select("group", "b", "pb", "block_b").limit(0)
    removed: DataFrame | None = None
    for k in range(last + 1):
        here = placed.where((F.col("block_a") == k) & (F.col("block_b") == k)).select("group", "pa", "pb", "b").unionByName(
            marks.where(F.col("block_b") == k).select("group", F.lit(None).cast("long").alias("pa"), "pb", "b")
        )
        gone = cut(here.groupBy("group").applyInArrow(_one_by_one, schema))
        removed = gone if removed is None else removed.unionByName(gone)
        if k < last:
            later = placed.where((F.col("block_a") == k) & (F.col("block_b") > k))
            marks = cut(marks.where(F.col("block_b") > k).unionByName(_without(later, gone, ["a"]).select("group", "b", "pb", "block_b")).distinct())
    return removed


def greedy_removed(pairs: DataFrame, peel: int = PEEL_ROUNDS, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Hashes (group, h) dropped when each row is dropped if an earlier kept row is near it.

    ``pairs`` has (group, a, b, pa, pb): near hashes and their places in the listing, pa < pb. In the first ``peel``
    rounds, hashes without an undecided earlier neighbour are kept and all their later neighbours go; pairs with a decided end
    disappear. That settles all but chains, each row of which waits for the one before; what is left is settled
    by blocks of the listing. The result is that of the one-by-one rule."""
    pairs = cut(pairs)
    found = [pairs.select("group", F.col("b").alias("h")).limit(0)]
    for _ in range(peel):
        if pairs.isEmpty():
            break
        later = pairs.select("group", F.col("b").alias("a")).distinct()
        gone = cut(
            pairs.join(pairs.select("group", "a").distinct().join(later, ["group", "a"], "left_anti"), ["group", "a"])
            .select("group", F.col("b").alias("h"))
            .distinct()
        )
        found.append(gone)
        pairs = cut(_without(pairs, gone, ("a", "b")))
    if not pairs.isEmpty():
        found.append(_by_blocks(pairs, block_pairs))
    return reduce(DataFrame.unionByName, found)


def drop_near_dups(
    df: DataFrame,
    t: int,
    key: str = "phash",
    group: str = "class",
    order: Sequence[str] = ("raw_class", "file_name"),
    bucket_limit: int | None = None,
) -> DataFrame:
    """Keep a row unless an earlier kept row of its class has a hash within t bits."""
    first = dedup_in_class(df, key, group, order)
    if t == 0:
        return first
    first = cut(first)
    # The listing place becomes one number, since every hash is copied once per key table.
    listed = rank_by_order(first.select(group, key, *order), [], listing_order(*order), "pos")
    hashes = listed.select(F.col(group).alias("group"), F.col(key).alias("h"), "pos")
    removed = greedy_removed(near_pairs(hashes, t, bucket_limit))
    return first.join(removed, (first[group] == removed["group"]) & (first[key] == removed["h"]), "left_anti")
