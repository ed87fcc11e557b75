"""Near-duplicate groups by 64-bit fingerprints: a Gray-order hierarchical index over masked buckets.

The fingerprint is either an image's ``perceptual_hash`` (``operators.images.image_profile``) or the
SimHash of a text made here. Two fingerprints that differ in at most ``t`` bits agree on some choice of parts of
the word, so they meet in one of the masked buckets. Inside a bucket the fingerprints are sorted by
their rank in Gray order; eight neighbours form a node, eight nodes the next one, and a node keeps the bits
that all below it share. A search starts at the root, adds up the differences on the bits each node
contributes, and drops a whole group once more than ``t`` have been met.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelops.lineage import stored
from labelops.llm import text
from labelops.llm.components import components

SHINGLE = 4
SEED = 42
FAN = 8
#: Fingerprints of one bucket that meet in one place; larger buckets are dealt over pairs of slices.
CELL = 4096
#: Mean fingerprints of a bucket above which buckets are made finer.
BUCKET = 64
#: Node comparisons held in memory at once.
FRONTIER = 2_000_000


# --- SimHash ------------------------------------------------------------------------------------


def _fingerprint(body: str | None) -> int:
    words = text.ascii_words(body)
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words)
    if n <= SHINGLE:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: n - SHINGLE + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :].tolist())], "<u8")
    set_bits = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 65536):
        part = hashes[a : a + 65536]
        set_bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


def simhash(items: DataFrame, id_col: str = "path", text_col: str = "text") -> DataFrame:
    """One row per item: ``id_col`` and ``simhash BIGINT`` of the lower-cased (A-Z) words' 4-word shingles.

    A bit is set if it is set in over half of the shingles' XXH64 (seed 42), repeats included. Fewer than
    four words make one shingle; NULL text and text without a word give 0. Whole texts of any length.
    """
    schema = text.plus(items, id_col, [("simhash", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.pieces(batches, "text"):
            found = np.array([_fingerprint(x) for x in batch.column("text").to_pylist()], np.uint64)
            yield text.record(batch.column("id"), schema, [found.view(np.int64)])

    return items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


# --- masked buckets -----------------------------------------------------------------------------


def masks(n: int, t: int) -> list[int]:
    """Masks such that two words at t or fewer differing bits agree under at least one.

    The word is cut into t + j parts, of which some j must agree. j grows with the number n of fingerprints
    so that a bucket of evenly spread ones stays small; the links found are the same for every j.
    """
    j = 1
    while j < 8 and n > BUCKET * 2 ** (64 * j // (t + j)):
        j += 1
    m = t + j
    bounds = [64 * i // m for i in range(m + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(bounds, bounds[1:])]
    return [sum(c) for c in combinations(parts, j)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def gray_rank(word: Column) -> Column:
    """Place of a 64-bit word in Gray order, as a signed number in the same order."""
    for shift in (1, 2, 4, 8, 16, 32):
        word = word.bitwiseXOR(F.shiftrightunsigned(word, shift))
    return word.bitwiseXOR(F.lit(-(1 << 63)))


# --- the index of one bucket or many ------------------------------------------------------------


def _levels(bucket: np.ndarray, words: np.ndarray) -> list[dict]:
    """Index levels from the leaves up. Rows are sorted by (bucket, Gray rank); no node crosses a bucket."""
    levels = [{"pattern": words, "mask": np.full(len(words), ~np.uint64(0)), "last": np.arange(len(words)), "bucket": bucket}]
    while True:
        low = levels[-1]
        b = low["bucket"]
        first = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
        size = np.diff(np.r_[first, len(b)])
        if size.max() == 1:
            return levels
        place = np.arange(len(b)) - np.repeat(first, size)
        start = np.flatnonzero(place % FAN == 0)
        ones = np.bitwise_and.reduceat(low["pattern"], start)
        some = np.bitwise_or.reduceat(low["pattern"], start)
        known = np.bitwise_and.reduceat(low["mask"], start)
        mask = ~(ones ^ some) & known
        count = np.diff(np.r_[start, len(b)])
        low["own"] = low["mask"] & ~np.repeat(mask, count)
        levels.append({
            "pattern": ones & mask, "mask": mask, "child": start, "count": count,
            "last": low["last"][np.r_[start[1:] - 1, len(b) - 1]], "bucket": b[start],
        })


def linked(bucket: np.ndarray, words: np.ndarray, t: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows (i < j) of one bucket at t or fewer differing bits, in pieces of bounded size."""
    if len(words) < 2:
        return
    levels = _levels(bucket, words)
    top = levels[-1]["bucket"]
    root = np.searchsorted(top, bucket)
    size = np.bincount(root)[root]
    slices = np.cumsum(size) // FRONTIER
    for s in np.unique(slices):
        row = np.flatnonzero((slices == s) & (size > 1))
        node, met = root[row], np.zeros(len(row), np.int64)
        for depth in range(len(levels) - 1, 0, -1):
            high, low = levels[depth], levels[depth - 1]
            n = high["count"][node]
            row, met, first = np.repeat(row, n), np.repeat(met, n), np.repeat(high["child"][node], n)
            node = first + np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n)
            met = met + np.bitwise_count((words[row] ^ low["pattern"][node]) & low["own"][node])
            keep = (met <= t) & (low["last"][node] > row)
            row, node, met = row[keep], node[keep], met[keep]
        if len(row):
            yield row, node


def merged(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n rows the first row it hangs together with."""
    label = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = label[i], label[j]
            if not (a != b).any():
                break
            least = np.minimum(a, b)
            np.minimum.at(label, np.maximum(a, b), least)
            np.minimum.at(label, i, least)
            np.minimum.at(label, j, least)
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
    return label


def _bucket_links(t: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(part: pa.RecordBatch):
            cols = [part.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "part", "cell")]
            words = part.column("hash").to_numpy(zero_copy_only=False).view(np.uint64)
            new = np.any([c[1:] != c[:-1] for c in cols], axis=0) if len(words) > 1 else np.empty(0, bool)
            bucket = np.r_[0, np.cumsum(new)]
            label = merged(len(words), linked(bucket, words, t))
            moved = np.flatnonzero(label != np.arange(len(words)))
            signed = words.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(signed[moved]), pa.array(signed[label[moved]])], names=["a", "b"])

        for batch in batches:
            if batch.num_rows == 0:
                continue
            held.append(batch)
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0] if len(held) > 1 else batch
            key = [whole.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "part", "cell")]
            same = np.all([c == c[-1] for c in key], axis=0)
            cut = whole.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
            held = [whole.slice(cut)]
            if cut:
                yield flush(whole.slice(0, cut))
        if held:
            yield flush(held[0])

    return run


def hash_links(hashes: DataFrame, hash_col: str = "perceptual_hash", t: int = 4) -> DataFrame:
    """(a, b) links that connect all distinct hashes at t or fewer differing bits.

    Not every pair: per bucket each hash is tied to the first one it hangs together with, so a dense group of g
    hashes gives fewer than g links a bucket. A bucket over CELL hashes is dealt in even slices, and
    every pair of slices meets in a cell of its own, so no task holds more than two slices.
    """
    distinct = stored(hashes.select(F.col(hash_col).alias("hash")).filter("hash is not null").distinct())
    n = distinct.count()
    buckets = F.array(*[
        F.struct(F.lit(i).alias("mask"), F.col("hash").bitwiseAND(F.lit(_signed(m))).alias("part")) for i, m in enumerate(masks(n, t))
    ])
    dealt = distinct.select("hash", F.inline(buckets))
    large = dealt.groupBy("mask", "part").count().filter(F.col("count") > CELL)
    large = large.select("mask", "part", F.ceil(F.col("count") / (CELL // 2)).cast("int").alias("slices"))
    own = F.pmod(F.xxhash64(F.col("hash"), F.lit(7)), F.col("slices")).cast("int")
    met = F.transform(F.sequence(F.lit(0), F.col("slices") - 1), lambda k: F.least(own, k) * F.col("slices") + F.greatest(own, k))
    cells = dealt.join(large, ["mask", "part"], "left").select(
        "hash", "mask", "part", F.explode(F.when(F.col("slices").isNull(), F.array(F.lit(0))).otherwise(met)).alias("cell")
    )
    placed = cells.repartition("mask", "part", "cell").withColumn("rank", gray_rank(F.col("hash")))
    placed = placed.sortWithinPartitions("mask", "part", "cell", "rank").drop("rank")
    return placed.mapInArrow(_bucket_links(t), "a long, b long").distinct()


def near_groups(profile: DataFrame, id_col: str = "path", hash_col: str = "perceptual_hash", t: int = 4) -> DataFrame:
    """``id_col``, ``hash_col`` and ``group``: the smallest id reachable over links of t or fewer differing bits.

    ``profile`` is an image profile, or any frame with a 64-bit hash. Rows with the same hash are linked; a
    row whose hash is NULL stands alone with its own id as group. Repeated rows stay repeated, NULL ids keep the
    group of their hash, an empty frame gives an empty one, and other columns are ignored.
    """
    rows = stored(profile.select(id_col, hash_col))
    known = rows.filter(F.col(hash_col).isNotNull())
    firsts = known.groupBy(F.col(hash_col).alias("node")).agg(F.min(id_col).alias("first"))
    roots = components(hash_links(known, hash_col, t))
    placed = firsts.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    least = placed.groupBy("root").agg(F.min("first").alias("group"))
    groups = placed.join(least, "root").select("node", "group")
    out = rows.join(groups, rows[hash_col] == groups["node"], "left")
    return out.select(rows[id_col], rows[hash_col], F.coalesce(groups["group"], rows[id_col]).alias("group"))
