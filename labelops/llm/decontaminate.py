"""Benchmark passages in texts: spaced-seed hashes, then substitution-tolerant overlaps around each hit.

A seed hashes the words of a short window under a fixed mask and ignores the others, so a replaced word breaks only
the seeds that look at it. Seeds of the benchmark and of the texts are joined; around a hit both are compared
word by word along the same diagonal, and the longest stretch in which enough words agree is kept.

The project has no running text; the operator is general and takes any frame with an id (``path``) and a text column.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelops.llm import text

#: Which words of a window a seed looks at. Five each.
MASKS = ("11111", "1101011", "11001101")
#: More masks (as salt, mask, least and most words of an item) for short items. From five words on they meet every item
#: with one replaced word; below that all words have to be equal.
SHORT_MASKS = (*((10 + n, "1" * n, n, n) for n in range(1, 5)), (20, "111", 5, 7), (21, "1101", 5, 7))
#: A stretch has at least so many words, or all words of a shorter item.
MIN_WORDS = 13
SIMILARITY = 0.8
#: Shorter items are not searched unless asked for.
MIN_ITEM_WORDS = 5
#: Benchmark words whose seeds are compared with the texts at once; a larger benchmark takes more rounds.
BLOCK_WORDS = 500_000
SIEVE_BITS = 22


def _seeds(hashes: np.ndarray, mask: str, salt: int) -> np.ndarray:
    """Seed of every window of a word sequence under a mask."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, (salt * 0x9E3779B97F4A7C15) % 2**64, np.uint64)
    for i, c in enumerate(mask):
        if c == "1":
            total = (total + hashes[i : i + n]) * np.uint64(0xD6E8FEB86659FD93)
            total ^= total >> np.uint64(32)
    return total


class Seeds:
    """Seeds of a block of benchmark items, in one sorted array behind a sieve of bits."""

    def __init__(self, ids: list, texts: list[str | None], min_item_words: int = MIN_ITEM_WORDS):
        self.ids = ids
        self.words, self.starts = text.hashed_words(texts, text.WordHashes())
        found, items, places = [], [], []
        sizes = np.diff(self.starts)
        self.masks = [(salt, mask) for salt, mask in enumerate(MASKS)]
        for salt, mask, least, most in [(salt, mask, 1, np.inf) for salt, mask in self.masks] + list(SHORT_MASKS):
            fit = np.flatnonzero((sizes >= max(least, min_item_words)) & (sizes <= most)).tolist()
            if most < np.inf and fit:
                self.masks.append((salt, mask))
            for i in fit:
                a, b = self.starts[i], self.starts[i + 1]
                s = _seeds(self.words[a:b], mask, salt)
                found.append(s)
                items.append(np.full(len(s), i))
                places.append(np.arange(len(s)))
        seeds = np.concatenate(found) if found else np.empty(0, np.uint64)
        order = np.argsort(seeds, kind="stable")
        self.seeds = seeds[order]
        self.item = (np.concatenate(items) if items else np.empty(0, int))[order]
        self.place = (np.concatenate(places) if places else np.empty(0, int))[order]
        self.sieve = np.zeros(1 << SIEVE_BITS, bool)
        self.sieve[self.seeds >> np.uint64(64 - SIEVE_BITS)] = True

    def hits(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Distinct (text, item, text place - item place) of all seed hits; ``starts`` bounds the texts."""
        out = []
        owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        for salt, mask in self.masks:
            s = _seeds(words, mask, salt)
            at = np.flatnonzero(self.sieve[s >> np.uint64(64 - SIEVE_BITS)])
            at = at[owner[at] == owner[at + len(mask) - 1]]
            low = np.searchsorted(self.seeds, s[at], "left")
            n = np.searchsorted(self.seeds, s[at], "right") - low
            at, low, n = at[n > 0], low[n > 0], n[n > 0]
            hit = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = np.repeat(at, n)
            out.append(np.stack([owner[at], self.item[hit], at - starts[owner[at]] - self.place[hit]], 1))
        return np.unique(np.concatenate(out), axis=0)

    def overlap(self, words: np.ndarray, item: int, shift: int, share: float) -> tuple[int, int, int] | None:
        """Longest stretch on a diagonal with at least ``share`` equal words: (item place, words, equal words)."""
        wanted = self.words[self.starts[item] : self.starts[item + 1]]
        a, b = max(0, -shift), min(len(wanted), len(words) - shift)
        equal = wanted[a:b] == words[a + shift : b + shift]
        # in whole numbers, so that a share of exactly 0.8 counts
        per, need = 1000, round(share * 1000)
        total = np.concatenate(([0], np.cumsum(np.where(equal, per - need, -need))))
        low = np.minimum.accumulate(total)
        best = None
        for end in range(len(equal), 0, -1):
            if best and end <= best[1]:
                break
            if not equal[end - 1]:
                continue
            # first start from which the sum up to end is not negative
            start = int(np.searchsorted(-low[:end], -total[end], "left"))
            while start < end and not equal[start]:
                start += 1
            if start < end and (best is None or end - start > best[1]):
                best = (start, end - start, int(equal[start:end].sum()))
        return (a + best[0], best[1], best[2]) if best else None


def benchmark_overlaps(
    items: DataFrame, benchmark: DataFrame, id_col: str = "path", text_col: str = "text", item_col: str = "item_id",
    min_words: int = MIN_WORDS, similarity: float = SIMILARITY, min_item_words: int = MIN_ITEM_WORDS,
) -> DataFrame:
    """One row per text and benchmark item it holds a passage of: the longest overlap.

    ``id_col``, ``item_col``, ``start`` and ``item_start`` (words before the overlap in either), ``words``, ``equal``. Words are split at
    ASCII white space and lower-cased A-Z. An overlap starts and ends with equal words, has at least ``min_words`` words or
    as many as a shorter item, and at least the share ``similarity`` of them equal. NULL and empty texts hold nothing;
    items under ``min_item_words`` words are not searched (1: all are; those under five words are found where all words are equal). Repeated rows give repeated results.

    The benchmark is compared in blocks of bounded size, each against all texts.
    """
    spark = items.sparkSession
    sized = benchmark.select(F.col(item_col).alias("id"), F.col("text").alias("text")).withColumn("words", F.size(F.split(F.coalesce("text", F.lit("")), text.SPACE + "+")))
    total = sized.agg(F.sum("words")).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_WORDS))
    schema = text.plus(items, id_col, [(item_col, benchmark.schema[item_col].dataType)] + [(c, T.LongType()) for c in ("start", "item_start", "words", "equal")])
    source = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = None
    for block in range(blocks):
        mine = sized.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).select("id", "text").collect()
        shared = spark.sparkContext.broadcast(Seeds([r["id"] for r in mine], [r["text"] for r in mine], min_item_words))
        found = source.mapInArrow(_search(shared, schema, min_words, similarity), schema)
        out = found if out is None else out.unionByName(found)
    return out


def _search(shared, schema: T.StructType, min_words: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds: Seeds = shared.value
        cache = text.WordHashes()
        for batch in text.pieces(batches, "text"):
            words, starts = text.hashed_words(batch.column("text").to_pylist(), cache)
            best: dict[tuple[int, int], tuple] = {}
            for row, item, shift in seeds.hits(words, starts).tolist() if len(seeds.seeds) else []:
                found = seeds.overlap(words[starts[row] : starts[row + 1]], item, shift, similarity)
                least = min(min_words, int(seeds.starts[item + 1] - seeds.starts[item]))
                if found and found[1] >= least:
                    value = (found[1], found[2], -(found[0] + shift), -found[0])
                    best[row, item] = max(value, best.get((row, item), value))
            keys = list(best)
            values = [best[k] for k in keys]
            ids = batch.column("id").take(pa.array([k[0] for k in keys], pa.int64()))
            yield text.record(ids, schema, [
                [seeds.ids[k[1]] for k in keys], [-v[2] for v in values], [-v[3] for v in values], [v[0] for v in values], [v[1] for v in values]
            ])

    return run


def drop_contaminated(items: DataFrame, benchmark: DataFrame, id_col: str = "path", text_col: str = "text") -> DataFrame:
    """The items without those that hold a passage of the benchmark; a NULL id is never dropped by another's passage."""
    held = benchmark_overlaps(items, benchmark, id_col, text_col).select(F.col(id_col).alias("_held")).filter("_held is not null").distinct()
    return items.join(held, items[id_col] == held["_held"], "left_anti").select(*items.columns)
