"""Small helpers for text columns: stable remainders, ASCII words, word hashes, batches of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: the white space that separates words.
SPACE = r"[\x20\x09-\x0D]"
#: Text a Python step works on at once.
BATCH_BYTES = 8_000_000
BYTE_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Entries a worker's word cache holds before it starts afresh; what it returns does not depend on it.
CACHE_WORDS = 400_000


def remainder(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n: a split of the rows that stays the same at every size."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(n)


def ascii_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, as UTF-8."""
    return (text or "").encode("utf-8", "replace").lower().split()


class WordHashes(dict):
    """64-bit hash of a word, remembered; bounded, since it starts afresh when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def hashed_words(texts: list[str | None], cache: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and where each text starts (one more entry than texts)."""
    parts, starts = [], np.zeros(len(texts) + 1, np.int64)
    for i, text in enumerate(texts):
        words = ascii_words(text)
        parts.append(np.fromiter(map(cache.__getitem__, words), np.uint64, len(words)))
        starts[i + 1] = starts[i] + len(words)
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), starts


def pieces(batches: Iterator[pa.RecordBatch], text_col: str, size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text, so that memory does not follow the batch size."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.nan_to_num(np.asarray(pa.compute.binary_length(batch.column(text_col)).to_numpy(zero_copy_only=False), float))
        group = (np.cumsum(sizes) // size).astype(np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def small_batches(spark: SparkSession) -> None:
    """Hand whole rows to workers in batches of about BATCH_BYTES; the session's limit is lowered where it is higher or unset."""
    limit = int(spark.conf.get(BYTE_LIMIT).rstrip("bB"))
    if not 0 < limit <= BATCH_BYTES:
        spark.conf.set(BYTE_LIMIT, str(BATCH_BYTES))


def plus(df: DataFrame, id_col: str, fields: list[tuple[str, T.DataType]]) -> T.StructType:
    """Schema of the id column followed by new fields."""
    return T.StructType([T.StructField(id_col, df.schema[id_col].dataType)] + [T.StructField(n, t) for n, t in fields])


def record(batch_ids: pa.Array, schema: T.StructType, columns: list) -> pa.RecordBatch:
    """A batch of the id column and new columns, in the types of the schema."""
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(schema)
    arrays = [batch_ids.cast(target.field(0).type)] + [
        c.cast(target.field(i).type) if isinstance(c, pa.Array) else pa.array(c, type=target.field(i).type)
        for i, c in enumerate(columns, 1)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=target)
