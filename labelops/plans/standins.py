"""The given tables seen as image collections and prediction tables.

The test tables hold no images, so documents stand in for labelled files, embeddings with a
nearest-mean model for predictions, and document labels for the binary gate. Routed rows are
checkpointed, as an audit's prediction table is: a filter on a late column would otherwise be pushed
below the scoring and score every row again."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelops.lineage import cut
from labelops.operators.learn import centroid_scores, centroids
from labelops.operators.metrics import prediction
from labelops.operators.split import stratified_split
from labelops.plans.flows import routed_production, routed_uploads

K = 10
NAMES = tuple(f"class_{i}" for i in range(K))
ADJECTIVES = ("small", "red", "blue", "hot", "large", "old", "new", "green", "cold")
NOUNS = ("ring", "widget", "bolt", "plate", "rod", "gear", "nut", "pipe", "valve")
PART_CLASSES = tuple(f"{a}_{n}" for a in ADJECTIVES for n in NOUNS)
PART_RULES = {f"{a}_{n}": n for a in ADJECTIVES for n in ("ring", "bolt", "plate")}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def items(spark: SparkSession, sf: str, *more: Column) -> DataFrame:
    """Documents as profiled files, with further columns of the table. The content hash doubles as the perceptual hash."""
    text = F.col("text")
    suffix = F.when(F.col("source") == "src7", ".txt").otherwise(".JPG")
    return table(spark, sf, "documents").select(
        F.col("lang").alias("class"),
        F.concat_ws("_", "lang", "source").alias("raw_class"),
        F.concat(F.lpad(F.col("doc_id").cast("string"), 8, "0"), suffix).alias("file_name"),
        F.col("doc_id").alias("path"),
        F.col("n_chars").cast("int").alias("width"),
        (100 * (1 + F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))))).cast("int").alias("height"),
        (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("double").alias("sharpness"),
        F.sha2(text, 256).alias("content_hash"),
        *more,
    ).withColumn("phash", F.col("content_hash"))


def split_items(spark: SparkSession, sf: str) -> DataFrame:
    """The narrow listing is written once, since the split reads it several times."""
    return stratified_split(cut(items(spark, sf)))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings with class scores: (vec_id, true_idx, probs)."""
    vectors = table(spark, sf, "embeddings")
    means = centroids(vectors, K)
    return centroid_scores(vectors, means, K).select("vec_id", F.col("label").alias("true_idx"), "probs")


def predicted(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf).withColumn("pred_idx", prediction(F.col("probs")))


def gate(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents as gate scores: (doc_id, truth, score)."""
    docs = table(spark, sf, "documents").select("doc_id", F.least(F.col("n_chars") / F.lit(3000.0), F.lit(1.0)).alias("score"))
    return table(spark, sf, "labels").select("doc_id", F.col("quality").alias("truth")).join(docs, "doc_id")


def name_of(col: Column) -> Column:
    return F.concat(F.lit("class_"), col.cast("string"))


def uploads(spark: SparkSession, sf: str) -> DataFrame:
    """Scored uploads: labels 0-6 supported, 7-8 unsupported, 9 out of scope."""
    label = F.col("true_idx")
    return scored(spark, sf).select(
        F.lpad(F.col("vec_id").cast("string"), 8, "0").alias("image_path"),
        "vec_id",
        name_of(label).alias("normalized_label"),
        F.when(label <= 6, name_of(label)).alias("true_label"),
        F.when(label <= 6, "supported").when(label <= 8, "unsupported_v1").otherwise("out_of_scope").alias("group"),
        (F.pmod(F.col("vec_id") * 37, F.lit(100)) / 100).alias("score"),
        "probs",
    )


def flow_rows(spark: SparkSession, sf: str) -> DataFrame:
    return cut(routed_uploads(uploads(spark, sf), NAMES, 0.3, 0.6))


def production_rows(spark: SparkSession, sf: str) -> DataFrame:
    return cut(routed_production(uploads(spark, sf), NAMES))


def history(spark: SparkSession, sf: str) -> DataFrame:
    """Events as training histories: user = run, day = stage, hour of the day = epoch."""
    hours = table(spark, sf, "events").groupBy(
        F.concat(F.lit("run_"), F.lpad(F.col("user_id").cast("string"), 6, "0")).alias("run"),
        F.date_format("ts", "yyyy-MM-dd").alias("stage"),
        F.datediff("ts", F.lit("2024-01-01")).alias("stage_pos"),
        F.hour("ts").alias("hour"),
    ).agg(
        F.min("value").alias("loss"), F.max("value").alias("val_loss"), F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("event_type") == "click").alias("hits"),
    )
    return hours.withColumn("val_accuracy", F.col("hits") / F.col("n"))


def words(spark: SparkSession, sf: str) -> DataFrame:
    """Every word of every document."""
    return table(spark, sf, "documents").select("doc_id", "lang", F.explode(F.split("text", "\\s+")).alias("word")).where(
        F.col("word") != ""
    )


#: Words a task remembers, and words of a text that are added up at once.
CACHE_WORDS, ADDED_WORDS = 400_000, 100_000


class _WordBits(dict):
    """First 64 bits of each word's md5, remembered; starts afresh when full."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        bits = self[word] = hashlib.md5(word).digest()[:8]
        return bits


def _simhash(words: list[bytes], known: _WordBits) -> int:
    """A bit is set when more than half of the words have it."""
    ones = np.zeros(64, np.int64)
    for a in range(0, len(words), ADDED_WORDS):
        bits = np.frombuffer(b"".join(map(known.__getitem__, words[a : a + ADDED_WORDS])), np.uint8)
        ones += np.unpackbits(bits).reshape(-1, 64).sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(words)).view(">i8")[0])


def simhashes(spark: SparkSession, sf: str) -> DataFrame:
    """64-bit simhash of all lower-cased words per document; bit i from the words' md5."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", F.lower("text").cast("binary").alias("text"))
    schema = T.StructType([docs.schema["doc_id"], docs.schema["lang"], T.StructField("simhash", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordBits()
        for batch in batches:
            # ``bytes.split`` parts words at the same six characters as the pattern \\s of the SQL functions
            hashes = [_simhash((body.as_py() or b"").split(), known) for body in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(hashes, pa.int64())], names=schema.names)

    return docs.mapInArrow(run, schema)
