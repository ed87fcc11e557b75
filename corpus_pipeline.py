"""A corpus pipeline of five stages; each takes the documents its predecessor kept and returns those it keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelops.lineage import stored
from labelops.llm import decontaminate, language, line_dedup, near_groups, packing, text


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; learned from the labelled ones among them."""
    model = language.learn(docs.filter(text.remainder("doc_id", 4) != 2), "lang", "text", "doc_id")
    return language.keep_identified(docs, model, "doc_id")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines of any length that repeat an earlier line up to a few edits."""
    return line_dedup.drop_repeated_lines(docs, "doc_id", min_chars=0).withColumn("n_chars", F.length("text").cast("long"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id.

    Documents without an id stay if one of them is in no group with an id; repeated rows of the document that stays all stay.
    """
    groups = near_groups.near_groups(near_groups.simhash(docs, "doc_id"), "doc_id", "simhash")
    first = groups.filter(F.col("group").eqNullSafe(F.col("doc_id"))).select(F.col("doc_id").alias("_first")).distinct()
    return docs.join(first, docs["doc_id"].eqNullSafe(first["_first"]), "left_semi").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "doc_id")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their token ids, packed into token windows."""
    return packing.pack(docs, "doc_id").withColumnsRenamed({"doc_id_tokens": "doc_tokens", "sequence": "sequence_id"})


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Learned models, tokenizers and edit joins have no SQL form; tests/llm compares the operators below the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
