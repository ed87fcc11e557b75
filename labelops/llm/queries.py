"""Driver queries of the numbered operators: the given tables in, the contract's columns out."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelops.lineage import shared_folder
from labelops.llm import archives, brown, decontaminate, language, line_dedup, line_frequency, near_groups, ownership, packing, page_text, prefix_trie, repair, sequences, text, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_toxicity(spark, sf):
    docs = _table(spark, sf, "documents")
    marks = _table(spark, sf, "labels").filter(text.remainder("doc_id", 5) != 0)
    found = toxicity.score(docs, toxicity.learn(docs, "toxic", "text", "doc_id", marks=marks), "doc_id")
    return found.select(
        "doc_id", (text.remainder("doc_id", 5) == 0).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
        F.size("segments").alias("n_segments"),
    )


@query
def op2_line_links(spark, sf):
    return line_dedup.line_links(_table(spark, sf, "documents"), "doc_id", min_chars=0)


@query
def op10_near_groups(spark, sf):
    hashes = near_groups.simhash(_table(spark, sf, "documents"), "doc_id")
    groups = near_groups.near_groups(hashes, "doc_id", "simhash")
    return groups.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), F.col("group").alias("component_id"))


@query
def op5_benchmark_overlaps(spark, sf):
    return decontaminate.benchmark_overlaps(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"), "doc_id", min_item_words=1)


@query
def op7_pack(spark, sf):
    pieces = packing.pack(_table(spark, sf, "documents"), "doc_id")
    return pieces.drop("ids").withColumnsRenamed({"doc_id_tokens": "doc_tokens", "sequence": "sequence_id"})


@query
def op9_language(spark, sf):
    docs = _table(spark, sf, "documents")
    held = text.remainder("doc_id", 4) == 2
    model = language.learn(docs.filter(~held), "lang", "text", "doc_id")
    found = language.identify(docs, model, "doc_id")
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query
def op3_page_text(spark, sf):
    pages = _table(spark, sf, "pages")
    found = page_text.main_text(pages.select("page_id", "url", "html").withColumn("page", F.struct("page_id", "url")), page_text.learn(pages), "page")
    return found.select("page.page_id", "page.url", "text", "n_chars", "n_blocks")


@query
def op4_class_model(spark, sf):
    docs = _table(spark, sf, "documents")
    held = text.remainder("doc_id", 10) == 0
    return brown.learn_and_score(docs, ~held, "doc_id").withColumn("held_out", held)


@query
def op6_line_frequency(spark, sf):
    return line_frequency.quality(_table(spark, sf, "documents"), "doc_id").drop("text")


@query
def op8_secrets(spark, sf):
    found = ownership.secrets(_table(spark, sf, "documents"), "doc_id", "source", "doc_id")
    return found.withColumn("base_sha256", F.sha2("base_spans", 256)).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "live_spans"
    )


@query
def op12_prefix_trie(spark, sf):
    turns = _table(spark, sf, "conversations").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).filter("conv_id is not null")
    turns = sequences.numbered(turns, "conv_id", [F.col("turn"), F.col("role"), F.col("text")]).drop("turn")
    cut = text.remainder("conv_id", 6)
    convs = turns.filter("pos = 0").select("conv_id", cut.alias("head"), (F.col("conv_id") - F.col("conv_id") % 100).alias("base"))
    starts = turns.filter("pos < 5").select(F.col("conv_id").alias("base"), "pos", "role", "text")
    heads = convs.join(starts, "base").filter("pos < head").select("conv_id", "pos", "role", "text")
    rebuilt = turns.filter(F.col("pos") >= cut).select("conv_id", "pos", "role", "text").unionByName(heads)
    nodes, ends = prefix_trie.history_trie(rebuilt, convs, "conv_id", "pos", "role", "text")
    shas = sequences.joined_sha256(ends.withColumn("id", F.col("conv_id").cast("string")), prefix_trie.SPOT, ["conv_id"], "id", ",", "ends_sha256")
    nodes = nodes.join(shas, prefix_trie.SPOT, "left")
    return nodes.select(
        "conv_id", "depth", F.col("parent_conv_id"), F.col("n_runs").alias("n_convs"), "n_children", "n_leaves", F.col("saved_chars").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


@query
def op13_log_repair(spark, sf):
    turns = _table(spark, sf, "conversations").filter("conv_id is not null")
    filled = turns.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    name = F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    damage = F.crc32(name.cast("binary")) % 20
    damaged = filled.filter(damage != 0).select(
        "conv_id", "turn", F.when(damage == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(damage == 1, F.lit("")).when(damage == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(damage == 3, 2).otherwise(1))).alias("copy"),
    )
    repaired, audit = repair.repair_logs(damaged, "conv_id", "turn")
    lines = repaired.filter("edit <> 'D'").select("conv_id", "place", F.concat("role", F.lit(":"), "text").alias("line"))
    shas = sequences.joined_sha256(lines, ["conv_id"], ["place"], "line", "\n", "repaired_sha256")
    found = turns.select("conv_id").distinct().join(audit, "conv_id", "left").join(shas, "conv_id", "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


@query
def op11_warc(spark, sf):
    pages = _table(spark, sf, "pages").select("page_id", "url", F.col("html").cast("binary").alias("html"))
    folder = f"{shared_folder(spark)}/{uuid.uuid4()}"
    index = archives.archive_files(pages, folder, "page_id", "html", "url", kind="text/html; charset=utf-8")
    found = archives.read_files(index, folder)
    return found.select(
        F.col("path").try_cast("long").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type",
        F.col("refers_to").try_cast("long").alias("refers_to"),
    )
