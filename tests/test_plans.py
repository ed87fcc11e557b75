"""Physical plans of the operators that touch all rows."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from labelops.operators import dedup, metrics, split, threshold

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
HEAVY = ("dedup_exact", "clean_cascade", "stratified_split", "split_overlap", "class_alignment", "ab_match", "reconcile", "threshold_sweep", "confusion", "error_analysis",
         "production_summary", "confused_pairs", "snapshot", "batches", "bbox_union", "crop_decision", "map_upload_label", "centroid_scores", "epoch_index", "label_index")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", HEAVY)
def test_no_pairing_of_everything(spark, name):
    text = plan(driver.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "PythonUDF" not in text


def test_copies_are_pruned_before_the_shuffle(spark):
    text = plan(driver.queries()["dedup_exact"](spark, SF))
    exchange = text.index("Exchange hashpartitioning")
    assert "Partial" in text[exchange:] and text.count("WindowGroupLimit") == 2


def test_split_reads_few_columns_and_sorts_crossed_slices_only(spark):
    text = plan(driver.queries()["stratified_split"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string>" in text and "text" not in text
    whole = text[text.index("Union") : text.index("row_number")]
    assert "BroadcastHashJoin" in whole and "Exchange hashpartitioning" not in whole


def test_sweep_does_not_multiply_rows(spark):
    df = spark.range(1000).select((F.col("id") % 2).cast("int").alias("truth"), (F.col("id") / 1000).alias("score"))
    assert "Generate" not in plan(threshold.threshold_sweep(df))


def test_filters_on_the_matrix_stay_above_the_counts(spark):
    """A filter on a matrix cell must not travel into the (expensive) prediction below."""
    probs = spark.range(50).select((F.col("id") % 3).cast("int").alias("true_idx"), F.array(*[F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000)) / 1000.0 for k in range(3)]).alias("p"))
    df = probs.select("true_idx", metrics.prediction(F.col("p")).alias("pred_idx"))
    pairs = metrics.confusion_pairs(metrics.confusion(df, 3), ["a", "b", "c"])
    assert plan(pairs).count("array_position") == 1
    assert sum(r["n"] for r in pairs.collect()) <= 50


def test_hot_content_and_hot_class(spark):
    """A third of all rows share one content and one class; results stay whole."""
    i = F.col("id")
    df = spark.range(30000).select(
        F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (i % 7).cast("string"))).alias("class"), i.cast("string").alias("file_name"), i.cast("string").alias("path"),
        F.when(i % 3 == 1, "same").otherwise(i.cast("string")).alias("content_hash"),
    )
    assert dedup.dedup_exact(df).count() == 20001
    assert dedup.mark_copies(df, ["content_hash"], dedup.LISTING, ["path"]).where("is_copy").count() == 9999
    out = split.stratified_split(df)
    sizes = {r["class"]: (r["train"], r["val"], r["test"]) for r in split.split_sizes(df).collect()}
    got = {r["class"]: (r["train"], r["val"], r["test"]) for r in split.split_counts(out).where("class is not null").collect()}
    assert got == sizes and sizes["hot"] == (7000, 1500, 1500)


def test_simhashes_shuffle_no_words(spark, tmp_path):
    """One pass over the texts: no row per word, and no text or word is moved."""
    import hashlib

    from labelops.plans import standins

    texts = [None, "", " \t\n", "A b c\x0bD", "Été ÉTÉ x", " ".join(f"w{i % 70_000}" for i in range(150_001))]
    spark.createDataFrame([(i, "en", t) for i, t in enumerate(texts)], "doc_id bigint, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    df = standins.simhashes(spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan

    def brute(body):
        votes = [0] * 64
        for w in (body or "").lower().encode().split():
            h = int.from_bytes(hashlib.md5(w).digest()[:8], "big")
            for b in range(64):
                votes[b] += 1 if h >> (63 - b) & 1 else -1
        h = sum(1 << (63 - b) for b in range(64) if votes[b] > 0)
        return h - (1 << 64) if h >> 63 else h

    assert {r["doc_id"]: r["simhash"] for r in df.collect()} == {i: brute(t) for i, t in enumerate(texts)}
