"""Training-run histories and comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelops.lineage import broadcast_if_small, cut, join_on

METRICS = ("test_accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_f1")


def latest_run(df: DataFrame, prefix: str, col: str = "name") -> DataFrame:
    """One row: the last run name with a prefix (names end in a time stamp)."""
    return df.where(F.col(col).startswith(prefix)).agg(F.max(col).alias(col))


def normalize_metrics(report: DataFrame, kv: DataFrame) -> DataFrame:
    """Per run MAP metric -> value: report metrics overlaid by the key/value file's metrics.

    Inputs are long tables (run, metric, value)."""
    both = report.select("run", "metric", "value", F.lit(0).alias("_p")).unionByName(
        kv.select("run", "metric", "value", F.lit(1).alias("_p"))
    )
    merged = both.groupBy("run", "metric").agg(F.max_by("value", "_p").alias("value"))
    maps = merged.groupBy("run").agg(F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("m"))
    m = F.col("m")

    def at(name: str) -> Column:
        return F.try_element_at(m, F.lit(name))

    accuracy = F.coalesce(at("test_accuracy_reference_only"), at("test_accuracy"), at("accuracy"))
    rest = F.map_filter(m, lambda k, _: k != "test_accuracy")
    own = F.when(accuracy.isNotNull(), F.create_map(F.lit("test_accuracy"), accuracy))
    return maps.select("run", F.when(own.isNull(), rest).otherwise(F.map_concat(rest, own)).alias("metrics"))


def is_family(name: Column, input_shape: Column, word: str = "mobilenet", shape: Sequence[int] = (224, 224, 3)) -> Column:
    """The run's model name contains a word or its input has a given shape."""
    same = input_shape == F.array(*[F.lit(s) for s in shape])
    return F.coalesce(F.lower(name).contains(word), F.lit(False)) | F.coalesce(same, F.lit(False))


def stage_boundaries(history: DataFrame) -> DataFrame:
    """Per (run, stage): length, epochs before it and the running total. ``stage_pos`` orders stages."""
    earlier = Window.partitionBy("run").orderBy("stage_pos").rowsBetween(Window.unboundedPreceding, -1)
    return (
        history.groupBy("run", "stage", "stage_pos")
        .agg(F.count(F.lit(1)).alias("epochs"))
        .withColumn("before", F.coalesce(F.sum("epochs").over(earlier), F.lit(0)))
        .withColumn("boundary", F.col("before") + F.col("epochs"))
    )


def epoch_index(history: DataFrame) -> DataFrame:
    """Add ``epoch``: 1-based number over all stages of a run. ``i`` is the place inside the stage, so
    only the stage lengths need to be summed; the epochs themselves are never sorted."""
    starts = cut(stage_boundaries(history).select("run", "stage_pos", "before"))
    return (
        join_on(history, broadcast_if_small(starts), ["run", "stage_pos"])
        .withColumn("epoch", F.col("before") + F.col("i") + 1)
        .drop("before")
    )


def run_summary(history: DataFrame) -> DataFrame:
    """Per run: best validation accuracy, lowest validation loss, epochs."""
    return history.groupBy("run").agg(
        F.max("val_accuracy").alias("best_val_accuracy"),
        F.min("val_loss").alias("min_val_loss"),
        F.count(F.lit(1)).alias("total_epochs"),
    )


def metric_rows(summary: DataFrame, metrics: DataFrame, names: Sequence[str] = METRICS) -> DataFrame:
    """Run summary with the test metrics as columns; a missing metric is NULL."""
    wide = metrics.select("run", *[F.try_element_at("metrics", F.lit(n)).alias(n) for n in names])
    return join_on(summary, wide, ["run"], "left").select(
        "run", *names, "best_val_accuracy", "min_val_loss", "total_epochs"
    )


def best_run(runs: DataFrame) -> DataFrame:
    """One row: the run with the highest macro f1 (else accuracy, else -1); the last name on a tie."""
    score = F.coalesce("macro_f1", "test_accuracy", F.lit(-1.0))
    top = F.max(F.struct(score.alias("score"), F.col("run").alias("run"))).alias("top")
    return runs.agg(top).select(F.col("top.run").alias("run"), F.col("top.score").alias("score"))


def best_stage(history: DataFrame) -> DataFrame:
    """Per run the stage with the lowest validation loss; the later stage on a tie."""
    per_stage = history.groupBy("run", "stage", "stage_pos").agg(F.min("val_loss").alias("val_loss"))
    scored = per_stage.where(F.col("val_loss").isNotNull())
    low = F.min(F.struct("val_loss", (-F.col("stage_pos")).alias("o"), "stage")).alias("low")
    return scored.groupBy("run").agg(low).select(
        "run", F.col("low.stage").alias("stage"), F.col("low.val_loss").alias("val_loss")
    )


def compare_runs(rows: DataFrame, a: str, b: str, names: Sequence[str] = METRICS) -> DataFrame:
    """Per metric: value of run a, value of run b, difference."""
    long = rows.where(F.col("run").isin(a, b)).select("run", *[F.col(n).cast("double").alias(n) for n in names]).unpivot(
        ["run"], list(names), "metric", "value"
    )
    sides = long.groupBy("metric").agg(
        F.max(F.when(F.col("run") == a, F.col("value"))).alias("a"),
        F.max(F.when(F.col("run") == b, F.col("value"))).alias("b"),
    )
    return sides.withColumn("delta", F.col("a") - F.col("b"))
