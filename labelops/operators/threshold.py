"""Binary gate metrics and the threshold sweep."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelops.functions.scores import safe_rate


@dataclass(frozen=True)
class Sweep:
    """Default threshold grid and recall targets."""

    start: float = 0.30
    end: float = 0.80
    step: float = 0.01
    min_fruit_recall: float = 0.90
    min_other_recall: float = 0.85

    @property
    def grid(self) -> list[float]:
        """Evenly stepped values. The step is taken between the first two of them, so that value i is
        start + i * ((start + step) - start) in floating point."""
        if self.step <= 0 or self.start >= self.end:
            raise ValueError("need step > 0 and start < end")
        delta = (self.start + self.step) - self.start
        size = math.ceil((self.end + self.step / 2.0 - self.start) / self.step)
        return [self.start + i * delta for i in range(size)]


def _derive(df: DataFrame) -> DataFrame:
    """All metrics from tn, fp, fn, tp."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    df = (
        df.withColumn("other_precision", safe_rate(tn, tn + fn))
        .withColumn("other_recall", safe_rate(tn, tn + fp))
        .withColumn("fruit_precision", safe_rate(tp, tp + fp))
        .withColumn("fruit_recall", safe_rate(tp, tp + fn))
        .withColumn("accuracy", safe_rate(tn + tp, tn + fp + fn + tp))
    )
    for side in ("other", "fruit"):
        p, r = F.col(f"{side}_precision"), F.col(f"{side}_recall")
        df = df.withColumn(f"{side}_f1", safe_rate(2.0 * p * r, p + r))
    return df.select(
        "threshold", "other_precision", "other_recall", "other_f1", "fruit_precision", "fruit_recall", "fruit_f1",
        "accuracy",
        ((F.col("other_f1") + F.col("fruit_f1")) / 2.0).alias("macro_f1"),
        ((F.col("other_recall") + F.col("fruit_recall")) / 2.0).alias("balanced_accuracy"),
        F.least("other_recall", "fruit_recall").alias("min_recall"),
        F.col("fp").alias("other_misclassified_as_fruit"),
        F.col("fn").alias("fruit_misclassified_as_other"),
        "tn", "fp", "fn", "tp",
    )


def binary_metrics(df: DataFrame, t: float, truth: str = "truth", score: str = "score") -> DataFrame:
    """One row of metrics at a threshold; label 1 is predicted when score >= threshold."""
    yes, pred = F.col(truth) == 1, F.col(score).cast("double") >= F.lit(float(t))
    counts = df.agg(
        F.count_if(~yes & ~pred).alias("tn"), F.count_if(~yes & pred).alias("fp"),
        F.count_if(yes & ~pred).alias("fn"), F.count_if(yes & pred).alias("tp"),
    )
    return _derive(counts.withColumn("threshold", F.lit(float(t))))


def _reached(score: Column, cfg: Sweep) -> Column:
    """How many thresholds of the grid a score reaches: a guess by division, then compared exactly."""
    grid = cfg.grid
    values = F.array(*[F.lit(v) for v in grid])
    guess = F.floor((score - F.lit(cfg.start)) / F.lit(cfg.step)).cast("int")
    guess = F.greatest(F.lit(-1), F.least(F.lit(len(grid) - 1), guess))
    up = F.coalesce(F.get(values, guess + 1) <= score, F.lit(False))
    down = F.coalesce(F.get(values, guess) > score, F.lit(False))
    return guess + 1 + F.when(up, 1).otherwise(0) - F.when(down, 1).otherwise(0)


def threshold_sweep(df: DataFrame, cfg: Sweep = Sweep(), truth: str = "truth", score: str = "score") -> DataFrame:
    """Metrics for every threshold of the grid.

    The rows are not multiplied by the grid: one aggregate counts both labels per number of reached
    thresholds (at most len(grid) + 1 groups), and running sums over that histogram give all counts."""
    grid = cfg.grid
    yes = F.col(truth) == 1
    hist = df.groupBy(_reached(F.col(score).cast("double"), cfg).cast("long").alias("id")).agg(
        F.count_if(yes).alias("pos"), F.count_if(~yes).alias("neg")
    )
    bins = df.sparkSession.range(len(grid) + 1).join(hist, "id", "left").na.fill(0, ["pos", "neg"])
    at_least = Window.orderBy(F.col("id").desc())
    everything = Window.partitionBy()
    counts = bins.select(
        F.get(F.array(*[F.lit(v) for v in grid]), (F.col("id") - 1).cast("int")).alias("threshold"),
        F.sum("pos").over(at_least).alias("tp"),
        F.sum("neg").over(at_least).alias("fp"),
        F.sum("pos").over(everything).alias("all_pos"),
        F.sum("neg").over(everything).alias("all_neg"),
    ).where(F.col("threshold").isNotNull())
    return _derive(
        counts.withColumn("fn", F.col("all_pos") - F.col("tp")).withColumn("tn", F.col("all_neg") - F.col("fp"))
    )


def pick_threshold(sweep: DataFrame, cfg: Sweep = Sweep()) -> DataFrame:
    """The chosen row: among thresholds that meet both recall targets (else among all) the best by
    macro f1, lowest recall, balanced accuracy, fruit recall, other recall, closeness to 0.5, and the
    earliest on a full tie. ``feasible`` tells which rule applied."""
    ok = (F.col("fruit_recall") >= cfg.min_fruit_recall) & (F.col("other_recall") >= cfg.min_other_recall)
    best = [F.col(c).desc() for c in ("macro_f1", "min_recall", "balanced_accuracy", "fruit_recall", "other_recall")]
    order = [F.col("feasible").desc(), *best, F.abs(F.col("threshold") - 0.5).asc(), F.col("threshold").asc()]
    return sweep.withColumn("feasible", ok).orderBy(*order).limit(1)


def top_thresholds(sweep: DataFrame, k: int = 20) -> DataFrame:
    order = [F.col("macro_f1").desc(), F.col("balanced_accuracy").desc(), F.col("threshold")]
    return sweep.orderBy(*order).limit(k)
