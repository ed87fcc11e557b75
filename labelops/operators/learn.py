"""Gate and class models on feature vectors, and batch scoring."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelops.lineage import broadcast_if_small, cut, join_on
from labelops.operators.labels import checked_label, class_weights
from labelops.operators.metrics import class_metrics, confusion, prediction, summary_metrics, top_confusions, weak_classes
from labelops.operators.threshold import Sweep, binary_metrics, pick_threshold, threshold_sweep


@dataclass
class Gate:
    """A fitted binary gate: model, threshold chosen on val, sweep on val, metrics on test."""

    model: LogisticRegressionModel
    threshold: float
    sweep: DataFrame
    test: DataFrame

    def score(self, df: DataFrame, features: str = "features") -> DataFrame:
        margin = _linear(F.col(features), self.model.coefficients.toArray(), self.model.intercept)
        return df.withColumn("score", 1 / (1 + F.exp(-margin)))


@dataclass
class ClassModel:
    """A fitted class model with its report on test."""

    model: LogisticRegressionModel
    matrix: DataFrame
    metrics: DataFrame
    summary: DataFrame
    weak: DataFrame
    confused: DataFrame

    def score(self, df: DataFrame, features: str = "features") -> DataFrame:
        rows = zip(self.model.coefficientMatrix.toArray(), self.model.interceptVector.toArray())
        out = df.withColumn("_m", F.array(*[_linear(F.col(features), w, b) for w, b in rows]))
        out = out.withColumn("_e", F.transform("_m", lambda m: F.exp(m - F.array_max("_m"))))
        total = F.aggregate("_e", F.lit(0.0), lambda a, e: a + e)
        return out.withColumn("_t", total).withColumn("probs", F.transform("_e", lambda e: e / F.col("_t"))).drop("_m", "_e", "_t")


def _linear(features: Column, weights: Sequence[float], intercept: float) -> Column:
    """weights . features + intercept, as a column; a vector of another length is an error."""
    table = F.array(*[F.lit(float(w)) for w in weights])
    product = F.aggregate(F.zip_with(features, table, lambda x, w: x.cast("double") * w), F.lit(0.0), lambda a, x: a + x)
    wrong = F.raise_error(F.lit(f"expected {len(weights)} features")).cast("double")
    return F.when(F.size(features) == len(weights), product + F.lit(float(intercept))).otherwise(wrong)


def _weighted(train: DataFrame, label: str, clip, features: str, k: int) -> DataFrame:
    """Training rows as vectors; the few class weights come in by a broadcast on the label."""
    rows = train.select(F.col(label).cast("double").alias("label"), array_to_vector(F.col(features)).alias("_v"))
    weights = cut(class_weights(rows, "label", clip, k).select(F.col("class").alias("label"), "weight"))
    return join_on(rows, broadcast_if_small(weights), ["label"])


def _fit(rows: DataFrame, family: str, max_iter: int) -> LogisticRegressionModel:
    """The optimiser reads the vectors once per step, so they are kept for the time of the fit."""
    rows = rows.persist()
    try:
        return LogisticRegression(
            featuresCol="_v", labelCol="label", weightCol="weight", maxIter=max_iter, regParam=1e-3, family=family
        ).fit(rows)
    finally:
        rows.unpersist()


def fit_gate(df: DataFrame, cfg: Sweep = Sweep(), label: str = "truth", features: str = "features", max_iter: int = 50) -> Gate:
    """Fit on ``split = train`` with balanced weights, choose the threshold on val, report on test."""
    rows = _weighted(df.where("split = 'train'"), label, None, features, 2)
    model = _fit(rows, "binomial", max_iter)
    gate = Gate(model, 0.5, None, None)
    scored = gate.score(df.where("split in ('val', 'test')"), features)
    gate.sweep = threshold_sweep(scored.where("split = 'val'"), cfg, label)
    gate.threshold = pick_threshold(gate.sweep, cfg).first()["threshold"]
    gate.test = binary_metrics(scored.where("split = 'test'"), gate.threshold, label)
    return gate


def fit_classes(
    df: DataFrame, k: int, label: str = "label", features: str = "features", clip: tuple[float, float] | None = None,
    weighted: bool = True, max_iter: int = 50,
) -> ClassModel:
    """Fit a softmax model on ``split = train`` and report on test."""
    train = df.where("split = 'train'")
    if weighted:
        rows = _weighted(train, label, clip, features, k)
    else:
        rows = train.select(
            F.col(label).cast("double").alias("label"), array_to_vector(F.col(features)).alias("_v"),
            F.lit(1.0).alias("weight"),
        )
    model = _fit(rows, "multinomial", max_iter)
    out = ClassModel(model, None, None, None, None, None)
    test = out.score(df.where("split = 'test'"), features)
    out.matrix = confusion(test.select(F.col(label).alias("true_idx"), prediction(F.col("probs")).alias("pred_idx")), k)
    out.metrics = class_metrics(out.matrix)
    out.summary = summary_metrics(out.metrics)
    out.weak = weak_classes(out.metrics, "recall")
    out.confused = top_confusions(out.matrix, 3, "desc")
    return out


def score(
    df: DataFrame,
    gate_fn: Callable,
    class_fn: Callable,
    threshold: float = 0.5,
    features: str = "features",
    dim: int | None = None,
    batch_size: int = 1024,
    needs_class: Column | None = None,
) -> DataFrame:
    """Add ``score`` and ``probs`` from user models; the class model runs on rows that pass only.

    Each function builds its model once per worker and returns a predictor over NumPy batches. The
    gated rows are written once, so that the gate runs once per row and a row takes one branch whatever a second
    run would say; they are split by a filter, since a UDF inside a CASE branch would run on every row."""
    shapes = [[dim]] if dim else None
    gate_udf = predict_batch_udf(gate_fn, return_type=T.DoubleType(), batch_size=batch_size, input_tensor_shapes=shapes)
    class_udf = predict_batch_udf(class_fn, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size, input_tensor_shapes=shapes)
    gated = cut(df.withColumn("score", gate_udf(F.col(features))))
    wanted = F.coalesce(F.col("score") >= threshold if needs_class is None else needs_class, F.lit(False))
    passed = gated.where(wanted).withColumn("probs", class_udf(F.col(features)))
    stopped = gated.where(~wanted).withColumn("probs", F.lit(None).cast("array<double>"))
    return passed.unionByName(stopped)


def centroids(df: DataFrame, k: int, label: str = "label", features: str = "embedding") -> DataFrame:
    """Class means: (label, center). One partial aggregate; vectors are never collected. A label outside [0, k) is an error."""
    mean = Summarizer.mean(array_to_vector(F.col(features).cast("array<double>")))
    out = df.groupBy(checked_label(F.col(label), k).alias("label")).agg(mean.alias("_m"))
    return out.select("label", vector_to_array("_m").alias("center"))


def centroid_scores(
    df: DataFrame, centers: DataFrame, k: int, features: str = "embedding", sharpness: float = 100.0
) -> DataFrame:
    """Add ``probs``: softmax over -sharpness * squared distance to the k class means.

    The k x dim means are one bounded value, handed to the rows as a scalar subquery."""
    slots = F.transform(F.array_sort(F.collect_list(F.struct("label", "center"))), lambda s: s["center"])
    fits = F.when(F.count(F.lit(1)) == k, slots).otherwise(F.raise_error(F.lit(f"expected {k} class means")).cast("array<array<double>>"))
    table = centers.agg(fits.alias("c")).scalar()
    x = F.col(features).cast("array<double>")

    def squared(c: Column) -> Column:
        return F.aggregate(F.zip_with(x, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)

    out = df.withColumn("_means", table).withColumn("_d", F.transform("_means", squared))
    best = F.array_min("_d")
    out = out.withColumn("_e", F.transform("_d", lambda d: F.exp(F.lit(-sharpness) * (d - best))))
    total = F.aggregate("_e", F.lit(0.0), lambda s, v: s + v)
    return out.withColumn("_t", total).withColumn("probs", F.transform("_e", lambda e: e / F.col("_t"))).drop("_means", "_d", "_e", "_t")
