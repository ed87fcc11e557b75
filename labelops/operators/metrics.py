"""Confusion matrices and everything derived from them.

The prediction table is reduced to K x K counts by one partial aggregate; all later steps run on that
matrix, whose size depends on the class list only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelops.functions.scores import safe_rate
from labelops.operators.labels import checked_label


def confusion(df: DataFrame, k: int, truth: str = "true_idx", pred: str = "pred_idx") -> DataFrame:
    """Dense matrix as rows (true_idx, pred_idx, n); unseen cells are 0, labels outside [0, k) an error.

    Zero cells are added by a union, and labels are checked after counting, on k * k rows."""
    counts = df.groupBy(F.col(truth).alias("t"), F.col(pred).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    cell = F.col("id")
    grid = df.sparkSession.range(k * k).select(
        F.floor(cell / k).cast("int").alias("true_idx"), (cell % k).cast("int").alias("pred_idx"), F.lit(0).cast("long").alias("n")
    )
    seen = counts.select(
        checked_label(F.col("t"), k).alias("true_idx"), checked_label(F.col("p"), k).alias("pred_idx"), "n"
    )
    return grid.unionByName(seen).groupBy("true_idx", "pred_idx").agg(F.sum("n").alias("n"))


def with_names(df: DataFrame, names: Sequence[str], col: str, out: str) -> DataFrame:
    return df.withColumn(out, F.get(F.array(*[F.lit(n) for n in names]), F.col(col)))


def class_metrics(cm: DataFrame) -> DataFrame:
    """Per class precision, recall, f1, support, predicted count and true positives."""
    hit = F.when(F.col("true_idx") == F.col("pred_idx"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("true_idx").alias("c"), F.col("n").alias("s"), zero.alias("p"), hit.alias("t")),
        F.struct(F.col("pred_idx").alias("c"), zero.alias("s"), F.col("n").alias("p"), zero.alias("t")),
    )
    sums = cm.select(F.inline(sides)).groupBy(F.col("c").alias("class_idx")).agg(
        F.sum("s").alias("support"), F.sum("p").alias("predicted_count"), F.sum("t").alias("true_positives")
    )
    p = safe_rate(F.col("true_positives"), F.col("predicted_count"))
    r = safe_rate(F.col("true_positives"), F.col("support"))
    return (
        sums.withColumn("precision", p)
        .withColumn("recall", r)
        .withColumn(
            "f1", safe_rate(2.0 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
        )
    )


def summary_metrics(metrics: DataFrame) -> DataFrame:
    """One row: accuracy, macro and weighted precision/recall/f1 over all classes."""
    total = F.sum("support")
    weighted = [safe_rate(F.sum(F.col(m) * F.col("support")), total).alias(f"weighted_{m}")
                for m in ("precision", "recall", "f1")]
    return metrics.agg(
        total.alias("samples"),
        safe_rate(F.sum("true_positives"), total).alias("accuracy"),
        *[F.avg(m).alias(f"macro_{m}") for m in ("precision", "recall", "f1")],
        *weighted,
    )


def weak_classes(metrics: DataFrame, rule: str = "recall_or_f1", threshold: float = 0.6) -> DataFrame:
    """Classes below the threshold in recall, or (first rule) in recall or f1; lowest recall first."""
    low = F.col("recall") < threshold
    if rule == "recall_or_f1":
        low = low | (F.col("f1") < threshold)
    elif rule != "recall":
        raise ValueError(f"unknown rule: {rule}")
    order = ["recall", "f1", "class_name"] if "class_name" in metrics.columns else ["recall", "f1", "class_idx"]
    return metrics.where(low).orderBy(*order)


def top_confusions(cm: DataFrame, k: int = 3, tie: str = "asc") -> DataFrame:
    """Up to k most frequent wrong predictions per true class; ``tie`` orders equal counts by index."""
    support = F.sum("n").over(Window.partitionBy("true_idx"))
    last = F.col("pred_idx").asc() if tie == "asc" else F.col("pred_idx").desc()
    place = F.row_number().over(Window.partitionBy("true_idx").orderBy(F.col("n").desc(), last))
    return (
        cm.withColumn("support", support)
        .where((F.col("true_idx") != F.col("pred_idx")) & (F.col("n") > 0))
        .withColumn("place", place)
        .where(F.col("place") <= k)
        .select("true_idx", "pred_idx", "n", safe_rate(F.col("n"), F.col("support")).alias("rate"), "place")
    )


def confusion_pairs(cm: DataFrame, names: Sequence[str], k: int = 10) -> DataFrame:
    """Unordered pairs by n(i->j) + n(j->i); ties by larger direction, then names, all descending."""
    t, p, n = F.col("true_idx"), F.col("pred_idx"), F.col("n")
    pairs = (
        cm.groupBy(F.least(t, p).alias("i"), F.greatest(t, p).alias("j"))
        .agg(F.sum(F.when(t < p, n).otherwise(0)).alias("n_forward"), F.sum(F.when(t > p, n).otherwise(0)).alias("n_backward"))
        .withColumn("n", F.col("n_forward") + F.col("n_backward"))
        .where(F.col("n") > 0)
    )
    named = with_names(with_names(pairs, names, "i", "first"), names, "j", "second")
    order = [F.col("n").desc(), F.greatest("n_forward", "n_backward").desc(), F.col("first").desc(), F.col("second").desc()]
    return named.select("first", "second", "n", "n_forward", "n_backward").orderBy(*order).limit(k)


def error_analysis(cm: DataFrame, names: Sequence[str], k: int = 5, threshold: float = 0.6) -> DataFrame:
    """Per class all metrics, the weak flag and its top confusions as an array of structs."""
    top = with_names(top_confusions(cm, k), names, "pred_idx", "class_name")
    lists = top.groupBy(F.col("true_idx").alias("class_idx")).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("place", "class_name", F.col("n").alias("count"), "rate"))),
            lambda s: F.struct(s["class_name"].alias("class_name"), s["count"].alias("count"), s["rate"].alias("rate")),
        ).alias("top_confusions")
    )
    metrics = with_names(class_metrics(cm), names, "class_idx", "class_name")
    weak = (F.col("recall") < threshold) | (F.col("f1") < threshold)
    none = F.array().cast("array<struct<class_name:string,count:bigint,rate:double>>")
    return (
        metrics.join(lists, "class_idx", "left")
        .withColumn("top_confusions", F.coalesce("top_confusions", none))
        .withColumn("weak", weak)
    )


def directed_pairs(analysis: DataFrame) -> DataFrame:
    """All listed confusions as (source, target, count, rate), most frequent first."""
    flat = analysis.select(F.col("class_name").alias("source"), "class_idx", F.posexplode("top_confusions"))
    return flat.select(
        "source", F.col("col.class_name").alias("target"), F.col("col.count").alias("count"),
        F.col("col.rate").alias("rate"), "class_idx", "pos",
    ).orderBy(F.col("count").desc(), F.col("rate").desc(), "class_idx", "pos").drop("class_idx", "pos")


def sanity_loss(df: DataFrame, ceiling: float = 10.0, label: str = "true_idx", probs: str = "probs") -> DataFrame:
    """One row: mean cross-entropy of a prediction table and whether it is finite and low enough."""
    p = F.get(F.col(probs), F.col(label)).cast("double")
    loss = F.avg(-F.log(F.greatest(p, F.lit(1e-7))))
    finite = F.col("loss").isNotNull() & ~F.isnan("loss") & (F.abs("loss") != float("inf"))
    return df.agg(F.count(F.lit(1)).alias("samples"), loss.alias("loss")).withColumn(
        "sane", F.coalesce(finite & (F.col("loss") <= ceiling), F.lit(False))
    )


def prediction(probs: Column) -> Column:
    """Index of the highest score, the lower index on a tie."""
    return (F.array_position(probs, F.array_max(probs)) - 1).cast("int")
