"""Readers for class lists, manifests, metric files and training histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelops.constants import OTHER

HISTORY = "struct<accuracy:array<double>,val_accuracy:array<double>,loss:array<double>,val_loss:array<double>>"
MANIFEST = T.StructType(
    [
        T.StructField("stage", T.StringType()),
        T.StructField("task", T.StringType()),
        T.StructField("class_names", T.ArrayType(T.StringType())),
        T.StructField("class_to_index", T.MapType(T.StringType(), T.IntegerType())),
        T.StructField("index_to_class", T.MapType(T.StringType(), T.StringType())),
        T.StructField("num_classes", T.IntegerType()),
        T.StructField("image_size", T.ArrayType(T.IntegerType())),
        T.StructField("fruit_threshold", T.DoubleType()),
    ]
)


def _checked_names(names: Column, forbidden: Sequence[str] = ()) -> Column:
    """Class list that is not empty and holds no blank, repeated or forbidden name."""

    def fail(text: str) -> Column:
        return F.raise_error(F.lit(text)).cast("array<string>")

    checked = (
        F.when(F.coalesce(F.size(names), F.lit(0)) <= 0, fail("class list is empty"))
        .when(F.exists(names, lambda n: n == ""), fail("class list has a blank name"))
        .when(F.size(F.array_distinct(names)) != F.size(names), fail("class list has a repeated name"))
    )
    if forbidden:
        taken = F.arrays_overlap(names, F.array(*[F.lit(f) for f in forbidden]))
        checked = checked.when(taken, fail("class list has a forbidden name"))
    return checked.otherwise(names)


def _whole(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).withColumn("_file", F.col("_metadata.file_path"))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumn("_file", F.col("_metadata.file_path"))


def _folder(file: Column) -> Column:
    return F.regexp_replace(file, "/[^/]*$", "")


def parse_class_names(value: Column, forbidden: Sequence[str] = ()) -> Column:
    """Checked names from the text of a class list: JSON list, JSON object with ``class_names``, or lines."""
    body = F.trim(value)
    lines = F.filter(F.transform(F.split(value, "\\R"), lambda x: F.trim(x)), lambda x: x != "")
    names = (
        F.when(body.startswith("["), F.from_json(body, "array<string>"))
        .when(body.startswith("{"), F.from_json(body, "struct<class_names:array<string>>")["class_names"])
        .otherwise(lines)
    )
    return _checked_names(F.transform(names, lambda n: F.trim(n)), forbidden)


def read_class_names(spark: SparkSession, path: str) -> DataFrame:
    """(pos, class_name) from a JSON list, a JSON object with ``class_names`` or text lines."""
    return _whole(spark, path).select(F.posexplode(parse_class_names(F.col("value"))).alias("pos", "class_name"))


def parse_manifest(value: Column, forbidden: Sequence[str] = (OTHER,)) -> Column:
    """STRUCT of the ``MANIFEST`` fields from a manifest's JSON text; its class list is checked."""
    manifest = F.from_json(value, MANIFEST)
    return manifest.withField("class_names", _checked_names(manifest["class_names"], forbidden))


def read_manifest(spark: SparkSession, path: str, forbidden: Sequence[str] = (OTHER,)) -> DataFrame:
    """Label manifest with a checked class list."""
    return _whole(spark, path).select(parse_manifest(F.col("value"), forbidden).alias("m")).select("m.*")


def open_fields(value: Column) -> Column:
    """MAP name -> VARIANT of a JSON object's fields, whatever they are; NULL for any other text."""
    parsed = F.try_parse_json(value)
    return F.when(F.schema_of_variant(parsed).startswith("OBJECT"), parsed).cast("map<string,variant>")


def unknown_fields(value: Column, known: Sequence[str]) -> Column:
    """MAP name -> JSON text of the fields a fixed schema does not have, so that files whose keys drift lose nothing."""
    rest = F.map_filter(open_fields(value), lambda k, _: ~k.isin(list(known)))
    return F.transform_values(rest, lambda _, v: F.to_json(v))


def parse_open_manifest(value: Column, forbidden: Sequence[str] = (OTHER,)) -> Column:
    """``parse_manifest`` with ``unknown``: the fields that are not in ``MANIFEST``."""
    return parse_manifest(value, forbidden).withField("unknown", unknown_fields(value, MANIFEST.fieldNames()))


def parse_weak_classes(value: Column) -> Column:
    """Requested names from a JSON list or an object's ``weak_classes``; lower case, no blanks."""
    body = F.trim(value)
    names = F.when(body.startswith("["), F.from_json(body, "array<string>")).otherwise(
        F.from_json(body, "struct<weak_classes:array<string>>")["weak_classes"]
    )
    return F.filter(F.transform(names, lambda n: F.lower(F.trim(n))), lambda n: n != "")


def read_weak_classes(spark: SparkSession, path: str) -> DataFrame:
    """(requested) names of a weak-class file."""
    return _whole(spark, path).select(F.explode(parse_weak_classes(F.col("value"))).alias("requested"))


def parse_kv_metrics(lines: DataFrame) -> DataFrame:
    """(run, metric, value) from (run, value) lines ``key: value``; text values drop out."""
    parts = F.split("value", ":", 2)
    return lines.where(F.col("value").contains(":")).select(
        "run", F.trim(parts[0]).alias("metric"), F.trim(F.get(parts, F.lit(1))).try_cast("double").alias("value")
    ).where(F.col("value").isNotNull())


def read_kv_metrics(spark: SparkSession, path: str) -> DataFrame:
    """(run, metric, value) from ``key: value`` files; the run is the file's folder."""
    return parse_kv_metrics(_lines(spark, path).withColumn("run", _folder(F.col("_file"))))


def parse_report_metrics(lines: DataFrame) -> DataFrame:
    """(run, metric, value) from the accuracy, macro avg and weighted avg lines among (run, value) lines."""
    line = F.trim("value")
    parts = F.split(line, "\\s+")

    def triple(prefix: str) -> Column:
        return F.array(*[
            F.struct(F.lit(f"{prefix}_{m}").alias("metric"), F.get(parts, F.lit(i)).try_cast("double").alias("value"))
            for i, m in ((2, "precision"), (3, "recall"), (4, "f1"))
        ])

    one = F.array(F.struct(F.lit("test_accuracy").alias("metric"), F.get(parts, F.lit(1)).try_cast("double").alias("value")))
    found = (
        F.when(line.startswith("accuracy"), one)
        .when(line.startswith("macro avg") & (F.size(parts) >= 5), triple("macro"))
        .when(line.startswith("weighted avg") & (F.size(parts) >= 5), triple("weighted"))
    )
    return lines.select("run", F.inline(found)).where(F.col("value").isNotNull())


def read_report_metrics(spark: SparkSession, path: str) -> DataFrame:
    """(run, metric, value) from text reports; the run is the file's folder."""
    return parse_report_metrics(_lines(spark, path).withColumn("run", _folder(F.col("_file"))))


def parse_history(texts: DataFrame) -> DataFrame:
    """(run, stage, stage_pos, i, accuracy, val_accuracy, loss, val_loss), one row per epoch, from (run, value) JSON texts.

    Stages come in the fixed order stage1, stage2, hard_mining, then as written; a stage has as many
    epochs as losses and shorter arrays give NULL."""
    preferred = ["stage1", "stage2", "hard_mining"]
    listed = F.array(*[F.lit(p) for p in preferred])
    keys = F.json_object_keys("value")
    stages = F.filter(
        F.array_union(F.array_intersect(listed, keys), F.array_except(keys, listed)), lambda k: k != "config"
    )

    def parse(stage: Column) -> Column:
        raw = F.call_function("get_json_object", F.col("value"), F.concat(F.lit("$['"), stage, F.lit("']")))
        return F.struct(stage.alias("stage"), F.when(raw.startswith("{"), F.from_json(raw, HISTORY)).alias("h"))

    objects = F.filter(F.transform(stages, parse), lambda s: s["h"].isNotNull())
    per_stage = texts.select("run", F.posexplode(objects).alias("stage_pos", "s"))
    per_epoch = per_stage.select("run", "stage_pos", F.col("s.stage").alias("stage"), "s.h", F.posexplode("s.h.loss").alias("i", "loss"))
    others = [F.get(F.col(f"h.{m}"), F.col("i")).alias(m) for m in ("accuracy", "val_accuracy", "val_loss")]
    return per_epoch.select("run", "stage", "stage_pos", "i", *others[:2], "loss", others[2])


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Epochs of history files (see ``parse_history``); the run is the file's folder."""
    return parse_history(_whole(spark, path).withColumn("run", _folder(F.col("_file"))))


HISTORY_METRICS = ("accuracy", "val_accuracy", "loss", "val_loss")


def parse_more_metrics(texts: DataFrame) -> DataFrame:
    """(run, stage, metric, i, value): epoch values of the metrics a history has besides the four of ``parse_history``.

    An entry of a list that is no number is NULL; what is no list (a learning rate, a note) has no epochs and is left to
    ``unknown_fields``."""
    stages = texts.select("run", F.explode(open_fields(F.col("value"))).alias("stage", "body")).where(F.col("stage") != "config")
    inner = F.when(F.schema_of_variant("body").startswith("OBJECT"), F.col("body")).cast("map<string,variant>")
    fields = stages.select("run", "stage", F.explode(inner).alias("metric", "entries")).where(~F.col("metric").isin(*HISTORY_METRICS))
    lists = F.when(F.schema_of_variant("entries").startswith("ARRAY"), F.col("entries")).cast("array<variant>")
    entries = fields.select("run", "stage", "metric", F.posexplode(lists).alias("i", "entry"))
    return entries.select("run", "stage", "metric", "i", F.try_variant_get("entry", "$", "double").alias("value"))


def read_more_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Further metrics of history files (see ``parse_more_metrics``); the run is the file's folder."""
    return parse_more_metrics(_whole(spark, path).withColumn("run", _folder(F.col("_file"))))


def read_run_configs(spark: SparkSession, path: str) -> DataFrame:
    """(run, model_path, manifest_path, input_shape) from the ``config`` object of histories."""
    schema = "struct<final_model_path:string,label_manifest_path:string,input_shape:array<int>>"
    config = F.from_json(F.get_json_object("value", "$.config"), schema)
    return _whole(spark, path).select(
        _folder(F.col("_file")).alias("run"),
        config["final_model_path"].alias("model_path"),
        config["label_manifest_path"].alias("manifest_path"),
        config["input_shape"].alias("input_shape"),
    )
