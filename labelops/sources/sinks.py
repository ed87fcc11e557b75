"""Split datasets, CSV, JSON lines, JSON reports, class lists and metric files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelops.operators.validate import reconcile
from labelops.sources import publish
from labelops.sources.publish import hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = hadoop_path(spark, path)
    return fs.exists(target)


def write_splits(df: DataFrame, root: str, clean_output: bool = False, keys=("split", "class", "file_name")) -> int:
    """Write ``split=/class=`` partitions, compare them with the plan, then publish them as the next version of ``root``.

    The rebalance hint lets Spark put small classes together and spread a large one over many files. Until the manifest is
    there readers see the version before; that one is kept for readers that have begun, older ones go. Returns the version."""
    spark = df.sparkSession
    if path_exists(spark, root) and not clean_output:
        raise FileExistsError(f"output exists, pass clean_output to replace it: {root}")
    draft = publish.Draft(df, root, ("split", "class"))
    problems = reconcile(df.select(*keys), _text_folders(draft.schema, spark, draft.path).select(*keys), keys)
    example = problems.first()
    if example is not None:
        draft.discard()
        raise ValueError(f"written rows differ from the plan: {example}")
    draft.schema = _folder_schema(draft.schema)
    version = draft.commit(partitions=["split", "class"])
    publish.expire(spark, root)
    return version


def _folder_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) if f.name in ("split", "class") else f for f in schema.fields])


def _text_folders(schema: T.StructType, spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_folder_schema(schema)).parquet(path)


def read_splits(spark: SparkSession, root: str, schema: T.StructType | None = None, version: int | None = None) -> DataFrame:
    """Read a published split dataset, or a plain ``split=/class=`` folder; folder values stay text, whatever they look like."""
    found = publish.manifest(spark, root, version)
    if found is not None:
        return publish.read_published(spark, root, found["version"])
    return _text_folders(schema or spark.read.parquet(root).schema, spark, root)


def csv_cells(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fixed column order; arrays, maps and structs as JSON text."""
    nested = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))}
    return df.select(*[F.to_json(c).alias(c) if c in nested else F.col(c) for c in cols])


def write_csv(df: DataFrame, path: str, cols: Sequence[str] | None = None, single: bool = False, mode: str = "overwrite") -> None:
    """CSV with a header; NULL becomes an empty cell. ``single`` is for small summaries only."""
    flat = csv_cells(df, cols or df.columns)
    flat = flat.coalesce(1) if single else flat
    flat.write.mode(mode).csv(path, header=True, nullValue="", emptyValue="", escape='"')


def json_lines(df: DataFrame) -> DataFrame:
    """(value): each row as the JSON text a line of ``write_jsonl`` holds; NULL fields are left out."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def _in_key_order(col: Column, kind: T.DataType) -> Column:
    """The value with the fields of its structs in name order, at every depth."""
    if isinstance(kind, T.StructType):
        fields = [_in_key_order(col[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda x: _in_key_order(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(col, lambda _, v: _in_key_order(v, kind.valueType))
    return col


def report_json(df: DataFrame, created_at: bool = False) -> DataFrame:
    """A one-row frame as one JSON text with the keys of all its objects in order."""
    if created_at:
        df = df.withColumn("created_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"))
    fields = [_in_key_order(F.col(f.name), f.dataType).alias(f.name) for f in sorted(df.schema.fields, key=lambda f: f.name)]
    return df.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"))


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    report_json(df, created_at=True).coalesce(1).write.mode(mode).text(path)


def write_class_names(classes: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One class per line in label order, from (class, label): a class list, not rows."""
    classes.orderBy("label").select("class").coalesce(1).write.mode(mode).text(path)


def label_manifest(classes: DataFrame, stage: str = "B", image_size: tuple[int, int] = (320, 320)) -> DataFrame:
    """One row with class_names, class_to_index and index_to_class from (class, label)."""
    pairs = F.array_sort(F.collect_list(F.struct("label", "class")))
    return classes.agg(pairs.alias("p")).select(
        F.lit(stage).alias("stage"),
        F.transform("p", lambda s: s["class"]).alias("class_names"),
        F.map_from_entries(F.transform("p", lambda s: F.struct(s["class"], s["label"]))).alias("class_to_index"),
        F.map_from_entries(F.transform("p", lambda s: F.struct(s["label"].cast("string"), s["class"]))).alias("index_to_class"),
        F.size("p").alias("num_classes"),
        F.array(*[F.lit(x) for x in image_size]).alias("image_size"),
    )


def hard_class_lines(analysis: DataFrame) -> DataFrame:
    """Two lines per weak class: its metrics and what it is confused with (class order)."""
    def four(col: Column) -> Column:
        return F.format_string("%.4f", col)

    head = F.concat(
        F.col("class_name"), F.lit(" | precision="), four(F.col("precision")), F.lit(" | recall="), four(F.col("recall")),
        F.lit(" | f1="), four(F.col("f1")), F.lit(" | support="), F.col("support").cast("string"),
    )
    listed = F.transform(
        "top_confusions",
        lambda s: F.concat(s["class_name"], F.lit(" (count="), s["count"].cast("string"), F.lit(", rate="), four(s["rate"]), F.lit(")")),
    )
    body = F.when(F.size("top_confusions") > 0, F.array_join(listed, ", ")).otherwise(F.lit("none"))
    lines = F.array(head, F.concat(F.lit("  confused_with: "), body))
    return analysis.where("weak").select("class_idx", F.posexplode(lines).alias("line_no", "value"))


# Keys of the two metric files, in file order.
BINARY_KEYS = (
    "selected_fruit_threshold", "accuracy", "macro_f1", "balanced_accuracy", "other_precision", "other_recall",
    "other_f1", "fruit_precision", "fruit_recall", "fruit_f1", "true_other_pred_other",
    "other_misclassified_as_fruit", "fruit_misclassified_as_other", "true_fruit_pred_fruit",
)
CLASS_KEYS = (
    "selected_stage", "test_loss", "test_accuracy_reference_only", "macro_precision", "macro_recall", "macro_f1",
    "weighted_precision", "weighted_recall", "weighted_f1",
)


def kv_lines(row: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(line_no, value): ``key: value`` lines of a one-row frame; four decimals for the threshold, six
    for other numbers, counts and text as they are."""
    kinds = {f.name: f.dataType for f in row.schema.fields}

    def text(key: str) -> Column:
        if isinstance(kinds[key], (T.DoubleType, T.FloatType)):
            return F.format_string("%.4f" if key == "selected_fruit_threshold" else "%.6f", F.col(key))
        return F.col(key).cast("string")

    lines = F.array(*[F.concat(F.lit(f"{k}: "), text(k)) for k in keys])
    return row.select(F.posexplode(lines).alias("line_no", "value"))


def binary_kv(metrics: DataFrame) -> DataFrame:
    """Metric lines of the gate from a ``binary_metrics`` row."""
    row = metrics.select(
        "*", F.col("threshold").alias("selected_fruit_threshold"), F.col("tn").alias("true_other_pred_other"),
        F.col("tp").alias("true_fruit_pred_fruit"),
    )
    return kv_lines(row, BINARY_KEYS)


def class_kv(summary: DataFrame, stage: str, loss: float) -> DataFrame:
    """Metric lines of the class model from a ``summary_metrics`` row."""
    row = summary.select(
        "*", F.lit(stage).alias("selected_stage"), F.lit(float(loss)).alias("test_loss"),
        F.col("accuracy").alias("test_accuracy_reference_only"),
    )
    return kv_lines(row, CLASS_KEYS)


def write_kv_metrics(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    lines.orderBy("line_no").select("value").coalesce(1).write.mode(mode).text(path)
