"""Image quality gates and crop/letterbox geometry as ordered CASE expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Quality:
    """Default limits of the quality gate."""

    min_side: int = 100
    max_side: int = 5000
    max_aspect: float = 4.0
    min_sharpness: float = 100.0


@dataclass(frozen=True)
class CropRules:
    """Default limits of the offline crop gate."""

    min_area: float = 0.20
    max_area: float = 0.80
    min_side_ratio: float = 0.25
    min_side_pixels: int = 100
    max_aspect: float = 2.6
    padding: float = 0.16
    min_texture: float = 25.0
    min_contrast: float = 12.0
    min_edge_density: float = 0.006


@dataclass(frozen=True)
class UploadCropRules:
    """Default limits of the upload-time crop gate."""

    min_area: float = 0.02
    max_area: float = 0.92
    min_side_ratio: float = 0.12
    padding: float = 0.12


def quality_reason(w: Column, h: Column, cfg: Quality = Quality()) -> Column:
    ratio = w / F.nullif(h, F.lit(0))
    return (
        F.when((w < cfg.min_side) | (h < cfg.min_side), "image_too_small")
        .when((w > cfg.max_side) | (h > cfg.max_side), "image_too_large")
        .when((w == 0) | (h == 0), "invalid_dimension")
        .when((ratio > cfg.max_aspect) | (ratio < 1 / cfg.max_aspect), "invalid_aspect_ratio")
    )


def blur_reason(sharpness: Column, threshold: float = Quality.min_sharpness) -> Column:
    return F.when(sharpness < threshold, "blurry_image")


def extension_reason(file_name: Column, extensions) -> Column:
    suffix = F.regexp_extract(F.lower(file_name), "^.+\\.([^.]+)$", 1)
    return F.when(~suffix.isin(list(extensions)), "unsupported_extension")


def quality_warnings(reason: Column) -> Column:
    """Lenient mode: the reason is only a warning."""
    return F.array_compact(F.array(reason))


def quality_error(reason: Column, strict: bool) -> Column:
    """Strict mode: the reason turns the row into an error row."""
    return reason if strict else F.lit(None).cast("string")


def expand_bbox(bbox: Column, w: Column, h: Column, ratio: float) -> Column:
    """Grow a STRUCT<x1,y1,x2,y2> by a share of its sides, half-even rounded, inside the image."""
    pad_x = F.rint(F.greatest(bbox["x2"] - bbox["x1"], F.lit(1)) * F.lit(ratio)).cast("int")
    pad_y = F.rint(F.greatest(bbox["y2"] - bbox["y1"], F.lit(1)) * F.lit(ratio)).cast("int")
    return F.when(
        bbox.isNotNull(),
        F.struct(
            F.greatest(F.lit(0), bbox["x1"] - pad_x).cast("int").alias("x1"),
            F.greatest(F.lit(0), bbox["y1"] - pad_y).cast("int").alias("y1"),
            F.least(w, bbox["x2"] + pad_x).cast("int").alias("x2"),
            F.least(h, bbox["y2"] + pad_y).cast("int").alias("y2"),
        ),
    )


def crop_decision(
    df: DataFrame, bbox: str = "bbox", w: str = "width", h: str = "height", cfg: CropRules = CropRules()
) -> DataFrame:
    """Add ``crop``: STRUCT<applied, bbox, reason, area_ratio, texture, contrast, edge_density>.

    Needs the columns texture, contrast and edge_density. Built in steps, so that each intermediate
    value is computed once per row."""
    bw, bh, area = F.col("_bw"), F.col("_bh"), F.col("_area")
    aspect = bw / F.greatest(F.lit(1), bh)
    side = F.least(bw / F.nullif(F.col(w), F.lit(0)), bh / F.nullif(F.col(h), F.lit(0)))
    signal = (
        (F.col("texture") >= cfg.min_texture)
        | (F.col("contrast") >= cfg.min_contrast)
        | (F.col("edge_density") >= cfg.min_edge_density)
    )
    reason = (
        F.when(F.col(bbox).isNull(), "no_bbox")
        .when((bw <= 0) | (bh <= 0), "empty_bbox")
        .when(area < cfg.min_area, "bbox_area_too_small")
        .when(area > cfg.max_area, "bbox_area_too_large")
        .when((bw < cfg.min_side_pixels) | (bh < cfg.min_side_pixels), "bbox_pixel_side_too_small")
        .when(side < cfg.min_side_ratio, "bbox_ratio_side_too_small")
        .when((aspect > cfg.max_aspect) | (aspect < 1 / cfg.max_aspect), "bbox_aspect_too_skewed")
        .when(~F.coalesce(signal, F.lit(False)), "weak_foreground_signal")
        .otherwise("crop_applied")
    )
    why = F.col("_why")

    def measured(name: str) -> Column:
        reached = why.isin("weak_foreground_signal", "crop_applied")
        return F.when(reached, F.col(name).cast("double")).otherwise(F.lit(0.0)).alias(name)

    return (
        _with_box_size(df, bbox, w, h)
        .withColumn("_why", reason)
        .withColumn(
            "crop",
            F.struct(
                (why == "crop_applied").alias("applied"),
                F.col(bbox).alias("bbox"),
                why.alias("reason"),
                F.coalesce(area, F.lit(0.0)).alias("area_ratio"),
                measured("texture"),
                measured("contrast"),
                measured("edge_density"),
            ),
        )
        .drop("_bw", "_bh", "_area", "_why")
    )


def _with_box_size(df: DataFrame, bbox: str, w: str, h: str, tag: str = "") -> DataFrame:
    box, image = F.col(bbox), F.col(w).cast("long") * F.col(h)
    return (
        df.withColumn(f"_bw{tag}", F.greatest(F.lit(0), box["x2"] - box["x1"]))
        .withColumn(f"_bh{tag}", F.greatest(F.lit(0), box["y2"] - box["y1"]))
        .withColumn(
            f"_area{tag}",
            F.when(box.isNotNull(), F.col(f"_bw{tag}").cast("long") * F.col(f"_bh{tag}") / F.greatest(F.lit(1), image)),
        )
    )


def _with_gate(df: DataFrame, method: str, w: str, h: str, cfg: UploadCropRules) -> DataFrame:
    """Grow the method's box and say why it may not be cropped (``ok`` if it may)."""
    tag = f"_{method}"
    grown = df.withColumn(f"_box{tag}", expand_bbox(F.col(method), F.col(w), F.col(h), cfg.padding))
    bw, bh, area = F.col(f"_bw{tag}"), F.col(f"_bh{tag}"), F.col(f"_area{tag}")
    side = F.least(bw / F.nullif(F.col(w), F.lit(0)), bh / F.nullif(F.col(h), F.lit(0)))
    reason = (
        F.when(F.col(method).isNull(), "no_bbox")
        .when((bw <= 0) | (bh <= 0), "empty_bbox")
        .when(area < cfg.min_area, "bbox_too_small")
        .when(area > cfg.max_area, "bbox_too_large")
        .when(side < cfg.min_side_ratio, "bbox_side_too_small")
        .otherwise("ok")
    )
    return _with_box_size(grown, f"_box{tag}", w, h, tag).withColumn(f"_why{tag}", reason)


def choose_crop(
    df: DataFrame, mode: str = "auto", w: str = "width", h: str = "height", cfg: UploadCropRules = UploadCropRules()
) -> DataFrame:
    """Add ``crop``: STRUCT<method, applied, bbox, area_ratio, reason>, the first method whose grown box
    passes the gate. Boxes come in the columns ``contour`` and ``saliency``."""
    if mode not in ("none", "contour", "saliency", "auto"):
        raise ValueError(f"unknown crop mode: {mode}")

    def outcome(method: str, bbox: Column, area: Column, reason: Column) -> Column:
        return F.struct(
            F.lit(method).alias("method"),
            F.lit(method != "none").alias("applied"),
            bbox.alias("bbox"),
            area.alias("area_ratio"),
            reason.alias("reason"),
        )

    def nothing(reason: Column) -> Column:
        return outcome("none", F.lit(None).cast("struct<x1:int,y1:int,x2:int,y2:int>"), F.lit(1.0), reason)

    if mode == "none":
        return df.withColumn("crop", nothing(F.lit("disabled")))
    methods = ("contour", "saliency") if mode == "auto" else (mode,)
    out = df
    choice = F
    for method in methods:
        out = _with_gate(out, method, w, h, cfg)
        passed = outcome(method, F.col(f"_box_{method}"), F.col(f"_area_{method}"), F.lit("ok"))
        choice = choice.when(F.col(f"_why_{method}") == "ok", passed)
    failed = F.concat_ws(";", *[F.concat(F.lit(f"{m}:"), F.col(f"_why_{m}")) for m in methods])
    if mode == "auto":
        failed = F.concat(F.lit("auto_failed:"), failed)
    used = [f"_{part}_{m}" for m in methods for part in ("box", "bw", "bh", "area", "why")]
    return out.withColumn("crop", choice.otherwise(nothing(failed))).drop(*used)


def letterbox(w: Column, h: Column, target_w: int, target_h: int) -> Column:
    """STRUCT<width, height, offset_x, offset_y>: size and place of an image fitted on a canvas."""
    scale = F.least(F.lit(target_w) / w, F.lit(target_h) / h)
    new_w = F.greatest(F.lit(1), F.rint(w * scale).cast("int"))
    new_h = F.greatest(F.lit(1), F.rint(h * scale).cast("int"))
    return F.struct(
        new_w.alias("width"),
        new_h.alias("height"),
        F.floor((F.lit(target_w) - new_w) / 2).cast("int").alias("offset_x"),
        F.floor((F.lit(target_h) - new_h) / 2).cast("int").alias("offset_y"),
    )
