"""Pixel statistics: one Arrow-batched pass over Spark's image table."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CANVAS = 32
SCHEMA = "path string, width int, height int, channels int, sharpness double, phash bigint"


def rgb_array(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    """Spark's BGR(A) bytes as RGB: gray is repeated, alpha is laid over black."""
    pixels = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    if channels == 1:
        return np.repeat(pixels, 3, axis=2)
    rgb = pixels[:, :, 2::-1]
    if channels == 4:
        alpha = pixels[:, :, 3:].astype(np.uint32)
        rgb = ((rgb * alpha + 127) // 255).astype(np.uint8)
    return rgb


def gray(rgb: np.ndarray) -> np.ndarray:
    """Luma with 14-bit fixed-point weights (fixed values) for R, G, B."""
    weights = np.array([4899, 9617, 1868], np.int64)
    return (rgb.astype(np.int64) @ weights + 8192) >> 14


def laplacian_variance(lum: np.ndarray) -> float:
    """Variance of the 4-neighbour Laplacian; the border is mirrored without repeating the edge."""
    if min(lum.shape) < 2:
        return 0.0
    p = np.pad(lum, 1, mode="reflect")
    lap = p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * lum
    return float(lap.var())


def _shares(source: int, target: int) -> np.ndarray:
    """Row i: how much of each source line falls into target cell i; rows sum to 1."""
    edges = np.arange(target + 1) * source / target
    line = np.arange(source)
    overlap = np.minimum(edges[1:, None], line + 1) - np.maximum(edges[:-1, None], line)
    return np.clip(overlap, 0, None) * target / source


def _fitted(h: int, w: int) -> tuple[int, int]:
    """Height and width of an image fitted on the canvas."""
    scale = min(CANVAS / w, CANVAS / h)
    return max(1, round(h * scale)), max(1, round(w * scale))


def letterboxed(lum: np.ndarray) -> np.ndarray:
    """Area-averaged image fitted on a black square."""
    h, w = lum.shape
    new_h, new_w = _fitted(h, w)
    canvas = np.zeros((CANVAS, CANVAS))
    top, left = (CANVAS - new_h) // 2, (CANVAS - new_w) // 2
    canvas[top : top + new_h, left : left + new_w] = _shares(h, new_h) @ lum @ _shares(w, new_w).T
    return canvas


#: Cosines by canvas line; the C library's cosine, so that the last digit does not hang on the processor.
_COSINES = np.array([[math.cos(math.pi * k * (2 * y + 1) / (2 * CANVAS)) for k in range(8)] for y in range(CANVAS)])


def _basis(source: int, target: int) -> np.ndarray:
    """What each source line adds to the 8 low cosine coefficients of ``target`` lines in the middle of the canvas."""
    shares, top = _shares(source, target), (CANVAS - target) // 2
    out = np.zeros((8, source))
    for y in range(target):
        out += _COSINES[top + y][:, None] * shares[y]
    return out


def dct_hash(lum: np.ndarray) -> int:
    """64 bits: low 8 x 8 cosine coefficients of the letterboxed image above their median.

    Lines, then columns, are added one after another: coefficients that are equal but for the last digit, as a row and a column
    with the same sum give them, then fall on the same side of the median wherever the sum is made."""
    h, w = lum.shape
    new_h, new_w = _fitted(h, w)
    down, across = _basis(h, new_h), _basis(w, new_w)
    half = np.zeros((8, w))
    for i in range(h):
        half += down[:, i, None] * lum[i]
    low = np.zeros((8, 8))
    for j in range(w):
        low += half[:, j, None] * across[:, j]
    bits = (low > np.median(low)).ravel()
    return int(np.packbits(bits).view(">i8")[0])


def border_contrast(rgb: np.ndarray, box) -> float:
    """Distance between the median colours of a box and of the image border."""
    h, w = rgb.shape[:2]
    x1, y1, x2, y2 = box
    crop = rgb[y1:y2, x1:x2].reshape(-1, 3)
    if not crop.size:
        return 0.0
    b = max(2, round(min(w, h) * 0.04))
    sides = (rgb[:b], rgb[-b:], rgb[:, :b], rgb[:, -b:])
    border = np.concatenate([s.reshape(-1, 3) for s in sides])
    return float(np.linalg.norm(np.median(crop, axis=0) - np.median(border, axis=0)))


#: Bytes of pixels a worker is handed at once, whatever number of images that is; a larger image comes alone.
BATCH_BYTES = 64 << 20
BYTE_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def flat_pixels(images: DataFrame, *more: Column) -> DataFrame:
    """(path, height, width, nChannels, data, ...) of an image table, for a Python pass in batches of bounded size.

    Spark hands 10,000 rows to a worker by default, which photos do not fit. The session's limit in bytes is lowered to
    BATCH_BYTES where it is higher or unset; it holds for plans that are made afterwards."""
    conf = images.sparkSession.conf
    limit = int(conf.get(BYTE_LIMIT).rstrip("bB"))
    if not 0 < limit <= BATCH_BYTES:
        conf.set(BYTE_LIMIT, str(BATCH_BYTES))
    return images.select("path", "image.height", "image.width", "image.nChannels", "image.data", *more)


def _statistics(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for path, h, w, c, data in batch.itertuples(index=False):
            if w < 0:
                rows.append((path, -1, -1, -1, None, None))
                continue
            lum = gray(rgb_array(h, w, c, data))
            rows.append((path, w, h, c, laplacian_variance(lum), dct_hash(lum)))
        out = pd.DataFrame(rows, columns=["path", "width", "height", "channels", "sharpness", "phash"])
        out["phash"] = out["phash"].astype("Int64")
        yield out


def pixel_statistics(images: DataFrame) -> DataFrame:
    """Size, sharpness and perceptual hash per image; only these few values leave the Python pass.

    ``images`` has (path, image); unreadable files keep width -1."""
    return flat_pixels(images).mapInPandas(_statistics, SCHEMA)


def sharpness(images: DataFrame) -> DataFrame:
    return pixel_statistics(images).select("path", "sharpness")


def perceptual_hash(images: DataFrame) -> DataFrame:
    return pixel_statistics(images).select("path", "phash")


def _rgb_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        data = [
            rgb_array(h, w, c, d).tobytes() if w >= 0 else None
            for h, w, c, d in zip(batch["height"], batch["width"], batch["nChannels"], batch["data"])
        ]
        more = {c: batch[c] for c in batch.columns[5:]}
        yield pd.DataFrame({"path": batch["path"], "width": batch["width"], "height": batch["height"], "rgb": data, **more})


def to_rgb(images: DataFrame, *more: str) -> DataFrame:
    """(path, width, height, rgb, ...): interleaved RGB bytes, NULL for unreadable files, and the columns of ``images`` named in ``more``.

    Taking a column along saves joining it later, for which every file would be decoded again."""
    schema = T.StructType([
        images.schema["path"], T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType()), T.StructField("rgb", T.BinaryType()),
        *[images.schema[c] for c in more],
    ])
    return flat_pixels(images, *[F.col(c) for c in more]).mapInPandas(_rgb_batches, schema)


def _contrast(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        values = [
            border_contrast(rgb_array(h, w, c, d), box) if w >= 0 else None
            for h, w, c, d, *box in batch.drop(columns="path").itertuples(index=False)
        ]
        yield pd.DataFrame({"path": batch["path"], "contrast": values})


def color_contrast(images: DataFrame) -> DataFrame:
    """(path, contrast) of a ``bbox`` STRUCT<x1,y1,x2,y2> against the image border; 0 without a box."""
    sides = [F.coalesce(F.col(f"bbox.{s}"), F.lit(0)).alias(s) for s in ("x1", "y1", "x2", "y2")]
    return flat_pixels(images, *sides).mapInPandas(_contrast, "path string, contrast double")


def image_profile(images: DataFrame, files: DataFrame) -> DataFrame:
    """Pixel statistics with content hash, size and time of every file.

    Both sides are reduced to a few values per file before the join: no pixels are shuffled."""
    stats = pixel_statistics(images)
    hashed = files.select(*[c for c in files.columns if c != "content"])
    profile = hashed.join(stats, "path", "left")
    return profile.withColumn("width", F.coalesce("width", F.lit(-1))).withColumn(
        "height", F.coalesce("height", F.lit(-1))
    )
