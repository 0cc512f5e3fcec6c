"""Image kernels on the rows of Spark's image struct, batched through Arrow.

A raster is ``STRUCT<origin, height, width, nChannels, mode, data>`` with interleaved BGR(A) or grey
bytes; an undecodable file has height and width -1.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.session import long_rows

IMAGE_TYPE = (
    "struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>"
)
MEASURE_TYPE = "struct<blur:double,phash:string>"
# OpenCV type codes of 8-bit rasters by channel count.
MODES = {1: 0, 3: 16, 4: 24}


def raster(height: int, width: int, channels: int, data: bytes) -> np.ndarray | None:
    """Height x width x channels array, or None when the row holds no valid raster."""
    if data is None or pd.isna(height) or height < 1 or width < 1:
        return None
    height, width, channels = int(height), int(width), int(channels)
    pixels = np.frombuffer(data, dtype=np.uint8)
    if pixels.size != height * width * channels:
        return None
    return pixels.reshape(height, width, channels)


def flatten_alpha(pixels: np.ndarray, background: int = 255) -> np.ndarray:
    """BGR raster: four channels are laid over a plain background, one channel is repeated."""
    channels = pixels.shape[2]
    if channels == 3:
        return pixels
    if channels == 1:
        return np.repeat(pixels, 3, axis=2)
    alpha = pixels[:, :, 3:].astype(np.uint32)
    mixed = pixels[:, :, :3] * alpha + background * (255 - alpha) + 127
    return (mixed // 255).astype(np.uint8)


def drop_alpha(pixels: np.ndarray) -> np.ndarray:
    """BGR raster with a fourth channel simply left out."""
    return np.repeat(pixels, 3, axis=2) if pixels.shape[2] == 1 else pixels[:, :, :3]


def _weighted_grey(pixels: np.ndarray, red: int, green: int, blue: int, shift: int) -> np.ndarray:
    bgr = drop_alpha(pixels).astype(np.int64)
    total = bgr[:, :, 2] * red + bgr[:, :, 1] * green + bgr[:, :, 0] * blue
    return (total + (1 << (shift - 1))) >> shift


def grey_levels(pixels: np.ndarray) -> np.ndarray:
    """Luma with 14-bit integer weights."""
    return _weighted_grey(pixels, 4899, 9617, 1868, 14)


def laplacian_variance(pixels: np.ndarray) -> float:
    """Population variance of the 4-neighbour Laplacian of the grey image, borders mirrored."""
    grey = np.pad(grey_levels(pixels), 1, mode="reflect" if min(pixels.shape[:2]) > 1 else "symmetric")
    if min(pixels.shape[:2]) == 1 and max(pixels.shape[:2]) > 1:
        grey = grey_levels(pixels)
        axis = 0 if grey.shape[0] > 1 else 1
        grey = np.pad(grey, [(1, 1) if a == axis else (0, 0) for a in (0, 1)], mode="reflect")
        grey = np.pad(grey, [(0, 0) if a == axis else (1, 1) for a in (0, 1)], mode="edge")
    inner = grey[1:-1, 1:-1]
    around = grey[:-2, 1:-1] + grey[2:, 1:-1] + grey[1:-1, :-2] + grey[1:-1, 2:]
    return float(np.var(around - 4 * inner, dtype=np.float64))


def _lanczos(x: np.ndarray) -> np.ndarray:
    return np.where(np.abs(x) < 3.0, np.sinc(x) * np.sinc(x / 3.0), 0.0)


def _cubic(x: np.ndarray) -> np.ndarray:
    a, x = -0.5, np.abs(x)
    near = ((a + 2.0) * x - (a + 3.0)) * x * x + 1.0
    far = (((x - 5.0) * x + 8.0) * x - 4.0) * a
    return np.where(x < 1.0, near, np.where(x < 2.0, far, 0.0))


FILTERS = {"lanczos": (_lanczos, 3.0), "bicubic": (_cubic, 2.0)}


@lru_cache(maxsize=128)
def resample_weights(size: int, target: int, kind: str) -> np.ndarray:
    """Target x size weight matrix in 22-bit fixed point, the filter widened when shrinking."""
    kernel, radius = FILTERS[kind]
    scale = size / target
    stretch = max(scale, 1.0)
    centres = (np.arange(target) + 0.5) * scale
    places = np.arange(size) + 0.5
    first = np.maximum(np.trunc(centres - radius * stretch + 0.5), 0)
    last = np.minimum(np.trunc(centres + radius * stretch + 0.5), size)
    weights = kernel((places[None, :] - centres[:, None]) / stretch)
    index = np.arange(size)
    weights[(index[None, :] < first[:, None]) | (index[None, :] >= last[:, None])] = 0.0
    weights /= weights.sum(axis=1, keepdims=True)
    return np.trunc(weights * (1 << 22) + np.where(weights < 0, -0.5, 0.5)).astype(np.int64)


def resample(pixels: np.ndarray, width: int, height: int, kind: str) -> np.ndarray:
    """Separable resampling, columns first, each pass rounded to 8 bits.

    Weights and pixels are integers whose sums stay far below 2**53, so matrix products in double
    precision are exact.
    """
    out = pixels.astype(np.float64)
    if width != out.shape[1]:
        weights = resample_weights(out.shape[1], width, kind).astype(np.float64)
        out = np.ascontiguousarray(np.moveaxis(out, 2, 1)) @ weights.T
        out = np.moveaxis(np.clip(np.floor((out + (1 << 21)) / (1 << 22)), 0, 255), 1, 2)
    if height != out.shape[0]:
        weights = resample_weights(out.shape[0], height, kind).astype(np.float64)
        flat = np.ascontiguousarray(out).reshape(out.shape[0], -1)
        rows = np.clip(np.floor((weights @ flat + (1 << 21)) / (1 << 22)), 0, 255)
        out = rows.reshape(height, *out.shape[1:])
    return out.astype(np.uint8)


@lru_cache(maxsize=4)
def _dct_matrix(size: int, rows: int) -> np.ndarray:
    k, n = np.arange(rows)[:, None], np.arange(size)[None, :]
    return 2.0 * np.cos(np.pi * k * (2 * n + 1) / (2 * size))


def perceptual_hash(pixels: np.ndarray, side: int = 8, factor: int = 4) -> str:
    """64-bit hash: low frequencies of the 32 x 32 luma's cosine transform against their median."""
    luma = _weighted_grey(pixels, 19595, 38470, 7471, 16)[:, :, None]
    size = side * factor
    small = resample(luma, size, size, "lanczos")[:, :, 0].astype(np.float64)
    basis = _dct_matrix(size, side)
    low = np.round(basis @ small @ basis.T, 6)
    bits = (low > np.median(low)).ravel()
    return f"{int(''.join('1' if b else '0' for b in bits), 2):0{side * side // 4}x}"


def fit_inside(width: int, height: int, box: tuple[int, int]) -> tuple[int, int]:
    """Largest size with the same aspect ratio inside the box."""
    ratio, wanted = width / height, box[0] / box[1]
    if ratio > wanted:
        return box[0], max(1, round(height / width * box[0]))
    if ratio < wanted:
        return max(1, round(width / height * box[1])), box[1]
    return box


def letterboxed(pixels: np.ndarray, box: tuple[int, int], white_alpha: bool = False) -> np.ndarray:
    """BGR raster of exactly ``box`` (width, height): fitted, centred, black around it."""
    bgr = flatten_alpha(pixels) if white_alpha else drop_alpha(pixels)
    width, height = fit_inside(bgr.shape[1], bgr.shape[0], box)
    fitted = resample(bgr, width, height, "bicubic")
    canvas = np.zeros((box[1], box[0], 3), dtype=np.uint8)
    top, left = round((box[1] - height) * 0.5), round((box[0] - width) * 0.5)
    canvas[top : top + height, left : left + width] = fitted
    return canvas


def _rows(images: pd.DataFrame):
    for h, w, c, d in zip(images["height"], images["width"], images["nChannels"], images["data"]):
        yield raster(h, w, c, d)


def measure(image: Column | str) -> Column:
    """Blur measure and perceptual hash of a raster, nulls for an undecodable one."""

    long_rows()

    @F.pandas_udf(MEASURE_TYPE)
    def measures(images: pd.DataFrame) -> pd.DataFrame:
        found = [
            (None, None) if p is None else (laplacian_variance(p), perceptual_hash(p)) for p in _rows(images)
        ]
        return pd.DataFrame(found, columns=["blur", "phash"])

    return measures(image)


def blur(image: Column | str) -> Column:
    """Blur measure alone."""

    long_rows()

    @F.pandas_udf("double")
    def variance(images: pd.DataFrame) -> pd.Series:
        return pd.Series([math.nan if p is None else laplacian_variance(p) for p in _rows(images)])

    return F.nanvl(variance(image), F.lit(None).cast("double"))


def letterbox(image: Column | str, size: tuple[int, int] = (512, 512), white_alpha: bool = False) -> Column:
    """Raster fitted into ``size`` (width, height); null for an undecodable one."""

    long_rows()

    @F.pandas_udf(IMAGE_TYPE)
    def boxes(images: pd.DataFrame) -> pd.DataFrame:
        out = []
        for origin, pixels in zip(images["origin"], _rows(images)):
            if pixels is None:
                out.append((origin, None, None, None, None, None))
            else:
                data = letterboxed(pixels, size, white_alpha).tobytes()
                out.append((origin, size[1], size[0], 3, MODES[3], data))
        frame = pd.DataFrame(out, columns=["origin", "height", "width", "nChannels", "mode", "data"])
        return frame.astype({c: "Int32" for c in ("height", "width", "nChannels", "mode")})

    return boxes(image)


def colour(image: Column | str) -> Column:
    """Raster as three colour channels: grey is repeated, a fourth channel left out; null for an undecodable one."""

    long_rows()

    @F.pandas_udf(IMAGE_TYPE)
    def coloured(images: pd.DataFrame) -> pd.DataFrame:
        out = []
        for origin, pixels in zip(images["origin"], _rows(images)):
            if pixels is None:
                out.append((origin, None, None, None, None, None))
            else:
                bgr = drop_alpha(pixels)
                out.append((origin, *bgr.shape, MODES[3], bgr.tobytes()))
        frame = pd.DataFrame(out, columns=["origin", "height", "width", "nChannels", "mode", "data"])
        return frame.astype({c: "Int32" for c in ("height", "width", "nChannels", "mode")})

    return coloured(image)


def is_valid(image: Column | str) -> Column:
    """True for a decoded raster with as many bytes as its size says."""
    c = F.col(image) if isinstance(image, str) else image
    size = c["height"].cast("bigint") * c["width"] * c["nChannels"]
    return F.coalesce((c["height"] > 0) & (c["width"] > 0) & (F.octet_length(c["data"]) == size), F.lit(False))


def white_raster(side: int = 224) -> Column:
    """Plain white square, used when unreadable images are to be kept."""
    return F.struct(
        F.lit(None).cast("string").alias("origin"),
        F.lit(side).alias("height"),
        F.lit(side).alias("width"),
        F.lit(3).alias("nChannels"),
        F.lit(MODES[3]).alias("mode"),
        F.rpad(F.lit(b"\xff"), side * side * 3, F.lit(b"\xff")).alias("data"),
    )
