"""Text and image vectors: a built-in hashing encoder and a hook for real models."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import images as I
from larder.functions import text as T
from larder.session import long_rows

Encoder = Callable[[pd.Series], np.ndarray]


def token_hashes(text: Column | str, method: str = "xxhash64") -> Column:
    """Integer hash of each token of the cleaned text."""
    words = F.filter(F.split(T.clean_text(text, stop=None), " "), lambda w: w != "")
    if method == "xxhash64":
        return F.transform(words, lambda t: F.xxhash64(t))
    if method == "md5":
        return F.transform(words, lambda t: F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("bigint"))
    raise ValueError(f"unknown hash: {method}")


def signed_counts(hashes: Column, dim: int) -> Column:
    """Unit vector of signed token counts: position ``h mod dim``, sign from the parity of ``h div dim``."""

    long_rows()

    @F.arrow_udf("array<float>")
    def count(lists: pa.Array) -> pa.Array:
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        h = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        rows = np.repeat(np.arange(len(lists)), lengths)
        signs = np.where((h // dim) % 2 == 0, 1.0, -1.0)
        sums = np.bincount(rows * dim + h % dim, weights=signs, minlength=len(lists) * dim)
        vectors = sums.astype(np.float64).reshape(len(lists), dim)
        norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
        vectors = np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)
        flat = pa.array(vectors.astype(np.float32).ravel(), type=pa.float32())
        return pa.ListArray.from_arrays(pa.array(np.arange(len(lists) + 1) * dim, pa.int32()), flat)

    return count(hashes)


def hash_embed(
    df: DataFrame, text_col: str, dim: int = 64, method: str = "xxhash64", out: str = "embedding"
) -> DataFrame:
    """Add a deterministic unit vector of the text; tokens are split and hashed in the JVM."""
    return df.withColumn(out, signed_counts(token_hashes(text_col, method), dim))


def embed(
    df: DataFrame, column: str, encoder: Callable[[], Encoder] | None = None, out: str = "embedding"
) -> DataFrame:
    """Add vectors from ``encoder()``, called once per Python worker; None takes the hashing encoder.

    The encoder gets a pandas Series per Arrow batch and returns one row of numbers per element.
    """
    if encoder is None:
        return hash_embed(df, column, out=out)

    long_rows()

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = encoder()
        for batch in batches:
            yield pd.Series(list(np.asarray(model(batch), dtype=np.float32)), index=batch.index)

    return df.withColumn(out, encode(F.col(column)))


def pixel_embed(df: DataFrame, image_col: str = "image", side: int = 8, out: str = "embedding") -> DataFrame:
    """Add the unit vector of the image's mean-free ``side`` x ``side`` luma grid."""

    long_rows()

    @F.pandas_udf("array<float>")
    def grid(images: pd.DataFrame) -> pd.Series:
        vectors = []
        columns = (images["height"], images["width"], images["nChannels"], images["data"])
        for height, width, channels, data in zip(*columns):
            pixels = I.raster(height, width, channels, data)
            if pixels is None:
                vectors.append(None)
                continue
            small = I.resample(I.grey_levels(pixels)[:, :, None], side, side, "bicubic")
            v = small.astype(np.float64).ravel()
            v -= v.mean()
            norm = np.sqrt((v * v).sum())
            vectors.append((v / norm if norm > 0 else v).astype(np.float32))
        return pd.Series(vectors)

    return df.withColumn(out, grid(F.col(image_col)))
