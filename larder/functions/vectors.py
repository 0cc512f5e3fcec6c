"""Vector arithmetic on ``ARRAY<FLOAT|DOUBLE>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def l2_sq(a: Column | str, b: Column | str) -> Column:
    """Squared Euclidean distance."""

    def square(x: Column, y: Column) -> Column:
        d = x.cast("double") - y.cast("double")
        return d * d

    return _sum(F.zip_with(_col(a), _col(b), square))


def inner_product(a: Column | str, b: Column | str) -> Column:
    return _sum(F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")))


def l2_norm(v: Column | str) -> Column:
    return F.sqrt(inner_product(v, v))


def cosine_distance(a: Column | str, b: Column | str) -> Column:
    return 1 - F.try_divide(inner_product(a, b), l2_norm(a) * l2_norm(b))


def l2_normalize(v: Column | str) -> Column:
    """Vector scaled to length 1; the zero vector stays as it is."""
    c = _col(v)
    norm = F.nullif(l2_norm(c), F.lit(0.0))
    return F.transform(c, lambda x: F.coalesce(x.cast("double") / norm, F.lit(0.0)))


def similarity(distance: Column | str) -> Column:
    return 1 / (1 + _col(distance))
