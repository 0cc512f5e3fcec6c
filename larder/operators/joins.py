"""Membership joins and first-row de-duplication that hold up under hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def semi_join(df: DataFrame, ids: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``ids``.

    The ids are made distinct first: duplicates are combined before the shuffle, and a hot id becomes
    one row, so only the ``df`` side can be skewed, which adaptive execution splits. Whether the ids are
    broadcast is left to their size at run time.
    """
    cols = [on] if isinstance(on, str) else list(on)
    return df.join(ids.select(*cols).distinct(), cols, "left_semi")


def anti_join(df: DataFrame, ids: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``ids``."""
    cols = [on] if isinstance(on, str) else list(on)
    return df.join(ids.select(*cols).distinct(), cols, "left_anti")


def skip_existing(df: DataFrame, existing: DataFrame | None, key: str, overwrite: bool) -> DataFrame:
    """All rows when overwriting, else only those whose target key is not there yet."""
    if overwrite or existing is None:
        return df
    return anti_join(df, existing, key)


def mark_duplicates(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    original: str = "original_key",
    eligible: Column | None = None,
) -> DataFrame:
    """Add the smallest ``order`` value of the row's group, null for a row that is not ``eligible``.

    A row is a duplicate when that value is not its own. The first row is found by an aggregate with
    map-side combine and joined back, so copies of one item never meet in one task.
    """
    ok = F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False))
    firsts = (
        df.filter(ok).groupBy(*[F.col(g).alias(f"_f_{g}") for g in group]).agg(F.min(order).alias(original))
    )
    same = [F.col(g).eqNullSafe(F.col(f"_f_{g}")) for g in group]
    return df.join(firsts, [ok, *same], "left").select(*df.columns, original)


def dedup_keep_first(
    df: DataFrame, group: Sequence[str], order: str, eligible: Column | None = None
) -> DataFrame:
    """Rows that are the first of their group; rows that are not ``eligible`` are dropped."""
    marked = mark_duplicates(df, group, order, "_first", eligible)
    return marked.filter(F.col("_first") == F.col(order)).drop("_first")
