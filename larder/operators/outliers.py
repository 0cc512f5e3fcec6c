"""Interquartile-range bounds and filters."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(c: Column | str) -> Column:
    """Value as double, null when it is NaN or infinite."""
    v = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when((F.abs(v) < F.lit(float("inf"))) & ~F.isnan(v), v)


class _Target:
    """Value range known to hold the order statistic of one rank of one column."""

    def __init__(self, column: str, rank: int, low: float, high: float, count: int):
        self.column, self.rank = column, rank
        self.low, self.high, self.below, self.count = low, high, 0, count

    def inside(self) -> Column:
        return F.when(F.col(self.column).between(self.low, self.high), F.col(self.column))


def order_statistics(
    df: DataFrame, ranks: dict[str, Sequence[int]], limit: int = 200_000, accuracy: int = 10_000
) -> dict[tuple[str, int], float]:
    """Exact values at 0-based ``ranks`` of numeric columns, without sorting or gathering them.

    A quantile sketch proposes a narrow value range around each rank, one aggregate counts the rows
    below and inside it exactly, and this is repeated inside the range until at most ``limit`` values
    are left. Each step is a map-side aggregate over the narrow columns with a one-row result.
    """
    columns = list(ranks)
    ends = df.agg(
        *[f(c).alias(f"{n}_{i}") for i, c in enumerate(columns) for n, f in
          (("lo", F.min), ("hi", F.max), ("n", F.count))]
    ).first()
    targets = [
        _Target(c, r, ends[f"lo_{i}"], ends[f"hi_{i}"], ends[f"n_{i}"])
        for i, c in enumerate(columns)
        for r in ranks[c]
    ]
    found: dict[tuple[str, int], float] = {}
    while True:
        wide = [t for t in targets if t.count > limit and t.low < t.high]
        if not wide:
            break
        margin = 2.0 / accuracy
        guesses = df.agg(
            *[
                F.percentile_approx(
                    t.inside(),
                    [
                        max(0.0, (t.rank - t.below) / t.count - margin),
                        min(1.0, (t.rank - t.below + 1) / t.count + margin),
                    ],
                    accuracy,
                ).alias(str(i))
                for i, t in enumerate(wide)
            ]
        ).first()
        spans = [guesses[str(i)] for i in range(len(wide))]
        counts = df.agg(
            *[
                x
                for i, (t, (low, high)) in enumerate(zip(wide, spans))
                for x in (
                    F.count_if(F.col(t.column) < low).alias(f"below_{i}"),
                    F.count_if(F.col(t.column) <= high).alias(f"upto_{i}"),
                    F.max(F.when(F.col(t.column) < low, F.col(t.column))).alias(f"prev_{i}"),
                    F.min(F.when(F.col(t.column) > high, F.col(t.column))).alias(f"next_{i}"),
                )
            ]
        ).first()
        for i, (t, (low, high)) in enumerate(zip(wide, spans)):
            below, upto = counts[f"below_{i}"], counts[f"upto_{i}"]
            if t.rank < below:
                t.high, t.count = counts[f"prev_{i}"], below - t.below
            elif t.rank >= upto:
                t.low, t.count, t.below = counts[f"next_{i}"], t.below + t.count - upto, upto
            else:
                t.low, t.high, t.below, t.count = low, high, below, upto - below
    for t in targets:
        if t.low == t.high:
            found[t.column, t.rank] = t.low
    rest = [t for t in targets if (t.column, t.rank) not in found]
    if rest:
        picked = df.agg(
            *[
                F.element_at(F.sort_array(F.collect_list(t.inside())), t.rank - t.below + 1).alias(str(i))
                for i, t in enumerate(rest)
            ]
        ).first()
        found.update({(t.column, t.rank): picked[str(i)] for i, t in enumerate(rest)})
    return found


def quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], limit: int = 200_000
) -> dict[str, list[float] | None]:
    """Exact quantiles with linear interpolation, None for a column without values."""
    narrow = df.select(*[finite(c).alias(c) for c in columns])
    counts = narrow.agg(*[F.count(c).alias(c) for c in columns]).first()
    ranks = {}
    for c in columns:
        if counts[c]:
            places = [p * (counts[c] - 1) for p in probabilities]
            ranks[c] = sorted({x for q in places for x in (math.floor(q), math.ceil(q))})
    values = order_statistics(narrow, ranks, limit) if ranks else {}
    out: dict[str, list[float] | None] = {}
    for c in columns:
        if not counts[c]:
            out[c] = None
            continue
        out[c] = []
        for p in probabilities:
            q = p * (counts[c] - 1)
            low, high = values[c, math.floor(q)], values[c, math.ceil(q)]
            below, above = math.ceil(q) - q, q - math.floor(q)
            out[c].append(low if low == high else below * low + above * high)
    return out


def _bounds(q1: Column, q3: Column, name: str, k: float) -> list[Column]:
    spread = (q3 - q1) * k
    return [
        q1.alias(f"{name}_q1"),
        q3.alias(f"{name}_q3"),
        (q1 - spread).alias(f"{name}_lo"),
        (q3 + spread).alias(f"{name}_hi"),
    ]


def iqr_bounds(
    df: DataFrame,
    columns: Sequence[str],
    k: float = 1.5,
    method: str = "auto",
    max_distinct: int = 1_000_000,
) -> DataFrame:
    """One row with ``<c>_q1, <c>_q3, <c>_lo, <c>_hi`` per column, null for a column without values.

    Quartiles interpolate linearly, by one formula in all exact methods. ``"percentile"`` is one aggregate whose buffer holds the distinct
    values; ``"select"`` narrows value ranges in several passes and needs little memory; ``"approx"``
    is the sketch; ``"auto"`` takes the first while the columns have few distinct values, else the second.
    """
    narrow = df.select(*[finite(c).alias(c) for c in columns])
    if method == "auto":
        seen = narrow.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
        method = "percentile" if sum(seen) <= max_distinct else "select"
    if method == "select":
        found = quantiles(df, columns, (0.25, 0.75))
        one = df.sparkSession.range(1)
        pairs = {c: found[c] or (None, None) for c in columns}
        return one.select(
            *[
                x
                for c in columns
                for x in _bounds(
                    F.lit(pairs[c][0]).cast("double"), F.lit(pairs[c][1]).cast("double"), c, k
                )
            ]
        )
    aggregate = F.percentile if method == "percentile" else F.percentile_approx
    quartiles = narrow.agg(*[aggregate(c, [0.25, 0.75]).alias(c) for c in columns])
    return quartiles.select(
        *[x for c in columns for x in _bounds(F.col(c)[0], F.col(c)[1], c, k)]
    )


def within_bounds(columns: Sequence[str], bounds: DataFrame, values: dict[str, Column] | None = None) -> Column:
    """True when every finite value lies inside its bounds; missing values and null bounds pass.

    The bounds are read as one scalar subquery, not joined.
    """
    b = bounds.select(F.struct("*")).scalar()
    verdict = F.lit(True)
    for c in columns:
        v = finite((values or {}).get(c, F.col(c)))
        verdict = verdict & F.coalesce(v.between(b[f"{c}_lo"], b[f"{c}_hi"]), F.lit(True))
    return verdict


def all_within(values: Column | str, names: Sequence[str], bounds: DataFrame) -> Column:
    """The same test for an array of finite values in the order of ``names``.

    The one row of bounds is fetched, so that the array is read once against literals.
    """
    row = bounds.first()
    limits = F.array(
        *[
            F.struct(*[F.lit(row[f"{n}_{end}"]).cast("double").alias(end) for end in ("lo", "hi")])
            for n in names
        ]
    )
    v = F.col(values) if isinstance(values, str) else values
    tests = F.zip_with(v, limits, lambda x, r: F.coalesce(x.between(r["lo"], r["hi"]), F.lit(True)))
    return F.forall(tests, lambda t: t)


def iqr_filter(df: DataFrame, columns: Sequence[str], bounds: DataFrame) -> DataFrame:
    """Rows inside the bounds of every column."""
    return df.filter(within_bounds(columns, bounds))
