"""Quality rules: simple limits, then robust multivariate outliers per language and source.

Each text gives counts: words, their characters, symbols, repeated lines and words in repeated three-word windows. Texts that
pass the limits are turned into a vector of four logarithmic rates. For each (language, source) the minimum covariance
determinant is estimated over all of them: from medians and median deviations, concentration steps keep the share
``half`` of rows that are nearest by Mahalanobis distance and take their mean and covariance. A row farther than
the ``cut`` quantile of chi-square is rejected. Each step is two aggregations by group with map-side combine
over a narrow table, so a group with a third of all rows costs what its rows cost; nothing but one row per group is
gathered. Rates that vary less than a floor have their deviation raised to it, so that rare harmless marks do not
reject a text; all four can reject a text by themselves.

Defined results: null and empty texts have no words and fail the limits. Null languages and sources are groups of their own.
Groups of fewer than ``least`` texts are not judged by distance. Equal rows get equal results. An empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.arrays import Words, pieces
from larder.llm.common import WORD, prepare, table
from larder.session import staged

SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FLOORS = (0.08, 0.8, 0.8, 0.8)  # least standard deviation of each component
P = len(FLOORS)
RIDGE = 0.01  # share by which covariances are lowered, so that components in step keep an inverse


def repeated_words(x: np.ndarray, width: int = 3) -> int:
    """Words in windows of ``width`` numbers that occur twice or more, the first included."""
    if len(x) <= width:
        return 0
    code = np.unique(x, return_inverse=True)[1] if x.max() >= 1 << 21 else x
    key = code[: len(x) - width + 1]
    for i in range(1, width):
        part = code[i : len(x) - width + 1 + i]
        if i == width - 1 and key.max() >= 1 << 42:
            key = np.unique(key, return_inverse=True)[1]
        key = key * (int(code.max()) + 1) + part
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    hit = np.zeros(len(key), bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    out = np.zeros(len(x), bool)
    for i in range(width):
        out[i : len(x) - width + 1 + i] |= hit
    return int(out.sum())


def repeated_lines(text: bytes) -> int:
    seen, n = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            n += bool(line.strip())
        else:
            seen.add(line)
    return n


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers = Words()
    for piece in pieces(batches, "text"):
        numbers.renew()
        rows = []
        for text in piece.column("text").to_pylist():
            text = text or b""
            words = text.split()
            chars = len(b"".join(words).decode("utf-8", "replace"))
            symbols = len(text) - len(text.translate(None, SYMBOLS))
            rows.append((len(words), chars, symbols, repeated_lines(text), repeated_words(numbers.numbers(words))))
        values = [pa.array(c, pa.int64()) for c in zip(*rows)]
        yield pa.RecordBatch.from_arrays([piece.column(c) for c in ("id", "lang", "source")] + values, names=["id", "lang", "source", *COUNTS])


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``(id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)`` of every row."""
    prepare(docs.sparkSession)
    kinds = dict(docs.dtypes)
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).cast("binary").alias("text"))
    schema = f"id {kinds[id_col]}, lang {kinds[lang_col]}, source {kinds[source_col]}, " + ", ".join(f"{c} bigint" for c in COUNTS)
    return rows.mapInArrow(_counts, schema)


def components_() -> list[Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return [
        F.log((F.col("word_chars") + 1) / words),
        F.log1p(1000.0 * F.col("n_symbols") / words),
        F.log1p(1000.0 * F.col("n_dup_lines") / words),
        F.log1p(100.0 * F.col("n_repeat_words") / words),
    ]


def chi2_cdf(x: float, p: int) -> float:
    """Chi-square distribution of an even number of degrees."""
    term, total = 1.0, 1.0
    for i in range(1, p // 2):
        term *= x / 2 / i
        total += term
    return 1 - exp(-x / 2) * total


def chi2_quantile(q: float, p: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, p) < q else (low, mid)
    return high


def _inverses(scale: float):
    """Mean and inverse covariance of each group from its sums."""

    def inverses(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        floor = np.square(FLOORS)
        for frame in frames:
            means, invs = [], []
            for n, s, c in zip(frame["n"], frame["s"], frame["c"]):
                mean = np.array(s, float) / n
                cov = np.zeros((P, P))
                cov[np.triu_indices(P)] = np.array(c, float) / n
                cov = cov + np.triu(cov, 1).T - np.outer(mean, mean)
                means.append(mean.tolist())
                cov *= scale
                variance = np.maximum(np.diag(cov), floor)
                cov *= 1 - RIDGE
                np.fill_diagonal(cov, variance)
                invs.append(np.linalg.inv(cov).ravel().tolist())
            yield pd.DataFrame({"gl": frame["gl"], "gs": frame["gs"], "mean": means, "inv": invs})

    return inverses


def _distance() -> Column:
    x = [F.col(f"x{i}") - F.col("mean")[i] for i in range(P)]
    return sum(x[i] * x[j] * F.col("inv")[i * P + j] for i in range(P) for j in range(P))


def mcd(rows: DataFrame, half: float = 0.75, steps: int = 3, least: int = 40) -> DataFrame:
    """``(gl, gs, mean, inv)`` of each group of ``rows (lang, source, x0..)`` with at least ``least`` rows."""
    group = [F.col("lang").alias("gl"), F.col("source").alias("gs")]
    same = lambda other: rows["lang"].eqNullSafe(other["gl"]) & rows["source"].eqNullSafe(other["gs"])
    consistent = half / chi2_cdf(chi2_quantile(half, P), P + 2)

    centre = rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.percentile_approx(f"x{i}", 0.5, 10000) for i in range(P)]).alias("mean")
    )
    centre = staged(centre.filter(F.col("n") >= least), "medians")
    apart = rows.join(centre, same(centre))
    spread = apart.groupBy("gl", "gs", "mean").agg(
        *[F.percentile_approx(F.abs(F.col(f"x{i}") - F.col("mean")[i]), 0.5, 10000).alias(f"m{i}") for i in range(P)]
    )
    inv = [F.lit(0.0) if i != j else 1 / F.greatest(F.pow(1.4826 * F.col(f"m{i}"), 2), F.lit(FLOORS[i] ** 2)) for i in range(P) for j in range(P)]
    fit = staged(spread.select("gl", "gs", "mean", F.array(*inv).alias("inv")), "estimates")
    for _ in range(steps):
        near = rows.join(fit, same(fit)).withColumn("d", _distance())
        bound = near.groupBy("gl", "gs").agg(F.percentile_approx("d", half, 10000).alias("q"))
        bound = bound.withColumnsRenamed({"gl": "bl", "gs": "bs"})
        inner = near.join(bound, near["gl"].eqNullSafe(bound["bl"]) & near["gs"].eqNullSafe(bound["bs"])).filter("d <= q")
        sums = inner.groupBy("gl", "gs").agg(
            F.count(F.lit(1)).alias("n"), F.array(*[F.sum(f"x{i}") for i in range(P)]).alias("s"),
            F.array(*[F.sum(F.col(f"x{i}") * F.col(f"x{j}")) for i in range(P) for j in range(i, P)]).alias("c"),
        )
        kinds = dict(fit.dtypes)
        fit = staged(sums.mapInPandas(_inverses(consistent), f"gl {kinds['gl']}, gs {kinds['gs']}, mean array<double>, inv array<double>"), "estimates")
    return fit


def quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    least_words: int = 50, most_repeated: int = 50, cut: float = 0.999, **options,
) -> DataFrame:
    """``(id, counts, base_failed, distance, kept)``; the distance is null where there is no estimate."""
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    counted = staged(text_counts(docs, id_col, text_col, lang_col, source_col).withColumn("base_failed", failed), "text-counts")
    rows = counted.select("*", *[c.alias(f"x{i}") for i, c in enumerate(components_())])
    fit = mcd(rows.filter("NOT base_failed"), **options)
    judged = rows.join(fit, rows["lang"].eqNullSafe(fit["gl"]) & rows["source"].eqNullSafe(fit["gs"]), "left")
    judged = judged.withColumn("distance", _distance())
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= chi2_quantile(cut, P), F.lit(True))
    return judged.select("id", *COUNTS, "base_failed", "distance", kept.alias("kept"))


def op9_quality_rules(spark, folder):
    return quality(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


QUERIES = {"op9_quality_rules": op9_quality_rules}
SQL: dict[str, str] = {}
