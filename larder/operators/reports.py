"""One-row reports over flagged records, ingest counters and run metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from larder.functions.text import fixed, percent, token_len


def observed(df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """The rows, and the counts the first job over them leaves behind: no scan of their own.

    The job has to read the rows once and whole, as a write or ``staged`` does.
    """
    seen = Observation()
    return df.observe(seen, *[c.alias(n) for n, c in counts.items()]), seen


def observed_row(spark: SparkSession, counts: dict[str, int | None]) -> DataFrame:
    """One row of counts."""
    return spark.createDataFrame([tuple(int(v or 0) for v in counts.values())], ", ".join(f"{n} bigint" for n in counts))


def token_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean whitespace-token count of each text column."""
    return df.agg(*[F.coalesce(F.avg(token_len(c)), F.lit(0.0)).alias(c) for c in columns])


def record_counts(flags: DataFrame) -> DataFrame:
    """One row of counts over the records of a document stage.

    ``flags`` has one narrow row per record read (``malformed, has_image, missing_nutrition, outlier,
    totals_dropped``). A record is kept when it is well formed, has an image, lacks no required nutrition data and is no
    outlier; the count after the id test is taken behind the outlier filter. A record that lacks nutrition data is not counted
    as an outlier.
    """
    imaged = ~F.col("malformed") & F.col("has_image")
    candidate = imaged & ~F.col("missing_nutrition")
    stays = F.coalesce(candidate & ~F.col("outlier"), F.lit(False))
    total, written = F.count(F.lit(1)), F.count_if(stays)
    return flags.agg(
        total.alias("total_doc_count"),
        F.count_if("malformed").alias("malformed_doc_count"),
        written.alias("kept_after_id"),
        written.alias("written_doc_count"),
        F.count_if(imaged & F.col("missing_nutrition")).alias("dropped_missing_nutrition"),
        F.count_if(candidate & F.col("outlier")).alias("dropped_outliers"),
        F.count_if(stays & F.col("totals_dropped")).alias("nutrition_totals_dropped"),
        percent(written, total).alias("filtering_rate"),
    )


def document_report(
    flags: DataFrame, kept: DataFrame, token_columns: Sequence[str], bounds: DataFrame, ids: DataFrame
) -> DataFrame:
    """One row on a document stage: ``record_counts``, and the mean token counts of the records ``kept`` with their texts."""
    means = token_means(kept, token_columns).select(
        F.struct(*[F.round(c, 6).alias(c) for c in token_columns])
    ).scalar()
    return record_counts(flags).select(
        "*",
        *[means[c].alias(f"tokens_{c}") for c in token_columns],
        bounds.select(F.to_json(F.struct("*"))).scalar().alias("iqr_thresholds"),
        ids.agg(F.countDistinct("id")).scalar().alias("unique_ids_with_images"),
    )


def run_summary(stages: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """One row over stage metrics (``stage, duration, memory_usage, disk_usage, success``)."""
    done = F.col("duration").isNotNull()
    good = F.coalesce(F.col("success"), F.lit(True))
    summary = stages.agg(
        F.coalesce(F.sum("duration"), F.lit(0.0)).alias("total_duration"),
        F.coalesce(F.sum("memory_usage"), F.lit(0)).alias("total_memory_usage"),
        F.coalesce(F.sum("disk_usage"), F.lit(0)).alias("total_disk_usage"),
        F.count_if(done & good).alias("successful_stages"),
        F.count_if(~good).alias("failed_stages"),
        F.count(F.lit(1)).alias("total_stages"),
    )
    count = F.lit(0).cast("bigint") if errors is None else errors.agg(F.count(F.lit(1))).scalar()
    return summary.select("*", count.alias("error_count"))


def sample_summary(samples: DataFrame, columns: Sequence[str], interval_seconds: int = 5) -> DataFrame:
    """One row: sampling time and the mean, largest and smallest value of each metric column."""
    return samples.agg(
        (F.count(F.lit(1)) * interval_seconds).alias("monitoring_duration"),
        *[
            f(c).alias(f"{name}_{c}")
            for c in columns
            for name, f in (("avg", F.avg), ("max", F.max), ("min", F.min))
        ],
        F.count(F.lit(1)).alias("data_points"),
    )


def stage_lines(stages: DataFrame) -> DataFrame:
    """Readable line per stage: duration, memory in MB and outcome."""
    outcome = F.when(F.coalesce(F.col("success"), F.lit(True)), F.lit("Success")).otherwise(F.lit("Failed"))
    memory = F.coalesce(F.col("memory_usage"), F.lit(0)) / F.lit(1024.0 * 1024.0)
    line = F.concat(
        F.col("stage"), F.lit(": "), fixed(F.coalesce(F.col("duration"), F.lit(0.0)), 2), F.lit("s, "),
        fixed(memory, 1), F.lit(" MB, "), outcome,
    )
    return stages.select("stage", line.alias("line"))
