"""Formatted stage: merged documents and screened, letterboxed images."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import images as I
from larder.functions import keys as K
from larder.operators import screening as Q
from larder.operators.joins import semi_join, skip_existing
from larder.operators.merge import field_counters, merged_rows, stage_fields
from larder.operators.reports import observed
from larder.session import staged
from larder.sources import scan, sinks


def format_documents(
    spark: SparkSession,
    source: str,
    out: str | None = None,
    skip: Sequence[str] = ("url", "partition"),
    always_tag: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Merge all JSON files under ``source`` by id; returns the merged rows and the per-file counters.

    The sources are read by one job, which also counts what is malformed or lacks an id; these two counts stand on every row.
    Nothing is written to ``out`` without it (a dry run); the counters are the same either way.
    """
    bad, named = F.col("reason").isNotNull(), F.try_variant_get("v", "$.id", "string")
    candidates, seen = observed(
        scan.scan_candidates(spark, source),
        malformed_records=F.count_if(bad),
        records_without_id=F.count_if(~bad & (F.trim(F.coalesce(named, F.lit(""))) == "")),
    )
    fields = stage_fields(scan.as_records(candidates))
    merged = merged_rows(fields, skip, always_tag)
    if out is not None:
        sinks.write_merged(merged, out)
        merged = spark.read.parquet(out)
    lost = {n: F.lit(int(seen.get.get(n) or 0)).cast("bigint") for n in ("malformed_records", "records_without_id")}
    return merged, field_counters(fields).withColumns(lost)


def measured_images(
    images: DataFrame,
    limits: Q.Thresholds = Q.Thresholds(),
    size: tuple[int, int] = (512, 512),
    strict: bool = False,
    white_alpha: bool = False,
) -> DataFrame:
    """Measures of each image (``key, image``) and, when it passes the quality tests, its letterboxed raster.

    With ``white_alpha`` transparent pixels are laid over white; else their colour is taken as it is.

    Everything that needs the pixels happens in this one pass; rejected images carry no raster on.
    """
    valid = I.is_valid("image")
    sized = images.select(
        K.recipe_id("key", strict).alias("id"),
        "key",
        "image",
        valid.alias("valid"),
        F.col("image.width").alias("width"),
        F.col("image.height").alias("height"),
    ).filter(F.col("id").isNotNull())
    early = Q.quality_reason(F.col("valid"), F.col("width"), F.col("height"), F.lit(None), _sizes(limits))
    decent = F.when(early.isNull(), F.col("image"))
    measured = sized.withColumn("_decent", decent).withColumn("_m", I.measure("_decent"))
    fine = Q.quality_reason(F.col("valid"), F.col("width"), F.col("height"), F.col("_m.blur"), limits)
    return (
        measured.withColumn("blur", F.col("_m.blur"))
        .withColumn("phash", F.col("_m.phash"))
        .withColumn("boxed", I.letterbox(F.when(fine.isNull(), F.col("_decent")), size, white_alpha))
        .select("id", "key", "valid", "width", "height", "blur", "phash", "boxed")
    )


def _sizes(limits: Q.Thresholds) -> Q.Thresholds:
    return Q.Thresholds(limits.min_width, limits.min_height, limits.min_aspect, limits.max_aspect, None)


def screen_and_box(
    images: DataFrame,
    prefix: str = "images",
    limits: Q.Thresholds = Q.Thresholds(),
    size: tuple[int, int] = (512, 512),
    dedup: bool = True,
    existing: DataFrame | None = None,
    overwrite: bool = True,
    strict: bool = False,
    white_alpha: bool = False,
) -> dict[str, DataFrame]:
    """Screened images: ``screened`` rows, ``kept`` rasters, ``counters``, ``report`` and ``skips``.

    Pixels are decoded once into a columnar staging table; the duplicate test reads only its small
    columns, and the kept rasters are picked from it by key.
    """
    table = staged(measured_images(images, limits, size, strict, white_alpha), "images")
    screened = Q.screen(table.drop("boxed"), limits, dedup)
    winners = screened.filter(F.col("reason").isNull()).select("key")
    kept = semi_join(table.select("id", "key", F.col("boxed").alias("image")), winners, "key")
    kept = kept.withColumn("dst_key", K.jpg_key(F.lit(prefix), "key"))
    fresh = skip_existing(kept, existing, "dst_key", overwrite)
    return {
        "screened": screened,
        "kept": fresh,
        "counters": Q.quality_counters(screened),
        "report": Q.image_report(screened, fresh.select("key"), limits, size),
        "skips": Q.skip_log(screened),
    }


def format_images(spark: SparkSession, source: str, out: str, **options) -> dict[str, DataFrame]:
    """Screen and letterbox the images under ``source`` and write the kept rasters to ``out``."""
    result = screen_and_box(scan.scan_images(spark, source), **options)
    sinks.write_images(result["kept"], out, options.get("overwrite", True))
    return result
