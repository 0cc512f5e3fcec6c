"""Image quality screening: one reason per image, duplicates per recipe, counters and skip log."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.text import fixed
from larder.functions.values import aspect_ratio
from larder.operators.joins import mark_duplicates

REASONS = ("corrupted", "too_small", "bad_aspect", "too_blurry", "duplicate")


@dataclass(frozen=True)
class Thresholds:
    """Limits an image has to meet; ``min_blur`` None skips the sharpness test."""

    min_width: int = 128
    min_height: int = 128
    min_aspect: float = 0.5
    max_aspect: float = 3.0
    min_blur: float | None = 50.0


def quality_reason(
    valid: Column, width: Column, height: Column, blur: Column, limits: Thresholds = Thresholds()
) -> Column:
    """First failing test, or null for an image that passes them all."""
    aspect = aspect_ratio(width, height)
    reason = (
        F.when(~F.coalesce(valid, F.lit(False)), F.lit("corrupted"))
        .when((width < limits.min_width) | (height < limits.min_height), F.lit("too_small"))
        .when(~aspect.between(limits.min_aspect, limits.max_aspect), F.lit("bad_aspect"))
    )
    if limits.min_blur is not None:
        reason = reason.when(F.coalesce(blur, F.lit(0.0)) < limits.min_blur, F.lit("too_blurry"))
    return reason


def reason_detail(
    reason: Column, width: Column, height: Column, blur: Column, phash: Column, limits: Thresholds
) -> Column:
    """Reason with the measured value, as written to the skip log."""
    size = F.concat_ws("x", width.cast("string"), height.cast("string"))
    sharp = F.concat(
        F.lit("blurry:varLap="), fixed(F.coalesce(blur, F.lit(0.0)), 2), F.lit(f" < {limits.min_blur}")
    )
    return (
        F.when(reason == "corrupted", F.lit("corrupted:undecodable"))
        .when(reason == "too_small", F.concat(F.lit("too_small:"), size))
        .when(
            reason == "bad_aspect", F.concat(F.lit("bad_aspect:"), fixed(aspect_ratio(width, height), 2))
        )
        .when(reason == "too_blurry", sharp)
        .when(reason == "duplicate", F.concat(F.lit("duplicate_phash:"), phash))
    )


def screen(
    measured: DataFrame, limits: Thresholds = Thresholds(), dedup: bool = True, id_col: str = "id"
) -> DataFrame:
    """Add ``reason``, ``detail`` and ``original_key`` to rows of ``id, key, valid, width, height, blur, phash``.

    Only images that pass every other test take part in the duplicate test; the first key of an equal
    hash within a recipe is kept. A kept image has a null reason.
    """
    w, h, b = F.col("width"), F.col("height"), F.col("blur")
    tested = measured.withColumn("reason", quality_reason(F.col("valid"), w, h, b, limits))
    if dedup:
        fine = F.col("reason").isNull()
        tested = mark_duplicates(tested, [id_col, "phash"], "key", "original_key", fine)
        copy = fine & (F.col("original_key") != F.col("key"))
        tested = tested.withColumn("original_key", F.when(copy, F.col("original_key"))).withColumn(
            "reason", F.when(F.col("original_key").isNotNull(), F.lit("duplicate")).otherwise(F.col("reason"))
        )
    else:
        tested = tested.withColumn("original_key", F.lit(None).cast("string"))
    return tested.withColumn("detail", reason_detail(F.col("reason"), w, h, b, F.col("phash"), limits))


def quality_counters(screened: DataFrame) -> DataFrame:
    """One row: images evaluated, kept and dropped by reason."""
    reason = F.col("reason")
    return screened.agg(
        F.count(F.lit(1)).alias("evaluated"),
        F.count_if(reason.isNull()).alias("kept"),
        F.count_if(reason == "corrupted").alias("corrupted"),
        F.count_if(reason == "too_small").alias("too_small"),
        F.count_if(reason == "bad_aspect").alias("bad_aspect"),
        F.count_if(reason == "too_blurry").alias("too_blurry"),
        F.count_if(reason == "duplicate").alias("dupes_removed"),
    )


def image_report(screened: DataFrame, written: DataFrame, limits: Thresholds, size: tuple[int, int]) -> DataFrame:
    """One row: the counters, recipes seen, images written and skipped, and the settings used."""
    copied = written.agg(F.count(F.lit(1))).scalar()
    recipes = screened.agg(F.countDistinct("id")).scalar()
    return quality_counters(screened).select(
        "*",
        recipes.alias("unique_recipe_ids"),
        F.col("evaluated").alias("total_images_matched"),
        copied.alias("images_copied"),
        (F.col("kept") - copied).alias("images_skipped"),
        F.lit(limits.min_blur).cast("double").alias("blur_threshold"),
        F.array(F.lit(limits.min_width), F.lit(limits.min_height)).alias("min_wh"),
        F.array(F.lit(limits.min_aspect), F.lit(limits.max_aspect)).alias("aspect_range"),
        F.array(*[F.lit(x) for x in size]).alias("target_size"),
    )


def skip_log(screened: DataFrame) -> DataFrame:
    """``key, reason, original_key`` of dropped images with commas turned into spaces."""

    def plain(c: str) -> Column:
        return F.translate(F.coalesce(F.col(c), F.lit("")), ",", " ")

    return screened.filter(F.col("reason").isNotNull()).select(
        plain("key").alias("key"), plain("detail").alias("reason"), plain("original_key").alias("original_key")
    )
