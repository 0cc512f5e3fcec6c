"""Exploitation stage: vector entries of texts and images, stored as collections."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import images as I
from larder.functions import keys as K
from larder.functions import text as T
from larder.functions import values as V
from larder.operators.embed import Encoder, embed, pixel_embed
from larder.operators.reports import observed, observed_row
from larder.session import staged
from larder.sources import scan, sinks

LIGHTS = ("fat", "salt", "saturates", "sugars")
FIRST_SOURCE, SECOND_SOURCE, THIRD_SOURCE = "__from_recipes_with_nutritional_info", "__from_layer1", "__from_det_ingrs"


def _text_list(value: Column) -> Column:
    items = F.try_variant_get(value, "$", "array<struct<text:string>>")
    return F.when(F.size(items) > 0, items)


def _entry_rows(trusted: DataFrame, bucket: str) -> DataFrame:
    """The entry of each first part, and whether it can be one: ``ok``."""
    fields = F.col("fields")

    def string(name: str) -> Column:
        return F.try_variant_get(fields[name], "$", "string")

    def fallback(part: str, *sources: str) -> Column:
        first = F.coalesce(*[_text_list(fields[f"{part}{s}"]) for s in sources])
        return T.first_filled(f"{part}_text_clean", T.join_text_list_stripped(first))

    lights = fields[f"fsa_lights_per100g{FIRST_SOURCE}"]
    titles = (string(f"title{FIRST_SOURCE}"), string(f"title{SECOND_SOURCE}"))
    return (
        trusted.filter(F.col("part") == 0)
        .select(
            F.trim("id").alias("id"),
            F.trim(T.first_filled("title_text_clean", *titles, "title_text_raw")).alias("title"),
            fallback("ingredients", FIRST_SOURCE, SECOND_SOURCE, THIRD_SOURCE).alias("_ingredients"),
            fallback("instructions", FIRST_SOURCE, SECOND_SOURCE).alias("_instructions"),
            F.col("nutrition_normalized").alias("has_nutrition"),
            *[F.try_variant_get(lights, f"$.{c}", "string").alias(f"fsa_{c}") for c in LIGHTS],
        )
        .withColumn("document", T.document_text("title", "_ingredients", "_instructions"))
        .select(
            ((F.col("id") != "") & (F.col("document") != "")).alias("ok"),
            "id",
            "document",
            F.lit("text").alias("type"),
            "title",
            "has_nutrition",
            F.lit(bucket).alias("source_bucket"),
            *[f"fsa_{c}" for c in LIGHTS],
        )
    )


def document_entries(trusted: DataFrame, bucket: str = "trusted-zone") -> DataFrame:
    """One text entry per trusted recipe that has any text; later parts of wide records are not texts."""
    return _entry_rows(trusted, bucket).filter("ok").drop("ok")


def exploit_documents(
    trusted: DataFrame,
    documents: str | None = None,
    multimodal: str | None = None,
    encoder: Callable[[], Encoder] | None = None,
    shared_encoder: Callable[[], Encoder] | None = None,
) -> DataFrame:
    """Embed the text entries and store them in the document and the mixed collection."""
    entries = document_entries(trusted)
    embedded = embed(entries, "document", encoder)
    if documents is not None:
        embedded = sinks.write_collection(embedded, documents, "text")
    if multimodal is not None and shared_encoder is not encoder:
        sinks.write_collection(embed(entries, "document", shared_encoder), multimodal, "text")
    elif multimodal is not None:
        embedded = sinks.write_collection(embedded, multimodal, "text")
    return embedded


def image_entries(
    images: DataFrame, bucket: str, prefix: str, processed_at: Column | str, keep_unreadable: bool = False
) -> DataFrame:
    """One entry per readable image (``key, image``) in its colour form; unreadable ones may be kept as white squares."""
    valid = I.is_valid("image")
    rows = images.withColumn("image", F.when(valid, F.col("image")).otherwise(I.white_raster()))
    if not keep_unreadable:
        rows = images.filter(valid)
    rows = rows.withColumn("image", I.colour("image"))
    at = F.lit(processed_at) if isinstance(processed_at, str) else processed_at
    return rows.select(
        K.vector_id("key").alias("id"),
        F.lit("image").alias("type"),
        F.col("key").alias("object_key"),
        F.lit(bucket).alias("bucket"),
        F.lit(prefix).alias("source_prefix"),
        F.col("image.height").alias("image_height"),
        F.col("image.width").alias("image_width"),
        F.col("image.nChannels").alias("image_channels"),
        at.alias("processed_at"),
        "image",
    )


def exploit_images(
    images: DataFrame,
    bucket: str,
    prefix: str,
    processed_at: Column | str,
    collection: str | None = None,
    multimodal: str | None = None,
    encoder: Callable[[DataFrame], DataFrame] | None = None,
    keep_unreadable: bool = False,
) -> DataFrame:
    """Embed the image entries and store them in the image and the mixed collection."""
    entries = image_entries(images, bucket, prefix, processed_at, keep_unreadable)
    embedded = (pixel_embed(entries) if encoder is None else encoder(entries)).drop("image")
    for path in (collection, multimodal):
        if path is not None:
            embedded = sinks.write_collection(embedded, path, "image")
    return embedded


def ingest_documents(
    spark: SparkSession, source: str, bucket: str = "trusted-zone", lines: str = scan.JSON_LINES, files: str = scan.JSON_FILES
) -> tuple[DataFrame, DataFrame]:
    """Text entries of the stored recipes under ``source``, and one row of counters.

    The job that stores the entries counts them: records that became entries, and all others, unreadable lines, elements and items of
    lists included.
    """
    candidates = scan.scan_candidates(spark, source, lines=lines, files=files)
    fields, texts = F.col("fields"), ("title", "ingredients", "instructions")
    clean = {f"{p}_text_{f}": F.try_variant_get(fields[f"{p}_text_{f}"], "$", "string") for p in texts for f in ("raw", "clean")}
    named = F.coalesce(F.try_variant_get("v", "$.id", "string"), F.lit(""))
    rows = candidates.select(named.alias("id"), F.lit(0).alias("part"), scan.record_fields("v").alias("fields"))
    rows = rows.withColumns(clean | {"nutrition_normalized": F.try_variant_get(fields["nutrition_normalized"], "$", "boolean")})
    ok = F.coalesce("ok", F.lit(False))
    seen_rows, seen = observed(_entry_rows(rows, bucket), processed_records=F.count_if(ok), discarded_records=F.count_if(~ok))
    entries = staged(seen_rows.filter("ok").drop("ok"), "text-entries")
    listed = [spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", g).load(source) for g in (lines, files)]
    counts = {n: seen.get.get(n) for n in ("processed_records", "discarded_records")}
    return entries, observed_row(spark, counts | {"total_files": sum(x.select("path").count() for x in listed)})


def metadata_text(entries: DataFrame) -> DataFrame:
    """``id, metadata`` with the entry's non-null metadata as JSON."""
    left_out = {"document", "embedding", "image"}
    return entries.select("id", V.metadata_json(*[c for c in entries.columns if c not in left_out]).alias("metadata"))
