"""Landing jobs: what to fetch, and how landed objects are organised."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.keys import utc_timestamp
from larder.operators import landing as L
from larder.session import staged
from larder.sources.objects import remove_objects, stored_objects, write_objects


def land_manifest(
    files: DataFrame,
    prefix: str,
    recipes: DataFrame | None = None,
    max_recipes: int | None = None,
    max_images: int | None = None,
    order: str = "pos",
) -> dict[str, DataFrame]:
    """Objects to land from a file listing (``path``) and images to land from recipe image lists.

    ``recipes`` has ``id, images ARRAY<STRUCT<url>>`` and the order column. The caps stop after the
    recipe that reaches them; None, the default, lifts a cap.
    """
    listed = files.withColumn("landed", L.is_source_file("path"))
    out = {
        "objects": L.land_objects(listed.filter("landed").drop("landed"), prefix),
        "counters": listed.agg(
            F.count_if("landed").alias("processed_files"), F.count_if(~F.col("landed")).alias("skipped_files")
        ),
    }
    if recipes is not None:
        chosen = recipes
        if max_recipes is not None or max_images is not None:
            urls = F.filter("images", lambda i: i["url"].isNotNull() & (i["url"] != ""))
            counted = recipes.withColumn("ok", F.greatest(F.size(urls), F.lit(0)))
            chosen = L.ingest_cap(counted, order, "ok", max_recipes, max_images)
        out["images"] = L.image_manifest(chosen, prefix)
    return out


def land_move(
    spark: SparkSession, source: str, out: str, dataset: str, timestamp: Column | str | None = None, remove: bool = True
) -> DataFrame:
    """Write the landed objects under their target keys below ``out``, then remove the sources of those written; returns the class counters.

    The sources go after all targets are in place, so a failed run can be repeated. Skipped objects stay where they are.
    """
    objects = staged(stored_objects(spark, source), "landed-objects")
    organised = L.organise(
        objects.withColumn("content_type", F.lit(None).cast("string")), source, dataset, timestamp if timestamp is not None else utc_timestamp()
    )
    organised = staged(organised, "organised-objects")
    written = write_objects(organised.filter("dst_key IS NOT NULL").select(F.col("dst_key").alias("key"), "content"), out)
    if remove:
        done = organised.join(written.select(F.col("key").alias("dst_key")), "dst_key", "left_semi")
        remove_objects(done.select("key"), source)
    return L.class_counters(organised)


def land_organise(
    spark: SparkSession, source: str, dataset: str, timestamp: Column | str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Organised objects with their contents, and the class counters, for a landing folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    objects = files.select(
        F.col("path").alias("key"), F.lit(None).cast("string").alias("content_type"), "length", "content"
    )
    organised = L.organise(objects, source, dataset, timestamp if timestamp is not None else utc_timestamp())
    return organised, L.class_counters(organised)
