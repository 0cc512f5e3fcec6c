"""Search results over mixed collections: counts, distance ranges, one summary row per query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.prompts import search_summary_text


def multimodal_union(texts: DataFrame, images: DataFrame) -> DataFrame:
    """Text and image entries in one table; columns of the other kind are null."""
    return texts.unionByName(images, allowMissingColumns=True)


def of_type(entries: DataFrame, kind: str) -> DataFrame:
    """Entries of one type; on a collection stored by type this prunes the other folders."""
    return entries.filter(F.col("type") == kind)


def type_counts(entries: DataFrame) -> DataFrame:
    """One row: entries in total, images and texts."""
    return entries.agg(
        F.count(F.lit(1)).alias("total_count"),
        F.count_if(F.col("type") == "image").alias("image_count"),
        F.count_if(F.col("type") == "text").alias("text_count"),
    )


def collection_stats(collections: dict[str, DataFrame]) -> DataFrame:
    """Entries per collection and the number of collections; an empty collection counts 0."""
    spark = next(iter(collections.values())).sparkSession
    names = spark.createDataFrame([(n,) for n in collections], "collection string")
    rows = None
    for name, df in collections.items():
        part = df.select(F.lit(name).alias("collection"))
        rows = part if rows is None else rows.unionByName(part)
    counts = rows.groupBy("collection").agg(F.count(F.lit(1)).alias("entries"))
    return names.join(counts, "collection", "left").select(
        "collection",
        F.coalesce("entries", F.lit(0)).alias("entries"),
        F.lit(len(collections)).cast("bigint").alias("total_collections"),
    )


def distance_ranges(hits: DataFrame) -> DataFrame:
    """Nearest and farthest hit per query, over all hits and by type (``query_id, type, score``)."""
    image, text = F.col("type") == "image", F.col("type") == "text"
    return hits.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("num_results"),
        F.min("score").alias("closest_distance"),
        F.max("score").alias("farthest_distance"),
        F.min(F.when(image, F.col("score"))).alias("closest_image"),
        F.max(F.when(image, F.col("score"))).alias("farthest_image"),
        F.min(F.when(text, F.col("score"))).alias("closest_text"),
        F.max(F.when(text, F.col("score"))).alias("farthest_text"),
    )


def search_summary(
    queries: DataFrame, hits: DataFrame, entries: DataFrame, n_results: int, query_type: str = "text"
) -> DataFrame:
    """One row per query (``query_id, query``): collection counts, result counts, distances, summary text."""
    t = type_counts(entries).select(F.struct("*")).scalar()
    ranges = distance_ranges(hits)
    joined = queries.select("query_id", "query").join(ranges, "query_id", "left")
    return joined.select(
        "query_id",
        "query",
        F.lit(query_type).alias("query_type"),
        t["total_count"].alias("total_count"),
        t["image_count"].alias("image_count"),
        t["text_count"].alias("text_count"),
        F.lit(n_results).alias("n_results"),
        F.coalesce("num_results", F.lit(0)).alias("num_results"),
        "closest_distance",
        "farthest_distance",
        search_summary_text(
            F.col("closest_image"), F.col("farthest_image"), F.col("closest_text"), F.col("farthest_text")
        ).alias("summary"),
    )
