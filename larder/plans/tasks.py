"""Retrieval tasks over stored collections; queries are tables, so one job answers many."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.keys import utc_timestamp
from larder.operators.embed import Encoder, embed
from larder.operators.knn import knn
from larder.operators.rag import load_images, rag_traces
from larder.operators.search import search_summary
from larder.session import staged


def retrieve_text(
    queries: DataFrame, texts: DataFrame, k: int = 5, encoder: Callable[[], Encoder] | None = None
) -> DataFrame:
    """Nearest texts of each query (``query_id, query``): ``query_id, rank, id, score, document, title``."""
    vectors = embed(queries, "query", encoder)
    return knn(vectors, texts, k, payload=("document", "title"))


def retrieve_images(
    queries: DataFrame, images: DataFrame, k: int = 5, encoder: Callable[[], Encoder] | None = None
) -> DataFrame:
    """Nearest images: queries bring an ``embedding`` of their own picture, or a ``query`` text to encode."""
    vectors = queries if "embedding" in queries.columns else embed(queries, "query", encoder)
    hits = knn(vectors, images, k, payload=("bucket", "object_key"))
    return hits.withColumnRenamed("object_key", "key")


def demo_results(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """``query, num_results, top_score`` per query."""
    best = hits.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("num_results"), F.min(F.when(F.col("rank") == 1, F.col("score"))).alias("top_score")
    )
    joined = queries.join(best, "query_id", "left")
    return joined.select("query_id", "query", F.coalesce("num_results", F.lit(0)).alias("num_results"), "top_score")


def multimodal_search(
    queries: DataFrame,
    entries: DataFrame,
    n_results: int = 127,
    query_type: str = "text",
    encoder: Callable[[], Encoder] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Hits of both types in a mixed collection, and one summary row per query."""
    vectors = queries if "embedding" in queries.columns else embed(queries, "query", encoder)
    hits = knn(vectors, entries, n_results, payload=("type",))
    return hits, search_summary(queries, hits, entries, n_results, query_type)


def rag_prepare(
    queries: DataFrame,
    texts: DataFrame,
    images: DataFrame,
    image_bytes: DataFrame,
    k: int = 5,
    max_images: int = 3,
    timestamp: Column | str | None = None,
    model: str = "",
    encoder: Callable[[], Encoder] | None = None,
    answer: Column | None = None,
    image_encoder: Callable[[], Encoder] | None = None,
) -> DataFrame:
    """Trace rows with prompt, candidates and key for ``query_id, query, user_image_path[, image_embedding]``.

    A query with a picture of its own searches images by that picture's vector, the others by text.
    ``image_encoder`` encodes texts for the image collection where it is not that of the texts.
    """
    vectors = staged(embed(queries.select("query_id", "query"), "query", encoder), "query-vectors")
    text_hits = knn(vectors, texts, k, payload=("document", "title")).withColumnRenamed("document", "text")
    by_text = vectors
    if image_encoder is not None:
        by_text = staged(embed(queries.select("query_id", "query"), "query", image_encoder), "query-vectors")
    if "image_embedding" in queries.columns:
        own = queries.select("query_id", "image_embedding")
        by_text = by_text.join(own, "query_id").withColumn("embedding", F.coalesce("image_embedding", "embedding"))
    image_hits = retrieve_images(by_text.select("query_id", "embedding"), images, k)
    loaded = load_images(image_hits, image_bytes, max_images)
    when = timestamp if timestamp is not None else utc_timestamp()
    return rag_traces(queries, text_hits, loaded, when, model, answer=answer)
