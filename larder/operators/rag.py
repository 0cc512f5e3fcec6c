"""Preparation of retrieval-augmented prompts and their traces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.keys import trace_key
from larder.functions.prompts import build_prompt


def load_images(hits: DataFrame, images: DataFrame, max_images: int = 3) -> DataFrame:
    """Bytes of the first ``max_images`` image hits of each query, as base64.

    ``hits`` has ``query_id, rank, bucket, key`` and ``images`` has ``bucket, key, content``. The limit
    counts hits tried: one whose image is missing is left out and not replaced.
    """
    tried = hits.filter(F.col("rank") <= max_images).select("query_id", "rank", "bucket", "key")
    found = tried.join(images.select("bucket", "key", "content"), ["bucket", "key"])
    b64 = F.translate(F.base64("content"), "\r\n", "")
    return found.filter(F.col("content").isNotNull()).select(
        "query_id", "rank", "bucket", "key", b64.alias("b64")
    )


def _ranked_list(rows: DataFrame, name: str, *columns: str) -> DataFrame:
    """Rank-ordered array of structs per query; the callers bound the ranks, so groups are small."""
    items = F.sort_array(F.collect_list(F.struct("rank", *columns)))
    return rows.groupBy("query_id").agg(
        F.transform(items, lambda x: F.struct(*[x[c].alias(c) for c in columns])).alias(name)
    )


def rag_traces(
    queries: DataFrame,
    text_hits: DataFrame,
    image_hits: DataFrame,
    timestamp: Column | str,
    model: str = "",
    max_texts: int = 3,
    answer: Column | None = None,
) -> DataFrame:
    """One trace row per query of ``query_id, query, user_image_path``.

    ``text_hits`` has ``query_id, rank, text, score``; ``image_hits`` is the result of ``load_images``.
    The answer column is null unless an expression over the prompt is given.
    """
    ts = F.lit(timestamp) if isinstance(timestamp, str) else timestamp
    texts = _ranked_list(text_hits.filter(F.col("rank") <= max_texts), "retrieved_text", "text", "score")
    images = _ranked_list(image_hits, "retrieved_images", "bucket", "key", "b64")
    empty_texts = F.array().cast("array<struct<text:string,score:double>>")
    empty_images = F.array().cast("array<struct<bucket:string,key:string,b64:string>>")
    rows = (
        queries.join(texts, "query_id", "left")
        .join(images, "query_id", "left")
        .withColumn("retrieved_text", F.coalesce("retrieved_text", empty_texts))
        .withColumn("retrieved_images", F.coalesce("retrieved_images", empty_images))
    )
    photo = F.col("user_image_path").isNotNull()
    prompt = build_prompt("query", "retrieved_text", "retrieved_images", photo)
    reply = F.lit(None).cast("string") if answer is None else answer
    return (
        rows.withColumn("prompt", prompt)
        .withColumn("answer", reply)
        .select(
            "query_id",
            "query",
            "user_image_path",
            "prompt",
            "answer",
            F.lit(model).alias("model_info"),
            "retrieved_text",
            "retrieved_images",
            ts.alias("timestamp_utc"),
            trace_key("query", ts).alias("s3_key"),
        )
    )
