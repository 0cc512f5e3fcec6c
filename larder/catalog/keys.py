"""Key, path and identifier queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.catalog import base as B
from larder.functions import keys as K


def object_keys(spark: SparkSession, folder: str) -> DataFrame:
    pages = B.table(spark, folder, "pages").withColumn("key", K.object_key("url"))
    return pages.select("page_id", "key", K.original_name("key").alias("name"))


def _document_key() -> Column:
    return F.concat_ws("/", F.lit("images"), F.concat(F.col("lang"), F.lit("__"), F.col("source"), F.lit("_"), F.col("doc_id").cast("string"), F.lit(".jpg")))


SQL_DOCUMENT_KEY = "'images/' || lang || '__' || source || '_' || doc_id || '.jpg'"


def image_keys(spark: SparkSession, folder: str) -> DataFrame:
    pages = B.table(spark, folder, "pages")
    key = K.image_key(F.lit("images"), F.col("page_id").cast("string"), F.length("url"), K.url_extension("url"))
    return pages.select("page_id", key.alias("key"))


def target_keys(spark: SparkSession, folder: str) -> DataFrame:
    key = K.target_key(F.lit("document"), F.lit("pages & more"), F.lit("2024-01-01T00-00-00Z"), F.col("url"), F.lit("html"), F.lit("landing"))
    return B.table(spark, folder, "pages").select("page_id", key.alias("key"))


def jpg_keys(spark: SparkSession, folder: str) -> DataFrame:
    return B.table(spark, folder, "pages").select("page_id", K.jpg_key(F.lit("images"), "url").alias("key"))


def vector_ids(spark: SparkSession, folder: str) -> DataFrame:
    return B.table(spark, folder, "pages").select("page_id", K.vector_id("url").alias("id"))


def recipe_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids from image keys, from page URLs that hold none, and from keys with another extension."""
    docs = B.table(spark, folder, "documents").select(_document_key().alias("key"))
    other = docs.select(F.regexp_replace("key", "jpg$", "txt").alias("key"))
    keys = docs.union(other).union(B.table(spark, folder, "pages").select(F.col("url").alias("key")))
    return keys.select("key", K.recipe_id("key").alias("id"), K.recipe_id("key", strict=True).alias("strict_id"))


RECIPE_IDS = rf"""
WITH docs AS (SELECT {SQL_DOCUMENT_KEY} AS key FROM documents),
keys AS (SELECT key FROM docs UNION ALL SELECT regexp_replace(key, 'jpg$', 'txt') FROM docs
         UNION ALL SELECT url FROM pages)
SELECT key, coalesce(nullif(regexp_extract({B.sql_file_name("key")}, '__([A-Za-z0-9_\-]+)_(\d+)\.', 1), ''),
                     {B.sql_file_name("key")}) AS id,
       nullif(regexp_extract({B.sql_file_name("key")},
              '(?i)__([A-Za-z0-9_\-]+)_(\d+)\.(?:jpe?g|png|webp|gif|bmp|tiff)$', 1), '') AS strict_id
FROM keys
"""


def image_index(spark: SparkSession, folder: str) -> DataFrame:
    docs = B.table(spark, folder, "documents")
    hashed = F.concat(F.lit("images/"), F.md5("text"), F.col("doc_id").cast("string"), F.lit(".png"))
    keys = docs.select(hashed.alias("key")).union(docs.select(_document_key()))
    return keys.select("key", K.image_index_id("key").alias("image_id"))


def short_tags(spark: SparkSession, folder: str) -> DataFrame:
    pages = B.table(spark, folder, "pages").select(F.col("url").alias("key"))
    docs = B.table(spark, folder, "documents").select(F.concat(_document_key(), F.lit(".json")).alias("key"))
    return pages.union(docs).select("key", K.short_tag("key").alias("tag"))


_STEM = B.sql_stem("key")
SHORT_TAGS = rf"""
WITH keys AS (SELECT url AS key FROM pages UNION ALL SELECT {SQL_DOCUMENT_KEY} || '.json' FROM documents),
parts AS (SELECT key, CASE WHEN contains({_STEM}, '__') THEN string_split({_STEM}, '__')[-1]
                      ELSE string_split_regex({_STEM}, '[-_$]+')[-1] END AS part FROM keys),
tags AS (SELECT key, right(lower(trim(regexp_replace(part, '[^\p{{L}}\p{{N}}_\-]+', '_', 'g'), '_')), 40) AS tag FROM parts)
SELECT key, CASE WHEN tag = '' THEN 'file' ELSE tag END AS tag FROM tags
"""


def sanitized_names(spark: SparkSession, folder: str) -> DataFrame:
    return B.table(spark, folder, "documents").select("doc_id", K.sanitize("text").alias("name"))


def path_parts(spark: SparkSession, folder: str) -> DataFrame:
    return B.table(spark, folder, "pages").select(
        "page_id",
        K.posix_path("url").alias("path"),
        K.file_name("url").alias("name"),
        K.base_name("url").alias("base"),
        K.extension("url").alias("ext"),
        K.url_path("url").alias("url_path"),
        K.url_extension("url").alias("url_ext"),
    )


_PATH = r"regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
_SUFFIX = B.sql_suffix("url")
_URL_SUFFIX = B.sql_suffix(_PATH)
SQL_URL_EXT = f"""(CASE WHEN {_URL_SUFFIX} = 'jpeg' THEN 'jpg'
    WHEN {_URL_SUFFIX} IN ('jpg', 'png', 'gif', 'webp', 'bmp') THEN {_URL_SUFFIX} ELSE 'jpg' END)"""
PATH_PARTS = f"""
SELECT page_id, {B.sql_posix("url")} AS path, {B.sql_file_name("url")} AS name,
       CASE WHEN {B.sql_stem("url")} = '' THEN 'file' ELSE {B.sql_stem("url")} END AS base,
       CASE WHEN {_SUFFIX} IN ('jpeg', 'jpe') THEN 'jpg' WHEN {_SUFFIX} = '' THEN 'bin' ELSE {_SUFFIX} END AS ext,
       {_PATH} AS url_path, {SQL_URL_EXT} AS url_ext
FROM pages
"""


def trace_keys(spark: SparkSession, folder: str) -> DataFrame:
    key = K.trace_key("text", F.lit("2024-01-01T00-00-00Z"))
    return B.table(spark, folder, "benchmark").select("item_id", key.alias("key"))


QUERIES = {
    "object_keys": object_keys,
    "image_keys": image_keys,
    "target_keys": target_keys,
    "jpg_keys": jpg_keys,
    "vector_ids": vector_ids,
    "recipe_ids": recipe_ids,
    "image_index": image_index,
    "short_tags": short_tags,
    "sanitized_names": sanitized_names,
    "path_parts": path_parts,
    "trace_keys": trace_keys,
}

_NAME = B.sql_file_name("url")
SQL = {
    "object_keys": f"""
        WITH k AS (SELECT page_id, left(sha256({B.sql_posix('url')}), 16) || '__' ||
                   CASE WHEN {_NAME} = '' THEN 'file' ELSE {_NAME} END AS key FROM pages)
        SELECT page_id, key, regexp_replace(key, '^.*?__', '') AS name FROM k""",
    "image_keys": f"""
        SELECT page_id, 'images/' || left(sha256(page_id || ':' || length(url)), 32) || '__' || page_id || '_' ||
               length(url) || '.' || {SQL_URL_EXT} AS key FROM pages""",
    "target_keys": f"""
        SELECT page_id, 'landing/document$pages_more$2024-01-01T00-00-00Z$' || {B.sql_sanitize('url')} || '.html' AS key
        FROM pages""",
    "jpg_keys": rf"""
        SELECT page_id, 'images/' || regexp_replace({_NAME}, '\.[^.]*$', '') || '.jpg' AS key FROM pages""",
    "vector_ids": "SELECT page_id, replace(url, '/', '__') AS id FROM pages",
    "recipe_ids": RECIPE_IDS,
    "image_index": rf"""
        WITH keys AS (SELECT 'images/' || md5(text) || doc_id || '.png' AS key FROM documents
                      UNION ALL SELECT {SQL_DOCUMENT_KEY} FROM documents)
        SELECT key, coalesce(nullif(regexp_extract({B.sql_file_name('key')}, '([A-Fa-f0-9]+[0-9]+)\.[^.]+$', 1), ''),
                             {B.sql_file_name('key')}) AS image_id FROM keys""",
    "short_tags": SHORT_TAGS,
    "sanitized_names": f"SELECT doc_id, {B.sql_sanitize('text')} AS name FROM documents",
    "path_parts": PATH_PARTS,
    "trace_keys": """
        SELECT item_id, 'results/generative/rag_multimodal/2024-01-01T00-00-00Z_' || left(sha1(text), 8) || '.json' AS key
        FROM benchmark""",
}
