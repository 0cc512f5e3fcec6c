"""Landing queries: source filters, classification, manifests, caps and indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.catalog import base as B
from larder.catalog.keys import SQL_URL_EXT
from larder.functions import values as V
from larder.operators import landing as L
from larder.plans.landing import land_manifest

TIMESTAMP = "2024-01-01T00-00-00Z"


def _objects(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as stored objects of several kinds, told apart by suffix or by content type."""
    docs = B.table(spark, folder, "documents")
    kind = F.pmod(F.length("text"), F.lit(7))
    name = F.concat_ws("_", "lang", "source", F.col("doc_id").cast("string"))
    suffix = F.element_at(F.array(*[F.lit(x) for x in (".JPEG", ".jsonl", "", ".txt", "", ".png", "/")]), kind.cast("int") + 1)
    ctype = F.when(kind == 2, "application/json; charset=utf-8").when(kind == 4, "image/PNG").when(kind == 3, "text/plain")
    return docs.select(F.concat(F.lit("in/"), name, suffix).alias("key"), ctype.alias("content_type"))


SQL_OBJECTS = """
objects AS (SELECT 'in/' || lang || '_' || source || '_' || doc_id ||
        ['.JPEG', '.jsonl', '', '.txt', '', '.png', '/'][length(text) % 7 + 1] AS key,
    lang || '_' || source || '_' || doc_id AS name, length(text) % 7 AS kind FROM documents),
landed AS (SELECT key, name, CASE WHEN kind IN (0, 4, 5) THEN 'image' WHEN kind IN (1, 2) THEN 'document' ELSE 'skip' END AS class,
    ['jpg', 'jsonl', 'json', 'txt', 'png', 'png', ''][kind + 1] AS ext,
    [NULL, 'application/json', 'application/json; charset=utf-8', 'text/plain', 'image/PNG', NULL, NULL][kind + 1] AS content_type
    FROM objects)
"""


def _organised(spark: SparkSession, folder: str) -> DataFrame:
    return L.organise(_objects(spark, folder), "landing", "recipes & more", TIMESTAMP)


def organised_objects(spark: SparkSession, folder: str) -> DataFrame:
    meta = F.col("metadata")
    return _organised(spark, folder).select(
        "key", "class", "dst_key", "content_type", meta["src-key"].alias("src_key"), meta["dataset"].alias("dataset")
    )


def landing_counters(spark: SparkSession, folder: str) -> DataFrame:
    return L.class_counters(_organised(spark, folder))


def source_files(spark: SparkSession, folder: str) -> DataFrame:
    """Listing filter and landing keys over document names, some hidden, some archives."""
    kind = F.pmod("doc_id", F.lit(5))
    name = F.concat_ws("_", "source", F.col("doc_id").cast("string"))
    path = F.when(kind == 1, F.concat(F.lit("a/."), name)).when(kind == 2, F.concat(name, F.lit(".tar"))).otherwise(F.concat(F.lit("a//"), name, F.lit(".json")))
    files = B.table(spark, folder, "documents").select(path.alias("path"))
    objects = land_manifest(files, "landing")["objects"]
    return objects.select("path", "key", "content_type", F.col("metadata")["original-path"].alias("original"))


SOURCE_FILES = """
WITH files AS (SELECT source || '_' || doc_id AS name FROM documents WHERE doc_id % 5 NOT IN (1, 2))
SELECT 'a//' || name || '.json' AS path, 'a//' || name || '.json' AS original, 'application/json' AS content_type,
       'landing/' || left(sha256('a/' || name || '.json'), 16) || '__' || name || '.json' AS key
FROM files
"""


def _recipes(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as recipes with three image entries, one of them empty."""
    entry = [F.struct(c.alias("url")) for c in (F.col("url"), F.lit(""), F.concat("url", F.lit("/photo.PNG?x=1")))]
    return B.table(spark, folder, "pages").select(
        "page_id", F.col("page_id").cast("string").alias("id"), F.array(*entry).alias("images")
    )


def image_manifest(spark: SparkSession, folder: str) -> DataFrame:
    recipes = _recipes(spark, folder)
    rows = land_manifest(recipes.select(F.col("id").alias("path")), "images", recipes, None, None)["images"]
    return rows.select("id", "index", "url", "key", F.col("metadata")["image-index"].alias("image_index"))


IMAGE_MANIFEST = f"""
WITH entries AS (SELECT page_id, 0 AS idx, url FROM pages
                 UNION ALL SELECT page_id, 2, url || '/photo.PNG?x=1' FROM pages)
SELECT CAST(page_id AS VARCHAR) AS id, idx AS "index", url, CAST(idx AS VARCHAR) AS image_index,
       'images/' || left(sha256(page_id || ':' || idx), 32) || '__' || page_id || '_' || idx || '.' || {SQL_URL_EXT} AS key
FROM entries
"""


def ingest_cap(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations in order, their turns counted as images, until 50 are reached; the cap is the feature."""
    turns = B.table(spark, folder, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("ok"))
    return L.ingest_cap(turns, "conv_id", "ok", 1000, 50).select("conv_id", "ok")


INGEST_CAP = """
WITH turns AS (SELECT conv_id, count(*) AS ok FROM conversations GROUP BY conv_id),
head AS (SELECT * FROM turns ORDER BY conv_id LIMIT 1000),
c AS (SELECT *, coalesce(sum(ok) OVER (ORDER BY conv_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM head)
SELECT conv_id, ok FROM c WHERE before < 50
"""


def recipe_index(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct ids per stored JSON object: at the root, and one level down in its lists."""
    orders = B.table(spark, folder, "orders")
    root = F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.array(F.struct(F.col("o_custkey").alias("id"))).alias("items")))
    listed = F.to_json(F.array(F.struct(F.col("o_custkey").alias("id"), F.lit(1).alias("n")), F.struct(F.lit(None).cast("bigint").alias("id"), F.lit(2).alias("n"))))
    suffix = F.when(F.pmod("o_orderkey", F.lit(2)) == 0, ".json").otherwise(".jsonl")
    key = F.concat(F.col("o_orderpriority"), suffix)
    texts = orders.select(key.alias("key"), root.alias("j")).union(orders.select(key, listed))
    return L.recipe_index(texts.select("key", V.parse_json("j").alias("v")))


RECIPE_INDEX = """
WITH k AS (SELECT *, o_orderpriority || CASE WHEN o_orderkey % 2 = 0 THEN '.json' ELSE '.jsonl' END AS key FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS id, key FROM k
UNION SELECT CAST(o_custkey AS VARCHAR), key FROM k WHERE o_orderkey % 2 = 0
"""

QUERIES = {
    "organised_objects": organised_objects,
    "landing_counters": landing_counters,
    "source_files": source_files,
    "image_manifest": image_manifest,
    "ingest_cap": ingest_cap,
    "recipe_index": recipe_index,
}

SQL = {
    "organised_objects": f"""
        WITH {SQL_OBJECTS}
        SELECT key, class, content_type, CASE WHEN class <> 'skip' THEN key END AS src_key,
               CASE WHEN class <> 'skip' THEN 'recipes & more' END AS dataset,
               CASE WHEN class <> 'skip' THEN 'persistent_landing/' || class || 's/' || class ||
                    '$recipes_more${TIMESTAMP}$' || name || '.' || ext END AS dst_key
        FROM landed""",
    "landing_counters": f"""
        WITH {SQL_OBJECTS}
        SELECT count(*) AS total_files, count(*) FILTER (class = 'image') AS moved_images,
               count(*) FILTER (class = 'document') AS moved_documents, count(*) FILTER (class = 'skip') AS skipped_files
        FROM landed""",
    "source_files": SOURCE_FILES,
    "image_manifest": IMAGE_MANIFEST,
    "ingest_cap": INGEST_CAP,
    "recipe_index": RECIPE_INDEX,
}
