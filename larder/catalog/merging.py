"""Merge, membership and grouping queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.catalog import base as B
from larder.functions import text as T
from larder.operators import joins as J
from larder.operators import merge as M
from larder.operators.ranking import chunk_of, group_rank, keys_per_id
from larder.session import staged


def records(df: DataFrame, id_col: str, tag: str, file: str, order: str, *fields: str) -> DataFrame:
    """Table rows as JSON records; blocks of the integer order column stand for input splits."""
    names = [F.col(f) for f in fields]
    return df.select(
        F.col(id_col).cast("string").alias("id"),
        F.lit(tag).alias("tag"),
        F.lit(file).alias("file"),
        chunk_of(order).alias("block"),
        F.col(order).alias("pos"),
        F.to_variant_object(F.struct(F.col(id_col).alias("id"), *names)).alias("v"),
    )


def _long(merged: DataFrame) -> DataFrame:
    return merged.select("id", "name", "n", F.try_variant_get("value", "$", "string").alias("value"))


def _two_sources(spark: SparkSession, folder: str) -> DataFrame:
    docs = B.table(spark, folder, "documents").withColumn("partition", F.lit("train"))
    labels = B.table(spark, folder, "labels").withColumn("lang", F.lit("unknown"))
    return records(docs, "doc_id", "documents", "a.jsonl", "doc_id", "text", "lang", "source", "partition").unionByName(
        records(labels, "doc_id", "labels", "b.jsonl", "doc_id", "quality", "toxic", "lang")
    )


def tagged_merge_docs(spark: SparkSession, folder: str) -> DataFrame:
    return _long(M.tagged_merge_long(_two_sources(spark, folder)))


TAGGED_MERGE_DOCS = """
SELECT CAST(doc_id AS VARCHAR) AS id, name, CAST(1 AS BIGINT) AS n, value FROM (
    SELECT doc_id, 'text__from_documents' AS name, text AS value FROM documents
    UNION ALL SELECT doc_id, 'lang__from_documents', lang FROM documents
    UNION ALL SELECT doc_id, 'source__from_documents', source FROM documents
    UNION ALL SELECT doc_id, 'quality__from_labels', CAST(quality AS VARCHAR) FROM labels
    UNION ALL SELECT doc_id, 'toxic__from_labels', CAST(toxic AS VARCHAR) FROM labels
    UNION ALL SELECT doc_id, 'lang__from_labels', 'unknown' FROM labels)
"""


def tagged_merge_bare(spark: SparkSession, folder: str) -> DataFrame:
    """Merge that tags a field only from its second arrival on."""
    return _long(M.tagged_merge_long(_two_sources(spark, folder), always_tag=False))


TAGGED_MERGE_BARE = """
SELECT CAST(doc_id AS VARCHAR) AS id, name, CAST(1 AS BIGINT) AS n, value FROM (
    SELECT doc_id, 'text' AS name, text AS value FROM documents
    UNION ALL SELECT doc_id, 'lang', lang FROM documents
    UNION ALL SELECT doc_id, 'source', source FROM documents
    UNION ALL SELECT doc_id, 'quality', CAST(quality AS VARCHAR) FROM labels
    UNION ALL SELECT doc_id, 'toxic', CAST(toxic AS VARCHAR) FROM labels
    UNION ALL SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM documents) THEN 'lang__from_labels' ELSE 'lang' END,
                     'unknown' FROM labels)
"""


def _turns(spark: SparkSession, folder: str) -> DataFrame:
    conversations = B.table(spark, folder, "conversations").withColumn("url", F.lit("u"))
    return records(conversations, "conv_id", "conversations", "c.jsonl", "turn", "role", "text", "url")


def tagged_merge_collisions(spark: SparkSession, folder: str) -> DataFrame:
    """Many records per id: names are numbered in arrival order."""
    return _long(M.tagged_merge_long(_turns(spark, folder)))


COLLISIONS = """
WITH t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations),
f AS (SELECT conv_id, n, 'role__from_conversations' AS base, role AS value FROM t
      UNION ALL SELECT conv_id, n, 'text__from_conversations', text FROM t)
SELECT CAST(conv_id AS VARCHAR) AS id, CASE WHEN n = 1 THEN base ELSE base || '_' || n END AS name, n, value FROM f
"""


def merged_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Merged wide records in parts of at most three numbers per name."""
    merged = M.tagged_merge(_turns(spark, folder), part_width=3)
    names = F.array_join(F.sort_array(F.map_keys("fields")), ",")
    return merged.select("id", "part", F.size("fields").alias("fields"), names.alias("names"))


MERGED_ROWS = """
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations),
f AS (SELECT conv_id, (n - 1) // 3 AS part, b || CASE WHEN n = 1 THEN '' ELSE '_' || n END AS name
      FROM t, (VALUES ('role__from_conversations'), ('text__from_conversations')) v(b))
SELECT CAST(conv_id AS VARCHAR) AS id, CAST(part AS BIGINT) AS part, CAST(count(*) AS INTEGER) AS fields,
       string_agg(name, ',' ORDER BY name) AS names
FROM f GROUP BY ALL
"""


def merge_counters(spark: SparkSession, folder: str) -> DataFrame:
    return M.merge_counters(_two_sources(spark, folder))


MERGE_COUNTERS = """
WITH r AS (SELECT 'a.jsonl' AS file, doc_id FROM documents UNION ALL SELECT 'b.jsonl', doc_id FROM labels)
SELECT file, count(*) AS records, (SELECT count(*) FROM r) AS total_records,
       (SELECT count(DISTINCT doc_id) FROM r) AS unique_ids
FROM r GROUP BY file
"""


def docs_with_labels(spark: SparkSession, folder: str) -> DataFrame:
    docs = B.table(spark, folder, "documents").select("doc_id", "lang")
    return J.semi_join(docs, B.table(spark, folder, "labels"), "doc_id")


def new_docs_only(spark: SparkSession, folder: str) -> DataFrame:
    docs = B.table(spark, folder, "documents").select("doc_id", "lang")
    return J.skip_existing(docs, B.table(spark, folder, "labels"), "doc_id", overwrite=False)


def keys_of_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct part keys of each supplier in sorted lists of at most 50."""
    lines = B.table(spark, folder, "lineitem")
    lists = keys_per_id(lines, "l_suppkey", "l_partkey", chunk=chunk_of("key"), list_size=50)
    return lists.select("id", "part", F.array_join(F.transform("keys", lambda k: k.cast("string")), ",").alias("keys"))


KEYS_OF_IDS = """
WITH p AS (SELECT DISTINCT l_suppkey AS id, l_partkey AS key FROM lineitem),
r AS (SELECT id, key, (row_number() OVER (PARTITION BY id ORDER BY key) - 1) // 50 AS part FROM p)
SELECT id, CAST(part AS BIGINT) AS part, string_agg(CAST(key AS VARCHAR), ',' ORDER BY key) AS keys FROM r GROUP BY id, part
"""


def positions(spark: SparkSession, folder: str) -> DataFrame:
    """Position of every event within its type, types being few and large."""
    events = B.table(spark, folder, "events").select("event_id", "event_type")
    return group_rank(events, ["event_type"], ["event_id"], "place", chunk=None, limit=1)


def _text_hash() -> Column:
    return F.md5(T.clean_text("text", stop=None))


def _hashed(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as images of a recipe: the language groups, the cleaned text is the hash."""
    docs = B.table(spark, folder, "documents")
    return staged(docs.select("doc_id", "lang", "n_chars", _text_hash().alias("hash")), "hashes")


SQL_HASHED = f"h AS (SELECT doc_id, lang, n_chars, md5({B.sql_clean('text')}) AS hash FROM documents)"


def dedup_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    kept = J.dedup_keep_first(_hashed(spark, folder), ["lang", "hash"], "doc_id", F.col("n_chars") >= 100)
    return kept.select("doc_id", "lang", "hash")


def duplicate_origin(spark: SparkSession, folder: str) -> DataFrame:
    marked = J.mark_duplicates(_hashed(spark, folder), ["lang", "hash"], "doc_id", "original")
    return marked.select("doc_id", "original")


QUERIES = {
    "tagged_merge_docs": tagged_merge_docs,
    "tagged_merge_bare": tagged_merge_bare,
    "tagged_merge_collisions": tagged_merge_collisions,
    "merged_rows": merged_rows,
    "merge_counters": merge_counters,
    "docs_with_labels": docs_with_labels,
    "new_docs_only": new_docs_only,
    "keys_per_id": keys_of_ids,
    "group_positions": positions,
    "dedup_keep_first": dedup_keep_first,
    "duplicate_origin": duplicate_origin,
}

SQL = {
    "tagged_merge_docs": TAGGED_MERGE_DOCS,
    "tagged_merge_bare": TAGGED_MERGE_BARE,
    "tagged_merge_collisions": COLLISIONS,
    "merged_rows": MERGED_ROWS,
    "merge_counters": MERGE_COUNTERS,
    "docs_with_labels": "SELECT doc_id, lang FROM documents SEMI JOIN labels USING (doc_id)",
    "new_docs_only": "SELECT doc_id, lang FROM documents ANTI JOIN labels USING (doc_id)",
    "keys_per_id": KEYS_OF_IDS,
    "group_positions": """
        SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS place FROM events""",
    "dedup_keep_first": f"""
        WITH {SQL_HASHED}, r AS (SELECT *, row_number() OVER (PARTITION BY lang, hash ORDER BY doc_id) AS n
                                 FROM h WHERE n_chars >= 100)
        SELECT doc_id, lang, hash FROM r WHERE n = 1""",
    "duplicate_origin": f"""
        WITH {SQL_HASHED}
        SELECT doc_id, first_value(doc_id) OVER (PARTITION BY lang, hash ORDER BY doc_id) AS original FROM h""",
}
