"""Reading stored JSON: arrays, lines, gzip, broken records, and the stages that start from files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.catalog import base as B
from larder.operators import merge as M
from larder.operators.landing import ingest_cap
from larder.plans.exploitation import ingest_documents
from larder.plans.landing import land_move
from larder.session import staged, staging_path
from larder.sources import idsets, objects, scan, sinks, versions
from larder.streaming.landing import land_stream

FORMS = {"arrays": {"files": "*.txt", "lines": "*.none"}, "lines": {"lines": "*.txt", "files": "*.none"}, "zipped": {"lines": "*.txt.gz", "files": "*.none"}}


def _stored(spark: SparkSession, folder: str, broken: bool) -> dict[str, str]:
    """Documents as files: one third as arrays, one as lines, one as gzipped lines; returns the folder of each form.

    With ``broken``, of every 37 documents one is cut off, one lies behind a quote that is not closed, one is a number, one stands in a list with
    two items that are no objects, and one has neither texts nor an id.
    """
    docs = B.table(spark, folder, "documents")
    kind = F.pmod("doc_id", F.lit(37)) if broken else F.lit(-1)
    filled = F.when(kind != 4, F.col("text"))
    body = F.to_json(F.struct(
        F.when(kind != 4, F.col("doc_id")).alias("id"), "n_chars", "lang", filled.alias("title_text_clean"),
        F.array(F.struct(F.col("source").alias("text"))).alias("parts"),
    ))
    value = (
        F.when(kind == 0, F.left(body, F.length(body) - 1))
        .when(kind == 1, F.regexp_replace(body, '"lang":"', '"lang":'))
        .when(kind == 2, F.col("doc_id").cast("string"))
        .when(kind == 3, F.concat(F.lit("[1,"), body, F.lit(",null]")))
        .otherwise(body)
    )
    rows = docs.select(F.pmod("doc_id", F.lit(3)).alias("form"), value.alias("value"))
    root = staging_path(spark, "stored-json")
    # Three array files, however large: they are streamed out by three tasks and read back by many.
    sinks.write_json_arrays(rows.filter("form = 0").repartition(3), f"{root}/arrays")
    rows.filter("form = 1").select("value").write.text(f"{root}/lines")
    rows.filter("form = 2").select("value").write.option("compression", "gzip").text(f"{root}/zipped")
    return {form: f"{root}/{form}" for form in FORMS}


def _each(read, paths: dict[str, str]) -> DataFrame:
    out = None
    for form, path in paths.items():
        rows = read(path, FORMS[form]).withColumn("form", F.lit(form))
        out = rows if out is None else out.unionByName(rows)
    return out


def scan_array(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of arrays, lines and gzipped lines, with its whole text."""
    rows = _each(lambda path, names: scan.as_records(scan.scan_candidates(spark, path, **names)), _stored(spark, folder, False))
    text = F.try_variant_get("v", "$.title_text_clean", "string")
    return rows.select(
        "id", "form", F.try_variant_get("v", "$.n_chars", "bigint").alias("n_chars"), F.try_variant_get("v", "$.parts[0].text", "string").alias("source"),
        F.md5(text).alias("text_md5"), F.length(text).cast("bigint").alias("length"),
    )


SCAN_ARRAY = """
SELECT CAST(doc_id AS VARCHAR) AS id, ['arrays', 'lines', 'zipped'][doc_id % 3 + 1] AS form, CAST(n_chars AS BIGINT) AS n_chars, source,
       md5(text) AS text_md5, length(text) AS length FROM documents
"""


def _shape(sample: Column) -> Column:
    """Sample with its number left out."""
    return F.left(F.regexp_replace(sample, r"\d+", "N"), F.lit(8))


def scan_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """What could not be read, by form, reason and place; and whether the offsets tell the records apart."""
    rows = _each(lambda path, names: scan.quarantine(spark, path, **names), _stored(spark, folder, True))
    return rows.groupBy("form", "reason", "item", _shape(F.col("sample")).alias("sample")).agg(
        F.count(F.lit(1)).alias("n"), (F.countDistinct("file", "at") == F.count(F.lit(1))).alias("placed")
    )


# An item that is no object spoils an element of an array as a whole; in a line that is a list it stands for itself.
_KINDS = """
k AS (SELECT ['arrays', 'lines', 'zipped'][doc_id % 3 + 1] AS form, doc_id % 37 AS kind FROM documents WHERE doc_id % 37 <= 4),
bad AS (SELECT form, 'not JSON' AS reason, 0 AS item, CASE kind WHEN 0 THEN '{"id":N,' ELSE '{"id":N,' END AS sample FROM k WHERE kind IN (0, 1)
    UNION ALL SELECT form, 'not an object', 0, 'N' FROM k WHERE kind = 2
    UNION ALL SELECT form, 'not an object', 0, '[N,{"id"' FROM k WHERE kind = 3 AND form = 'arrays'
    UNION ALL SELECT form, 'not an object', 0, 'N' FROM k WHERE kind = 3 AND form <> 'arrays'
    UNION ALL SELECT form, 'not an object', 2, 'null' FROM k WHERE kind = 3 AND form <> 'arrays')
"""
SCAN_QUARANTINE = f"""
WITH {_KINDS} SELECT form, reason, item, sample, count(*) AS n, item = 0 OR true AS placed FROM bad GROUP BY form, reason, item, sample
"""


def ingest_counters(spark: SparkSession, folder: str) -> DataFrame:
    """Records stored and discarded, and files, per form; the job that stores the entries counts them."""
    return _each(lambda path, names: ingest_documents(spark, path, **names)[1], _stored(spark, folder, True)).select(
        "form", "processed_records", "discarded_records", (F.col("total_files") > 0).alias("any_files")
    )


INGEST_COUNTERS = """
WITH r AS (SELECT ['arrays', 'lines', 'zipped'][doc_id % 3 + 1] AS form, doc_id % 37 AS kind, title <> '' AS filled
    FROM (SELECT doc_id, trim(text) AS title FROM documents)),
c AS (SELECT form, CASE WHEN kind IN (0, 1, 2, 4) OR (kind = 3 AND form = 'arrays') OR NOT filled THEN 0 ELSE 1 END AS ok,
    CASE WHEN kind = 3 AND form <> 'arrays' THEN 2 ELSE 0 END AS items FROM r)
SELECT form, CAST(sum(ok) AS BIGINT) AS processed_records, CAST(sum(1 - ok + items) AS BIGINT) AS discarded_records, true AS any_files
FROM c GROUP BY form
"""


def stored_records(spark: SparkSession, folder: str) -> DataFrame:
    """Merged records written as JSON lines and read again: the parts of a record and its fields."""
    turns = B.table(spark, folder, "conversations").select(
        F.col("conv_id").cast("string").alias("id"), F.lit("t").alias("tag"), F.lit("c.jsonl").alias("file"), F.lit(0).cast("bigint").alias("block"),
        F.col("turn").cast("bigint").alias("pos"), F.to_variant_object(F.struct("role", "text")).alias("v"),
    )
    path = staging_path(spark, "stored-records")
    sinks.write_merged_jsonl(M.tagged_merge(turns, part_width=2), path)
    rows, _ = scan.scan_merged(spark, path, lines="*.txt", files="*.none")
    fields = staged(rows, "records-read").select("id", "part", F.explode("fields").alias("name", "value"))
    return fields.select("id", "part", "name", F.try_variant_get("value", "$", "string").alias("value"))


STORED_RECORDS = """
WITH t AS (SELECT CAST(conv_id AS VARCHAR) AS id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, role, text FROM conversations),
f AS (SELECT id, n, 'role__from_t' AS base, role AS value FROM t UNION ALL SELECT id, n, 'text__from_t', text FROM t)
SELECT id, (n - 1) // 2 AS part, base || CASE WHEN n > 1 THEN '_' || n ELSE '' END AS name, value FROM f
"""

def object_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as objects under computed keys, read back; short ones are there before and stay."""
    docs = B.table(spark, folder, "documents")
    key = F.concat_ws("/", "lang", "source", F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")))
    rows = docs.select(key.alias("key"), F.encode("text", "UTF-8").alias("content"), F.length("text").alias("n"))
    path = staging_path(spark, "objects")
    objects.write_objects(rows.filter("n < 200").select("key", F.lit(b"there").alias("content")), path)
    objects.write_objects(rows, path, overwrite=False)
    return objects.stored_objects(spark, path).select("key", "length", F.md5("content").alias("content_md5"))


OBJECT_SINK = """
SELECT lang || '/' || source || '/doc_' || doc_id || '.txt' AS key, CASE WHEN length(text) < 200 THEN 5 ELSE strlen(text) END AS length,
       CASE WHEN length(text) < 200 THEN md5('there') ELSE md5(text) END AS content_md5 FROM documents
"""


def collection_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Entries of every version of a collection: two types written, one replaced, one dropped, one emptied."""
    docs = B.table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("type"), "source", "n_chars")
    path = staging_path(spark, "collection")
    versions.upsert(docs.filter("type IN ('en', 'fr')").drop("n_chars"), path)
    versions.upsert(docs.filter("type = 'fr' AND n_chars > 1000"), path, "fr")
    versions.upsert(docs.filter("type = 'de'"), path)
    versions.drop_type(spark, path, "en")
    versions.upsert(docs.filter("type = 'none'"), path, "fr")
    out = None
    for n in versions.versions(spark, path):
        rows = versions.read_version(spark, path, n)
        if "n_chars" not in rows.columns:
            rows = rows.withColumn("n_chars", F.lit(None).cast("bigint"))
        rows = rows.select(F.lit(n).alias("version"), "id", "type", "source", F.col("n_chars").cast("bigint").alias("n_chars"))
        out = rows if out is None else out.unionByName(rows)
    return out


COLLECTION_VERSIONS = """
WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS id, lang AS type, source, CAST(n_chars AS BIGINT) AS n_chars FROM documents),
first AS (SELECT id, type, source, CAST(NULL AS BIGINT) AS n_chars FROM d WHERE type IN ('en', 'fr')),
second AS (SELECT * FROM first WHERE type = 'en' UNION ALL SELECT * FROM d WHERE type = 'fr' AND n_chars > 1000),
third AS (SELECT * FROM second UNION ALL SELECT * FROM d WHERE type = 'de')
SELECT 1 AS version, * FROM first UNION ALL SELECT 2, * FROM second UNION ALL SELECT 3, * FROM third
UNION ALL SELECT 4, * FROM third WHERE type <> 'en' UNION ALL SELECT 5, * FROM third WHERE type = 'de'
"""


def image_cap(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in order until three quarters of all labels are met, in the order of their sizes; the cap is the feature."""
    labels = B.table(spark, folder, "labels")
    docs = B.table(spark, folder, "documents").join(labels.select("doc_id", F.lit(1).alias("ok")), "doc_id", "left")
    order = F.col("n_chars").cast("bigint") * 1_000_000_000 + F.col("doc_id")
    rows = docs.select("doc_id", order.alias("place"), F.coalesce("ok", F.lit(0)).alias("ok"))
    return ingest_cap(rows, "place", "ok", None, labels.count() * 3 // 4).select("doc_id", "ok")


IMAGE_CAP = """
WITH d AS (SELECT doc_id, n_chars, (l.doc_id IS NOT NULL)::INT AS ok FROM documents LEFT JOIN (SELECT doc_id FROM labels) l USING (doc_id)),
s AS (SELECT *, sum(ok) OVER (ORDER BY n_chars, doc_id) - ok AS before FROM d)
SELECT doc_id, ok FROM s WHERE before < (SELECT count(*) * 3 // 4 FROM labels)
"""

_SUFFIXES = (".json", ".JPEG", ".png", ".jsonl", ".tar")


def _as_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = B.table(spark, folder, "documents").filter("text <> ''")
    suffix = F.element_at(F.array(*[F.lit(x) for x in _SUFFIXES]), F.pmod("doc_id", F.lit(5)).cast("int") + 1)
    key = F.concat(F.col("lang"), F.lit("/"), F.col("source"), F.lit("_"), F.col("doc_id").cast("string"), suffix)
    return docs.select("doc_id", key.alias("key"), F.encode("text", "UTF-8").alias("content"))


def landed_once(spark: SparkSession, folder: str) -> DataFrame:
    """Files landed by a stream that is started twice: half are delivered again in another folder, some of these with a new content."""
    files = _as_files(spark, folder)
    source, out, checkpoint = (staging_path(spark, n) for n in ("landing", "landed", "landing-state"))
    objects.write_objects(files.select("key", "content"), source)
    land_stream(spark, source, checkpoint, out, "docs").awaitTermination()
    changed = F.when(F.pmod("doc_id", F.lit(8)) == 0, F.concat(F.encode(F.lit("new "), "UTF-8"), "content")).otherwise(F.col("content"))
    objects.write_objects(files.filter("doc_id % 2 = 0").select(F.concat(F.lit("again/"), "key").alias("key"), changed.alias("content")), source)
    land_stream(spark, source, checkpoint, out, "docs").awaitTermination()
    landed = spark.read.parquet(out)
    return landed.select("class", F.regexp_replace("dst_key", r"\$\d{4}-[^$]*Z\$", r"\$").alias("target"), F.md5("content").alias("content_md5"), "length")


_LANDED = """
f AS (SELECT doc_id, text, ['json', 'jpg', 'png', 'jsonl'][doc_id % 5 + 1] AS ext, source || '_' || doc_id AS name,
    CASE WHEN doc_id % 5 IN (1, 2) THEN 'image' ELSE 'document' END AS class FROM documents WHERE text <> '' AND doc_id % 5 < 4),
"""
LANDED_ONCE = f"""
WITH {_LANDED} all_ AS (SELECT *, text AS t FROM f UNION ALL SELECT *, 'new ' || text FROM f WHERE doc_id % 8 = 0)
SELECT class, 'persistent_landing/' || class || 's/' || class || '$docs$' || name || '.' || ext AS target, md5(t) AS content_md5, strlen(t) AS length FROM all_
"""


def moved_objects(spark: SparkSession, folder: str) -> DataFrame:
    """Batch landing: objects under their target keys, and what stayed at the source."""
    source, out = staging_path(spark, "landing"), staging_path(spark, "landed")
    objects.write_objects(_as_files(spark, folder).select("key", "content"), source)
    land_move(spark, source, out, "docs", "2024-01-01T00-00-00Z")
    rows = [objects.stored_objects(spark, p).select(F.lit(n).alias("place"), "key", F.md5("content").alias("content_md5")) for n, p in (("source", source), ("target", out))]
    return rows[0].unionByName(rows[1])


MOVED_OBJECTS = f"""
WITH {_LANDED} kept AS (SELECT * FROM documents WHERE text <> '' AND doc_id % 5 = 4)
SELECT 'target' AS place, 'persistent_landing/' || class || 's/' || class || '$docs$2024-01-01T00-00-00Z$' || name || '.' || ext AS key, md5(text) AS content_md5 FROM f
UNION ALL SELECT 'source', lang || '/' || source || '_' || doc_id || '.tar', md5(text) FROM kept
"""

def id_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct ids of three runs that overlap, one of them repeated: counted apart and together, and the keys of each id."""
    docs = B.table(spark, folder, "documents").select(F.concat_ws(":", "lang", F.col("n_chars").cast("string")).alias("id"), F.col("doc_id").cast("string").alias("key"), "doc_id")
    path = staging_path(spark, "id-sets")
    for run, part in (("a", "doc_id % 2 = 0"), ("b", "doc_id % 3 = 0"), ("a", "doc_id % 2 = 0"), ("c", "doc_id % 2 = 1")):
        idsets.add_ids(docs.filter(part).select("id", "key"), path, run)
    out = spark.createDataFrame([], "runs string, ids bigint")
    for runs in (["a"], ["b"], ["a", "b"], None):
        out = out.unionByName(idsets.count_ids(spark, path, runs).withColumn("runs", F.lit("+".join(runs or ["all"]))))
    keys = idsets.keys_of_ids(spark, path).groupBy("id").agg(F.sum(F.size("keys")).alias("n"))
    return out.unionByName(keys.groupBy("n").agg(F.count(F.lit(1)).alias("ids")).select(F.concat(F.lit("keys "), "n").alias("runs"), "ids"))


ID_SETS = """
WITH d AS (SELECT lang || ':' || n_chars AS id, doc_id FROM documents), k AS (SELECT id, count(*) AS n FROM d GROUP BY id)
SELECT 'a' AS runs, count(DISTINCT id) AS ids FROM d WHERE doc_id % 2 = 0
UNION ALL SELECT 'b', count(DISTINCT id) FROM d WHERE doc_id % 3 = 0
UNION ALL SELECT 'a+b', count(DISTINCT id) FROM d WHERE doc_id % 2 = 0 OR doc_id % 3 = 0
UNION ALL SELECT 'all', count(DISTINCT id) FROM d
UNION ALL SELECT 'keys ' || n, count(*) FROM k GROUP BY n
"""

QUERIES = {"id_sets": id_sets, "landed_once": landed_once, "moved_objects": moved_objects, "object_sink": object_sink, "collection_versions": collection_versions, "image_cap": image_cap, "scan_array": scan_array, "scan_quarantine": scan_quarantine, "ingest_counters": ingest_counters, "stored_records": stored_records}
SQL = {"id_sets": ID_SETS, "landed_once": LANDED_ONCE, "moved_objects": MOVED_OBJECTS, "object_sink": OBJECT_SINK, "collection_versions": COLLECTION_VERSIONS, "image_cap": IMAGE_CAP, "scan_array": SCAN_ARRAY, "scan_quarantine": SCAN_QUARANTINE, "ingest_counters": INGEST_COUNTERS, "stored_records": STORED_RECORDS}
