"""Readers: object listings, JSON records with format sniffing, images."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.functions import keys as K
from larder.functions import values as V
from larder.operators.ranking import group_rank
from larder.session import staged
from larder.sources.records import json_elements


def decoded_path(c: Column | str) -> Column:
    """File path of a metadata column with its percent-encoding undone."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.try_url_decode(F.replace(col, F.lit("+"), F.lit("%2B"))), col)


def any_case_glob(*suffixes: str) -> str:
    """File name pattern for suffixes in any letter case."""
    folded = ["".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in s) for s in suffixes]
    return "*.{" + ",".join(folded) + "}"


JSON_LINES = any_case_glob("jsonl", "ndjson", "jsonl.gz", "ndjson.gz")
JSON_FILES = any_case_glob("json", "json.gz")


def _suffix_pattern(extensions: Sequence[str]) -> str:
    return r"\.(" + "|".join(extensions) + ")$"


def list_objects(spark: SparkSession, path: str, extensions: Sequence[str] | None = None) -> DataFrame:
    """Listing as ``path, length, modified``; file contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )
    if extensions:
        files = files.filter(F.lower("path").rlike(_suffix_pattern(extensions)))
    return files


def scan_text(spark: SparkSession, path: str, glob: str | None = None, whole: bool = False) -> DataFrame:
    """Text lines, or whole files, with ``file, block, pos`` giving their order; gzip is read as is."""
    reader = spark.read.option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path, wholetext=whole).select(
        decoded_path("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        "value",
    )


def object_key_of(path: Column | str) -> Column:
    """Key of a file as every reader gives it: local paths have one slash behind the scheme."""
    return F.regexp_replace(F.col(path) if isinstance(path, str) else path, "^file:/+", "file:/")


NOT_JSON, TOO_LARGE, NOT_OBJECT = "not JSON", "too large for a value", "not an object"
SAMPLE = 200  # characters of an unreadable text that are kept


def _parsed(text: str, mode: str) -> Column:
    """Parsed root; a malformed text has a null root, or fails the job when told to.

    A well-formed text that is too large for a VARIANT fails the job in either mode: it would be lost otherwise.
    """
    if mode == "failfast":
        return F.parse_json(text)
    v = F.try_parse_json(text)
    large = v.isNull() & F.get_json_object(text, "$").isNotNull() & F.col(text).rlike(r"^\s*[\[{]")
    return F.when(large, F.raise_error(F.lit(f"JSON record {TOO_LARGE}; split it"))).otherwise(v)


def _records(rows: DataFrame, mode: str) -> DataFrame:
    """Add the parsed root of each non-empty text."""
    return rows.filter(F.trim("value") != "").withColumn("v", _parsed("value", mode))


def scan_lines(spark: SparkSession, path: str, glob: str = JSON_LINES) -> DataFrame:
    """Lines ended by a line feed as ``file, block, pos, value``; a carriage return stays as white space."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("lineSep", "\n")
    return reader.text(path).select(
        decoded_path("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"), "value",
    )


def scan_jsonl(
    spark: SparkSession, path: str, mode: str = "permissive", glob: str = JSON_LINES
) -> DataFrame:
    """One row per non-empty line: ``file, block, pos, value, v VARIANT``."""
    return _records(scan_lines(spark, path, glob), mode)


def scan_json_files(
    spark: SparkSession, path: str, mode: str = "permissive", glob: str = JSON_FILES
) -> DataFrame:
    """One row per array element or single value of ``*.json`` files: ``file, block, pos, value, v, at, reason``.

    Files of any size are read in blocks by many tasks. ``at`` is the byte offset. What is no element of a well-formed array has
    a ``reason`` and no root.
    """
    rows = json_elements(spark, path, glob).withColumn("file", decoded_path("file"))
    if mode == "failfast":
        broken = F.raise_error(F.concat(F.lit("MALFORMED array: "), "reason"))
        rows = rows.withColumn("value", F.when(F.col("reason").isNotNull(), broken).otherwise(F.col("value")))
    rows = rows.withColumn("_text", F.when(F.col("reason").isNull(), F.col("value")))
    return rows.withColumn("v", _parsed("_text", mode)).select("file", "block", "pos", "value", "v", "at", "reason")


def scan_json(spark: SparkSession, path: str, mode: str = "permissive") -> DataFrame:
    """Roots of every JSONL line, JSON array element and JSON value under a path, malformed ones too."""
    files = scan_json_files(spark, path, mode).drop("at", "reason")
    return scan_jsonl(spark, path, mode).unionByName(files)


def _is_object(text: str = "value") -> Column:
    """Of a text that is JSON."""
    return F.col(text).rlike(r"^\s*\{")


def _list_items() -> Column:
    """Items of a root list, null for another root."""
    return F.when(F.col("value").rlike(r"^\s*\["), F.try_variant_get("v", "$", "array<variant>"))


def scan_candidates(
    spark: SparkSession, path: str, mode: str = "permissive", lines: str = JSON_LINES, files: str = JSON_FILES
) -> DataFrame:
    """Every record and everything that is none: ``file, block, pos, item, v, reason``; records have no reason.

    Object roots are records, and so are the objects of a list that is the root of a line; ``item`` is the place in it. ``lines`` and
    ``files`` are the name patterns of JSON lines and of files that are one array or value.
    """
    rows = scan_jsonl(spark, path, mode, lines)
    root = F.when(F.col("v").isNull(), F.lit(NOT_JSON)).when(_is_object(), F.lit("object")).when(_list_items().isNotNull(), F.lit("list"))
    items = F.coalesce(_list_items(), F.array("v"))
    rows = rows.select("file", "block", "pos", F.coalesce(root, F.lit(NOT_OBJECT)).alias("_root"), F.posexplode(items).alias("item", "v"))
    other = F.when(V.root_type("v") != "object", F.lit(NOT_OBJECT))
    reason = F.when(F.col("_root") == "list", other).when(F.col("_root") != "object", F.col("_root"))
    rows = rows.select("file", "block", "pos", "item", "v", reason.alias("reason"))
    whole = scan_json_files(spark, path, mode, files)
    lost = F.coalesce("reason", F.when(F.col("v").isNull(), F.lit(NOT_JSON)).when(~_is_object(), F.lit(NOT_OBJECT)))
    return rows.unionByName(whole.select("file", "block", "pos", F.lit(0).alias("item"), "v", lost.alias("reason")))


def as_records(candidates: DataFrame) -> DataFrame:
    """Records ready to merge: ``file, block, pos, item, tag, id, v``."""
    return candidates.filter(F.col("reason").isNull()).select(
        "file",
        "block",
        "pos",
        "item",
        K.short_tag(F.regexp_replace("file", r"(?i)\.gz$", "")).alias("tag"),
        F.try_variant_get("v", "$.id", "string").alias("id"),
        "v",
    )


def scan_documents(spark: SparkSession, path: str, mode: str = "permissive") -> DataFrame:
    """The records under a path, ready to merge; ``quarantine`` tells about the rest."""
    return as_records(scan_candidates(spark, path, mode))


def scan_merged(spark: SparkSession, path: str, lines: str = JSON_LINES, files: str = JSON_FILES) -> tuple[DataFrame, DataFrame]:
    """Stored merged records as ``id, part, fields``, and the candidates that are no records.

    The lines of an id are its parts, in their order.
    """
    candidates = staged(scan_candidates(spark, path, lines=lines, files=files), "merged-records")
    rows = as_records(candidates).filter(F.col("id").isNotNull() & (F.trim("id") != ""))
    ranked = group_rank(rows, ["id"], ["file", "block", "pos", "item"], "_n", chunk=["file", "block"])
    return ranked.select("id", (F.col("_n") - 1).alias("part"), record_fields("v").alias("fields")), candidates.filter(F.col("reason").isNotNull())


def record_fields(v: str) -> Column:
    """Fields of an object VARIANT without its id."""
    return F.map_filter(F.try_variant_get(v, "$", "map<string,variant>"), lambda k, x: k != "id")


def _sample() -> Column:
    return F.left(F.regexp_replace("value", r"^\s+", ""), F.lit(SAMPLE))


def quarantine(spark: SparkSession, path: str, lines: str = JSON_LINES, files: str = JSON_FILES) -> DataFrame:
    """What ``scan_documents`` cannot use: ``file, at, item, reason, sample``.

    ``at`` is the byte offset of the line or element in its file (behind a byte order mark), ``item`` the place in a line that is a list. One pass
    over the lines parses them and keeps lengths; offsets are sums of lengths inside a block and of the blocks before.
    """
    object_, list_ = _is_object(), _list_items()
    root = F.struct(F.lit(0).alias("item"), F.lit(NOT_OBJECT).alias("reason"), _sample().alias("sample"))
    unread = root.withField("reason", F.lit(NOT_JSON))
    others = F.filter(
        F.transform(list_, lambda x, i: F.when(
            V.root_type(x) != "object", F.struct(i.alias("item"), F.lit(NOT_OBJECT).alias("reason"), F.left(F.to_json(x), F.lit(SAMPLE)).alias("sample"))
        )), lambda x: x.isNotNull(),
    )
    none = F.array().cast("array<struct<item:int,reason:string,sample:string>>")
    rows = scan_lines(spark, path, lines).withColumn("v", F.try_parse_json("value"))
    bad = F.when(F.trim(F.translate("value", "\t\r", "  ")) == "", none).when(F.col("v").isNull(), F.array(unread))
    bad = bad.when(object_, none).otherwise(F.coalesce(others, F.array(root)))
    lead = F.octet_length("value") - F.octet_length(F.regexp_replace("value", r"^\s+", ""))
    rows = staged(rows.select("file", "block", "pos", (F.octet_length("value") + 1).alias("n"), lead.alias("lead"), bad.alias("bad")), "line-lengths")
    blocks = rows.groupBy("file", "block").agg(F.sum("n").alias("n"), F.sum(F.size("bad")).alias("bad"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).filter("bad > 0").select("file", "block", "start")
    inside = Window.partitionBy("file", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(starts, ["file", "block"]).withColumn("at", F.col("start") + F.coalesce(F.sum("n").over(inside), F.lit(0)) + F.col("lead"))
    lost = placed.select("file", "at", F.inline("bad"))
    whole = scan_json_files(spark, path, glob=files)
    reason = F.coalesce("reason", F.when(F.col("v").isNull(), F.lit(NOT_JSON)).when(~_is_object(), F.lit(NOT_OBJECT)))
    rest = whole.select("file", "at", F.lit(0).alias("item"), reason.alias("reason"), _sample().alias("sample"))
    return lost.unionByName(rest.filter(F.col("reason").isNotNull())).select("file", "at", "item", "reason", "sample")


def scan_images(spark: SparkSession, path: str) -> DataFrame:
    """Decoded images as ``key, image``; an undecodable file has height and width -1."""
    images = (
        spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True).load(path)
    )
    return images.select(object_key_of(decoded_path("image.origin")).alias("key"), "image")


def scan_image_bytes(spark: SparkSession, path: str, bucket: str) -> DataFrame:
    """Encoded images as ``bucket, key, content``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.lit(bucket).alias("bucket"), object_key_of("path").alias("key"), "content")
