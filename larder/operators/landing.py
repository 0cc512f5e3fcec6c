"""Landing: source filters, object classification, image manifests, indexes and counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import keys as K
from larder.operators.ranking import weighted_cut

# Repository housekeeping files that are never landed.
SKIP_FILES = (".gitattributes", ".gitignore", ".gitkeep")


def is_source_file(path: Column | str, skip: Sequence[str] = SKIP_FILES) -> Column:
    """False for dot files, tar archives and names in the skip list."""
    name = K.file_name(path)
    return ~(name.startswith(".") | name.endswith(".tar") | name.isin(*skip))


def is_object(key: Column | str) -> Column:
    """False for folder markers and keys starting with a dot."""
    c = F.col(key) if isinstance(key, str) else key
    return ~(c.endswith("/") | c.startswith("."))


def organise(
    objects: DataFrame,
    bucket: str,
    dataset: str,
    timestamp: Column | str,
    image_prefix: str = "persistent_landing/images",
    document_prefix: str = "persistent_landing/documents",
) -> DataFrame:
    """Classify landed objects (``key``, ``content_type``) and give each its target key and provenance.

    Skipped objects stay in the result with class ``skip`` and a null target key.
    """
    ts = F.lit(timestamp) if isinstance(timestamp, str) else timestamp
    ctype = F.col("content_type")
    kind = F.when(is_object("key"), K.classify_object("key", ctype)).otherwise(F.lit("skip"))
    prefix = F.when(F.col("class") == "image", F.lit(image_prefix)).otherwise(F.lit(document_prefix))
    dst = K.target_key(
        F.col("class"), F.lit(dataset), ts, K.base_name("key"), K.extension("key", ctype), prefix
    )
    metadata = F.create_map(
        F.lit("src-bucket"), F.lit(bucket),
        F.lit("src-key"), F.col("key"),
        F.lit("dataset"), F.lit(dataset),
        F.lit("ingestion-ts"), ts,
    )
    landed = F.col("class") != "skip"
    default = F.when(F.col("class") == "document", F.lit("application/json"))
    return (
        objects.withColumn("class", kind)
        .withColumn("dst_key", F.when(landed, dst))
        .withColumn("metadata", F.when(landed, metadata))
        .withColumn("content_type", F.coalesce(ctype, default))
    )


def land_objects(files: DataFrame, prefix: str, revision: str | None = None, repo: str | None = None) -> DataFrame:
    """Target key, content type and provenance of each source file (``path``)."""
    entries = [F.lit("original-path"), F.col("path")]
    for name, value in (("revision", revision), ("repo-id", repo)):
        if value:
            entries += [F.lit(name), F.lit(value)]
    by_ext = {e.lstrip("."): t for e, t in K.mimetypes.MimeTypes().types_map[True].items()}
    lookup = F.create_map(*[F.lit(x) for pair in sorted(by_ext.items()) for x in pair])
    return files.select(
        "*",
        F.concat(F.lit(f"{prefix}/"), K.object_key("path")).alias("key"),
        F.element_at(lookup, K.file_suffix("path")).alias("content_type"),
        F.create_map(*entries).alias("metadata"),
    )


def class_counters(organised: DataFrame) -> DataFrame:
    """One row: objects in total, images, documents and skipped."""
    c = F.col("class")
    return organised.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(c == "image").alias("moved_images"),
        F.count_if(c == "document").alias("moved_documents"),
        F.count_if(c == "skip").alias("skipped_files"),
    )


def image_manifest(recipes: DataFrame, prefix: str) -> DataFrame:
    """One row per image URL of ``id, images ARRAY<STRUCT<url>>``; entries without a URL are skipped.

    The index counts all entries, also the skipped ones.
    """
    rows = recipes.select(F.trim("id").alias("id"), F.posexplode("images").alias("index", "image"))
    url = F.col("image.url")
    return rows.filter(url.isNotNull() & (url != "")).select(
        "id",
        "index",
        url.alias("url"),
        K.image_key(F.lit(prefix), F.col("id"), F.col("index"), K.url_extension(url)).alias("key"),
        F.create_map(
            F.lit("source-url"), url,
            F.lit("recipe-id"), F.col("id"),
            F.lit("image-index"), F.col("index").cast("string"),
        ).alias("metadata"),
    )


def ingest_cap(
    recipes: DataFrame, order: str, ok: str = "ok", max_recipes: int | None = 1000, max_images: int | None = 50
) -> DataFrame:
    """Leading recipes up to and including the one that reaches a cap.

    The cap is the operator's purpose; None lifts one. With fewer recipes or images in all than the cap every recipe stays. The
    value of ``order`` at which a cap is reached comes from sums over ordered ranges, so no window runs over all recipes.
    """
    caps = [(F.lit(1), max_recipes), (F.greatest(F.col(ok), F.lit(0)), max_images)]
    kept = recipes
    for weight, cap in caps:
        if cap is None:
            continue
        if cap <= 0:
            return recipes.limit(0)
        last = weighted_cut(kept.select(order, ok), order, weight, cap)
        if last is not None:
            kept = kept.filter(F.col(order) <= F.lit(last))
    return kept


def recipe_index(objects: DataFrame) -> DataFrame:
    """Distinct ``id, key`` pairs of JSON documents (``key``, ``v VARIANT``).

    Ids are taken from a root object, the elements of a root array, and objects one level down in the
    array values of a root object. A line of a JSONL file counts with its own id only.
    """
    spark = objects.sparkSession

    def children(df: DataFrame) -> DataFrame:
        inner = spark.tvf.variant_explode(F.col("v").outer()).select(F.col("value").alias("child"))
        return df.lateralJoin(inner).select("key", F.col("child").alias("v"))

    def kind(df: DataFrame, prefix: str) -> DataFrame:
        return df.filter(F.schema_of_variant("v").startswith(prefix))

    docs = objects.select("key", "v")
    whole = ~F.lower("key").rlike(r"\.(jsonl|ndjson)$")
    arrays = kind(docs.filter(whole), "ARRAY")
    roots = kind(docs, "OBJECT")
    nested = kind(children(roots.filter(whole)), "ARRAY")
    holders = roots.unionByName(kind(children(arrays), "OBJECT")).unionByName(kind(children(nested), "OBJECT"))
    return (
        holders.select(F.try_variant_get("v", "$.id", "string").alias("id"), "key")
        .filter(F.col("id").isNotNull())
        .distinct()
    )


def image_index(keys: DataFrame) -> DataFrame:
    """``key, image_id``."""
    return keys.select("key", K.image_index_id("key").alias("image_id"))
