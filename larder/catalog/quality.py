"""Outlier, trusted-document and report queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.catalog import base as B
from larder.functions import text as T
from larder.functions import values as V
from larder.operators import outliers as O
from larder.operators import reports as R
from larder.plans.exploitation import document_entries, metadata_text
from larder.plans.trusted import dry_run_documents, nutrition_columns, trust_documents
from larder.session import staged, staging_path


def _rounded(bounds: DataFrame, columns: list[str], label: str) -> DataFrame:
    rows = None
    for c in columns:
        row = bounds.select(
            F.lit(f"{label}.{c}").alias("field"),
            *[F.round(f"{c}_{x}", 6).alias(x) for x in ("q1", "q3", "lo", "hi")],
        )
        rows = row if rows is None else rows.unionByName(row)
    return rows


FIELDS = (("events", "value"), ("documents", "n_chars"), ("orders", "o_totalprice"), ("lineitem", "l_extendedprice"))


def _all_bounds(spark: SparkSession, folder: str, method: str) -> DataFrame:
    rows = None
    for name, column in FIELDS:
        part = _rounded(O.iqr_bounds(B.table(spark, folder, name), [column], method=method), [column], name)
        rows = part if rows is None else rows.unionByName(part)
    return rows


def iqr_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return _all_bounds(spark, folder, "auto")


def iqr_bounds_select(spark: SparkSession, folder: str) -> DataFrame:
    """The same bounds by exact selection over narrowing value ranges."""
    return _all_bounds(spark, folder, "select")


def _sql_bounds(name: str, column: str) -> str:
    return f"""SELECT '{name}.{column}' AS field, round(q1, 6) AS q1, round(q3, 6) AS q3,
        round(q1 - 1.5 * (q3 - q1), 6) AS lo, round(q3 + 1.5 * (q3 - q1), 6) AS hi
        FROM (SELECT quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.75) AS q3 FROM {name})"""


IQR_BOUNDS = " UNION ALL ".join(_sql_bounds(n, c) for n, c in FIELDS)


def iqr_filter(spark: SparkSession, folder: str) -> DataFrame:
    events = B.table(spark, folder, "events")
    bounds = O.iqr_bounds(events, ["value"])
    return O.iqr_filter(events, ["value"], bounds).select("event_id", "value")


def iqr_filter_multi(spark: SparkSession, folder: str) -> DataFrame:
    """Two fields at once; the second is missing for unlabelled documents and then passes."""
    labels = B.table(spark, folder, "labels").select("doc_id", F.lit(True).alias("labelled"))
    docs = B.table(spark, folder, "documents").join(labels, "doc_id", "left")
    docs = docs.withColumn("words", F.when(F.col("labelled"), T.token_len("text"))).select("doc_id", "n_chars", "words")
    columns = ["n_chars", "words"]
    return O.iqr_filter(docs, columns, O.iqr_bounds(docs, columns))


IQR_FILTER_MULTI = f"""
WITH d AS (SELECT doc_id, n_chars, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN {B.sql_tokens("text")} END AS words
           FROM documents),
q AS (SELECT quantile_cont(n_chars, 0.25) AS a1, quantile_cont(n_chars, 0.75) AS a3,
             quantile_cont(words, 0.25) AS b1, quantile_cont(words, 0.75) AS b3 FROM d)
SELECT doc_id, n_chars, CAST(words AS INTEGER) AS words FROM d, q
WHERE coalesce(n_chars BETWEEN a1 - 1.5 * (a3 - a1) AND a3 + 1.5 * (a3 - a1), true)
  AND coalesce(words BETWEEN b1 - 1.5 * (b3 - b1) AND b3 + 1.5 * (b3 - b1), true)
"""


def _text_list(c: Column) -> Column:
    return F.array(F.struct(c.alias("text")))


def merged_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as a stored table of merged recipes.

    First line, source and text are the texts, sizes and labels the nutrition data.
    """
    labels = B.table(spark, folder, "labels")
    docs = B.table(spark, folder, "documents").join(labels, "doc_id", "left")
    first = F.split_part("text", F.lit("\n"), F.lit(1))
    tag, info = "__from_layer1", "__from_recipes_with_nutritional_info"
    totals = F.struct(
        F.col("n_chars").alias("energy"), T.token_len("text").alias("fat"), F.col("lang").alias("protein")
    )
    lights = F.struct(F.when(F.col("toxic") == 1, "red").alias("fat"), F.col("lang").alias("salt"))
    values = {
        f"title{tag}": F.when(F.col("source") != "src1", first),
        f"title{info}": F.col("source"),
        f"ingredients{tag}": F.when(F.col("lang") != "en", _text_list(F.col("source"))),
        f"ingredients{info}": _text_list(F.col("lang")),
        f"instructions{tag}": _text_list(F.col("text")),
        "nutr_values_per100g": F.when(F.col("lang") != "fr", totals),
        "nutr_per_ingredient": F.when(F.col("quality") == 1, F.array(F.col("quality"))),
        f"fsa_lights_per100g{info}": lights,
    }
    entries = [F.struct(F.lit(k).alias("k"), V.parse_json(F.to_json(F.struct(v.alias("v")))).alias("v")) for k, v in values.items()]
    inner = F.transform(F.array(*entries), lambda e: F.struct(e["k"], F.try_variant_get(e["v"], "$.v", "variant").alias("v")))
    present = F.filter(inner, lambda e: e["v"].isNotNull())
    merged = docs.select(
        F.col("doc_id").cast("string").alias("id"), F.lit(0).cast("bigint").alias("part"), F.map_from_entries(present).alias("fields")
    )
    return staged(merged, "merged")


def _ids(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents count as having an image."""
    return B.table(spark, folder, "labels").select(F.col("doc_id").cast("string").alias("id"))


_RAW = f"""
m AS (SELECT d.doc_id, CAST(d.doc_id AS VARCHAR) AS id, source, lang, text, n_chars, toxic, quality,
    l.doc_id IS NOT NULL AS has_image, lang <> 'fr' AS has_totals, coalesce(quality = 1, false) AS has_parts,
    CASE WHEN lang <> 'fr' THEN n_chars END AS energy, CASE WHEN lang <> 'fr' THEN {B.sql_tokens("text")} END AS fat,
    coalesce(CASE WHEN source <> 'src1' THEN nullif({"split_part(text, chr(10), 1)"}, '') END, source) AS title_raw,
    CASE WHEN lang <> 'en' THEN source ELSE lang END AS ingredients_raw, text AS instructions_raw
    FROM documents d LEFT JOIN labels l USING (doc_id)),
q AS (SELECT quantile_cont(energy, 0.25) AS a1, quantile_cont(energy, 0.75) AS a3,
             quantile_cont(fat, 0.25) AS b1, quantile_cont(fat, 0.75) AS b3 FROM m WHERE has_image),
f AS (SELECT m.*, {B.sql_without_stopwords(B.sql_clean("title_raw"))} AS title_clean,
    {B.sql_without_stopwords(B.sql_clean("ingredients_raw"))} AS ingredients_clean,
    {B.sql_without_stopwords(B.sql_clean("instructions_raw"))} AS instructions_clean,
    NOT (coalesce(energy BETWEEN a1 - 1.5 * (a3 - a1) AND a3 + 1.5 * (a3 - a1), true)
         AND coalesce(fat BETWEEN b1 - 1.5 * (b3 - b1) AND b3 + 1.5 * (b3 - b1), true)) AS outlier
    FROM m, q)
"""


def _trusted(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    out = staging_path(spark, "trusted")
    return trust_documents(merged_documents(spark, folder), _ids(spark, folder), out=out)


def trusted_documents(spark: SparkSession, folder: str) -> DataFrame:
    rows = _trusted(spark, folder)["trusted"]
    return rows.select(
        "id",
        "has_nutrition_data",
        "nutrition_normalized",
        F.size("fields").alias("n_fields"),
        F.map_contains_key("fields", "nutr_values_per100g").alias("has_totals"),
        *[f"{p}_text_{f}" for p in ("title", "ingredients", "instructions") for f in ("raw", "clean")],
    )


TRUSTED_DOCUMENTS = f"""
WITH {_RAW}
SELECT id, has_totals OR has_parts AS has_nutrition_data, has_parts AS nutrition_normalized,
       CAST((source <> 'src1')::INT + 1 + (lang <> 'en')::INT + 1 + 1 + (has_totals AND NOT has_parts)::INT + has_parts::INT + 1
            AS INTEGER) AS n_fields, has_totals AND NOT has_parts AS has_totals,
       title_raw AS title_text_raw, title_clean AS title_text_clean, ingredients_raw AS ingredients_text_raw,
       ingredients_clean AS ingredients_text_clean, instructions_raw AS instructions_text_raw,
       instructions_clean AS instructions_text_clean
FROM f WHERE has_image AND NOT outlier
"""

_PARTS = ("title", "ingredients", "instructions")


def document_report(spark: SparkSession, folder: str) -> DataFrame:
    return _with_thresholds(_trusted(spark, folder)["report"])


def _with_thresholds(report: DataFrame) -> DataFrame:
    """The thresholds of the two fields with numbers as columns; the other four fields have none."""
    bounds = F.from_json("iqr_thresholds", "map<string,double>")
    named = {f"{c}_{x}": F.round(bounds[f"{c}_{x}"], 6) for c in ("energy", "fat") for x in ("q1", "q3", "lo", "hi")}
    return report.withColumns(named | {"n_thresholds": F.size(bounds)}).drop("iqr_thresholds")


def trusted_dry_run(spark: SparkSession, folder: str) -> DataFrame:
    """What the trusted stage would keep and drop, with three unreadable records counted, without storing anything."""
    bad = B.table(spark, folder, "region").limit(3)
    counts = dry_run_documents(merged_documents(spark, folder), _ids(spark, folder), require_nutrition=True, malformed=bad)
    return _with_thresholds(counts)


_MEANS = ", ".join(
    f"round(avg({B.sql_tokens(f'{p}_{f}')}) FILTER (kept), 6) AS tokens_{p}_text_{f}" for p in _PARTS for f in ("raw", "clean")
)
_THRESHOLDS = ", ".join(
    f"any_value(round({e}, 6)) AS {c}_{x}"
    for c, k in (("energy", "a"), ("fat", "b"))
    for x, e in (("q1", f"{k}1"), ("q3", f"{k}3"), ("lo", f"{k}1 - 1.5 * ({k}3 - {k}1)"), ("hi", f"{k}3 + 1.5 * ({k}3 - {k}1)"))
) + ", 8 AS n_thresholds"
DOCUMENT_REPORT = f"""
WITH {_RAW}, g AS (SELECT *, has_image AND NOT outlier AS kept FROM f)
SELECT count(*) AS total_doc_count, CAST(0 AS BIGINT) AS malformed_doc_count, count(*) FILTER (kept) AS kept_after_id,
       count(*) FILTER (kept) AS written_doc_count, CAST(0 AS BIGINT) AS dropped_missing_nutrition,
       count(*) FILTER (has_image AND outlier) AS dropped_outliers,
       count(*) FILTER (kept AND has_totals AND has_parts) AS nutrition_totals_dropped,
       printf('%.2f%%', count(*) FILTER (kept) * 100.0::DOUBLE / count(*)) AS filtering_rate, {_MEANS},
       count(*) FILTER (has_image) AS unique_ids_with_images, {_THRESHOLDS}
FROM g, q
"""
TRUSTED_DRY_RUN = f"""
WITH {_RAW}, g AS (SELECT *, has_image AND NOT (has_totals OR has_parts) AS missing FROM f),
h AS (SELECT *, has_image AND NOT missing AND NOT outlier AS kept FROM g)
SELECT count(*) + 3 AS total_doc_count, CAST(3 AS BIGINT) AS malformed_doc_count, count(*) FILTER (kept) AS kept_after_id,
       count(*) FILTER (kept) AS written_doc_count, count(*) FILTER (missing) AS dropped_missing_nutrition,
       count(*) FILTER (has_image AND NOT missing AND outlier) AS dropped_outliers,
       count(*) FILTER (kept AND has_totals AND has_parts) AS nutrition_totals_dropped,
       printf('%.2f%%', count(*) FILTER (kept) * 100.0::DOUBLE / (count(*) + 3)) AS filtering_rate, {_THRESHOLDS}
FROM h, q
"""


def nutrition_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Chosen nutrition fields, numeric values by JSON type, and the derived flags."""
    rows = nutrition_columns(merged_documents(spark, folder))
    numbers = F.col("nutrition_values")
    return rows.select(
        "id", "totals_key", "per_ingredient_key", numbers[0].alias("energy"), numbers[1].alias("fat"),
        numbers[2].alias("protein"), numbers[3].alias("salt"),
        "has_nutrition_data", "totals_dropped", "nutrition_normalized",
    )


NUTRITION_FLAGS = f"""
WITH {_RAW}
SELECT id, CASE WHEN has_totals THEN 'nutr_values_per100g' END AS totals_key,
       CASE WHEN has_parts THEN 'nutr_per_ingredient' END AS per_ingredient_key,
       CAST(energy AS DOUBLE) AS energy, CAST(fat AS DOUBLE) AS fat, CAST(NULL AS DOUBLE) AS protein, CAST(NULL AS DOUBLE) AS salt,
       has_totals OR has_parts AS has_nutrition_data, has_totals AND has_parts AS totals_dropped, has_parts AS nutrition_normalized
FROM f
"""


def text_entries(spark: SparkSession, folder: str) -> DataFrame:
    """Text entries of the trusted documents, as stored in a collection."""
    return document_entries(_trusted(spark, folder)["trusted"])


_TITLE = "trim(coalesce(nullif(title_clean, ''), source))"
_INGREDIENTS = "coalesce(nullif(ingredients_clean, ''), lang)"
_INSTRUCTIONS = "coalesce(nullif(instructions_clean, ''), trim(text))"
TEXT_ENTRIES = f"""
WITH {_RAW}, e AS (SELECT *, {_TITLE} AS t, {_INGREDIENTS} AS i, {_INSTRUCTIONS} AS s FROM f WHERE has_image AND NOT outlier)
SELECT id, trim(concat_ws(chr(10), CASE WHEN t <> '' THEN 'title: ' || t END, CASE WHEN i <> '' THEN 'ingredients: ' || i END,
                 CASE WHEN s <> '' THEN 'instructions: ' || s END)) AS document,
       'text' AS type, t AS title, has_parts AS has_nutrition, 'trusted-zone' AS source_bucket,
       CASE WHEN toxic = 1 THEN 'red' END AS fsa_fat, lang AS fsa_salt,
       CAST(NULL AS VARCHAR) AS fsa_saturates, CAST(NULL AS VARCHAR) AS fsa_sugars
FROM e
"""


def entry_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata JSON of the entries, absent values left out."""
    return metadata_text(text_entries(spark, folder).drop("title"))


ENTRY_METADATA = f"""
WITH {_RAW}
SELECT id, '{{"id":"' || id || '","type":"text","has_nutrition":' || has_parts || ',"source_bucket":"trusted-zone"' ||
       CASE WHEN toxic = 1 THEN ',"fsa_fat":"red"' ELSE '' END || ',"fsa_salt":"' || lang || '"}}' AS metadata
FROM f WHERE has_image AND NOT outlier
"""


def _stages(spark: SparkSession, folder: str) -> DataFrame:
    """Event types as stages: their events give duration, memory and outcome."""
    return B.table(spark, folder, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("memory_usage"),
        F.sum("user_id").alias("disk_usage"),
        F.round(F.max("value"), 6).alias("duration"),
        (F.count_if(F.col("value") > 100) % 2 == 0).alias("success"),
    ).withColumnRenamed("event_type", "stage")


SQL_STAGES = """
s AS (SELECT event_type AS stage, count(*) AS memory_usage, CAST(sum(user_id) AS BIGINT) AS disk_usage,
      round(max(value), 6) AS duration, count(*) FILTER (value > 100) % 2 = 0 AS success FROM events GROUP BY event_type)
"""


def run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    errors = B.table(spark, folder, "events").filter(F.col("event_type") == "error")
    summary = R.run_summary(_stages(spark, folder), errors)
    return summary.withColumn("total_duration", F.round("total_duration", 4))


def sample_metrics(spark: SparkSession, folder: str) -> DataFrame:
    summary = R.sample_summary(B.table(spark, folder, "events"), ["value", "user_id"])
    return summary.withColumns({"avg_value": F.round("avg_value", 4), "avg_user_id": F.round("avg_user_id", 4)})


def stage_lines(spark: SparkSession, folder: str) -> DataFrame:
    return R.stage_lines(_stages(spark, folder))


QUERIES = {
    "iqr_bounds": iqr_bounds,
    "iqr_bounds_select": iqr_bounds_select,
    "iqr_filter": iqr_filter,
    "iqr_filter_multi": iqr_filter_multi,
    "nutrition_flags": nutrition_flags,
    "trusted_documents": trusted_documents,
    "document_report": document_report,
    "trusted_dry_run": trusted_dry_run,
    "text_entries": text_entries,
    "entry_metadata": entry_metadata,
    "run_metrics": run_metrics,
    "sample_metrics": sample_metrics,
    "stage_lines": stage_lines,
}

SQL = {
    "iqr_bounds": IQR_BOUNDS,
    "iqr_bounds_select": IQR_BOUNDS,
    "iqr_filter": """
        WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
        SELECT event_id, value FROM events, q WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""",
    "iqr_filter_multi": IQR_FILTER_MULTI,
    "nutrition_flags": NUTRITION_FLAGS,
    "trusted_documents": TRUSTED_DOCUMENTS,
    "document_report": DOCUMENT_REPORT,
    "trusted_dry_run": TRUSTED_DRY_RUN,
    "text_entries": TEXT_ENTRIES,
    "entry_metadata": ENTRY_METADATA,
    "run_metrics": f"""
        WITH {SQL_STAGES}
        SELECT round(sum(duration), 4) AS total_duration, CAST(sum(memory_usage) AS BIGINT) AS total_memory_usage,
               CAST(sum(disk_usage) AS BIGINT) AS total_disk_usage, count(*) FILTER (success) AS successful_stages,
               count(*) FILTER (NOT success) AS failed_stages, count(*) AS total_stages,
               (SELECT count(*) FROM events WHERE event_type = 'error') AS error_count FROM s""",
    "sample_metrics": """
        SELECT count(*) * 5 AS monitoring_duration, round(avg(value), 4) AS avg_value, max(value) AS max_value,
               min(value) AS min_value, round(avg(user_id), 4) AS avg_user_id, max(user_id) AS max_user_id,
               min(user_id) AS min_user_id, count(*) AS data_points FROM events""",
    "stage_lines": f"""
        WITH {SQL_STAGES}
        SELECT stage, stage || ': ' || printf('%.2f', duration) || 's, ' || printf('%.1f', memory_usage / 1048576.0::DOUBLE)
               || ' MB, ' || CASE WHEN success THEN 'Success' ELSE 'Failed' END AS line FROM s""",
}
