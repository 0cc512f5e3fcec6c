"""Text queries over documents, pages and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.catalog import base as B
from larder.functions import text as T
from larder.functions import values as V
from larder.operators import joins, outliers


def trusted_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents inside the length bounds, cleaned; mean token counts by language."""
    docs = joins.semi_join(B.table(spark, folder, "documents"), B.table(spark, folder, "labels"), "doc_id")
    bounds = outliers.iqr_bounds(docs, ["n_chars"])
    kept = outliers.iqr_filter(docs, ["n_chars"], bounds).withColumn("clean", T.clean_text("text"))
    return kept.groupBy("lang").agg(
        F.count(F.lit(1)).alias("docs"),
        F.round(F.avg(T.token_len("text")), 6).alias("raw_tokens"),
        F.round(F.avg(T.token_len("clean")), 6).alias("clean_tokens"),
    )


TRUSTED_TEXTS = f"""
WITH docs AS (SELECT * FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)),
q AS (SELECT quantile_cont(n_chars, 0.25) AS q1, quantile_cont(n_chars, 0.75) AS q3 FROM docs),
kept AS (SELECT lang, text, {B.sql_without_stopwords(B.sql_clean("text"))} AS clean FROM docs, q
         WHERE n_chars BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))
SELECT lang, count(*) AS docs, round(avg({B.sql_tokens("text")}), 6) AS raw_tokens,
       round(avg({B.sql_tokens("clean")}), 6) AS clean_tokens
FROM kept GROUP BY lang
"""


def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    return B.table(spark, folder, "documents").select("doc_id", T.clean_text("text", stop=None).alias("clean"))


def clean_text_stopwords(spark: SparkSession, folder: str) -> DataFrame:
    return B.table(spark, folder, "documents").select("doc_id", T.clean_text("text").alias("clean"))


def clean_text_punctuation(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = T.clean_text("text", punctuation=False)
    return B.table(spark, folder, "conversations").select("conv_id", "turn", cleaned.alias("clean"))


def transliterate(spark: SparkSession, folder: str) -> DataFrame:
    return B.table(spark, folder, "pages").select("page_id", T.to_ascii("html").alias("ascii"))


def token_stats(spark: SparkSession, folder: str) -> DataFrame:
    docs = B.table(spark, folder, "documents").withColumn("clean", T.clean_text("text"))
    return docs.groupBy("source").agg(
        F.count(F.lit(1)).alias("docs"),
        F.round(F.avg(T.token_len("text")), 6).alias("raw_tokens"),
        F.round(F.avg(T.token_len("clean")), 6).alias("clean_tokens"),
    )


def join_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of a document as a text list with nulls for empty lines, joined again."""
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(F.nullif(x, F.lit("")).alias("text")))
    docs = B.table(spark, folder, "documents").withColumn("lines", lines)
    return docs.select(
        "doc_id",
        T.join_text_list("lines").alias("joined"),
        T.join_text_list_stripped("lines").alias("joined_stripped"),
    )


def document_text(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled text assembled from the first line, the language and the cleaned remainder, and read back."""
    first = F.split_part("text", F.lit("\n"), F.lit(1))
    rest = T.clean_text(F.substring("text", F.length(first) + 2, F.length("text")), stop=None)
    docs = B.table(spark, folder, "documents").withColumn("document", T.document_text(T.clean_text(first), "lang", rest))
    sections = [T.document_section("document", n).alias(n) for n in ("title", "ingredients", "instructions")]
    return docs.select("doc_id", "document", *sections)


_FIRST = "split_part(text, chr(10), 1)"
_TITLE = B.sql_without_stopwords(B.sql_clean(_FIRST))
_REST = B.sql_clean(f"substr(text, length({_FIRST}) + 2)")
DOCUMENT_TEXT = f"""
WITH parts AS (SELECT doc_id, {_TITLE} AS title, lang AS ingredients, {_REST} AS instructions FROM documents)
SELECT doc_id, title, ingredients, instructions,
       trim(concat_ws(chr(10), CASE WHEN title <> '' THEN 'title: ' || title END,
                      CASE WHEN ingredients <> '' THEN 'ingredients: ' || ingredients END,
                      CASE WHEN instructions <> '' THEN 'instructions: ' || instructions END)) AS document
FROM parts
"""


def preview(spark: SparkSession, folder: str) -> DataFrame:
    return B.table(spark, folder, "documents").select("doc_id", T.preview("text").alias("preview"))


_LETTER = r"[\p{L}]"
PREVIEW = rf"""
WITH t AS (SELECT doc_id, {B.sql_collapse("text")} AS t FROM documents),
cuts AS (SELECT doc_id, t,
    regexp_extract(t, '^(.{{0,179}})(?:\s|$)', 1) AS word_cut,
    regexp_extract(t, '^(.{{0,176}}{_LETTER}{{2}}-){_LETTER}-?{_LETTER}', 1) AS hyphen_cut FROM t)
SELECT doc_id, CASE WHEN length(t) <= 180 THEN t
    WHEN length(hyphen_cut) > length(word_cut) THEN hyphen_cut || '…' ELSE word_cut || '…' END AS preview
FROM cuts
"""


def snippet(spark: SparkSession, folder: str) -> DataFrame:
    return B.table(spark, folder, "conversations").select("conv_id", "turn", T.snippet("text").alias("snippet"))


def truthy_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """First filled of cleaned second line, first line and language; null and empty both fall through."""
    second = F.split_part("text", F.lit("\n"), F.lit(2))
    docs = B.table(spark, folder, "documents")
    chosen = T.first_filled(F.nullif(T.clean_text(second), F.lit("the")), T.clean_text(F.col("source")), "lang")
    return docs.select("doc_id", chosen.alias("chosen"))


_SECOND = B.sql_without_stopwords(B.sql_clean("split_part(text, chr(10), 2)"))


def json_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers of a JSON column by type: the string form of the same value does not count."""
    events = B.table(spark, folder, "events").withColumn("v", V.parse_json("props"))
    as_text = V.parse_json(F.regexp_replace("props", r"(\d+)", '"$1"'))
    return events.select(
        "event_id",
        V.root_type("v").alias("root"),
        V.finite_number("v", "$.k").alias("k"),
        V.finite_number("v", "$.missing").alias("missing"),
        V.finite_number(as_text, "$.k").alias("quoted"),
        V.fold_numbers("v").alias("folded"),
    )


JSON_FIELDS = r"""
SELECT event_id, lower(json_type(props)) AS root,
       CASE WHEN json_type(props, '$.k') IN ('UBIGINT', 'BIGINT', 'DOUBLE')
            THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k,
       CAST(json_extract_string(props, '$.missing') AS DOUBLE) AS missing,
       CAST(NULL AS DOUBLE) AS quoted, replace(props, ' ', '') AS folded
FROM events
"""


def metadata_without_nulls(spark: SparkSession, folder: str) -> DataFrame:
    docs = B.table(spark, folder, "documents").join(B.table(spark, folder, "labels"), "doc_id", "left")
    return docs.select("doc_id", V.metadata_json("lang", "quality", "toxic").alias("metadata"))


METADATA = """
SELECT d.doc_id, '{' || concat_ws(',', '"lang":"' || lang || '"', '"quality":' || quality, '"toxic":' || toxic) || '}'
    AS metadata FROM documents d LEFT JOIN labels l USING (doc_id)
"""


def colour_badges(spark: SparkSession, folder: str) -> DataFrame:
    """Label pairs as traffic lights; unlabelled documents are white."""
    docs = B.table(spark, folder, "documents").join(B.table(spark, folder, "labels"), "doc_id", "left")
    colour = F.when(F.col("toxic") == 1, "red").when(F.col("quality") == 1, "green").when(F.col("quality") == 0, "orange")
    return docs.select("doc_id", T.colour_badge(colour).alias("badge"))


QUERIES = {
    "trusted_texts": trusted_texts,
    "clean_text": clean_text,
    "clean_text_stopwords": clean_text_stopwords,
    "clean_text_punctuation": clean_text_punctuation,
    "transliterate": transliterate,
    "token_stats": token_stats,
    "join_lines": join_lines,
    "document_text": document_text,
    "preview": preview,
    "snippet": snippet,
    "truthy_fallback": truthy_fallback,
    "json_fields": json_fields,
    "metadata_without_nulls": metadata_without_nulls,
    "colour_badges": colour_badges,
}

SQL = {
    "trusted_texts": TRUSTED_TEXTS,
    "clean_text": f"SELECT doc_id, {B.sql_clean('text')} AS clean FROM documents",
    "clean_text_stopwords": f"""
        SELECT doc_id, {B.sql_without_stopwords(B.sql_clean('text'))} AS clean FROM documents""",
    "clean_text_punctuation": f"""
        SELECT conv_id, turn, {B.sql_without_stopwords(B.sql_clean('text', False))} AS clean FROM conversations""",
    "transliterate": f"SELECT page_id, {B.sql_ascii('html')} AS ascii FROM pages",
    "token_stats": f"""
        WITH c AS (SELECT source, text, {B.sql_without_stopwords(B.sql_clean('text'))} AS clean FROM documents)
        SELECT source, count(*) AS docs, round(avg({B.sql_tokens('text')}), 6) AS raw_tokens,
               round(avg({B.sql_tokens('clean')}), 6) AS clean_tokens FROM c GROUP BY source""",
    "join_lines": """
        SELECT doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x: x <> ''), ' ') AS joined,
               array_to_string(list_transform(list_filter(string_split(text, chr(10)), lambda x: x <> ''),
                                              lambda x: trim(x)), ' ') AS joined_stripped
        FROM documents""",
    "document_text": DOCUMENT_TEXT,
    "preview": PREVIEW,
    "snippet": """
        SELECT conv_id, turn, CASE WHEN length(text) > 200 THEN left(text, 200) || ' ...' ELSE text END AS snippet
        FROM conversations""",
    "truthy_fallback": f"""
        SELECT doc_id, coalesce(nullif(nullif({_SECOND}, 'the'), ''),
                                nullif({B.sql_without_stopwords(B.sql_clean('source'))}, ''), lang, '') AS chosen
        FROM documents""",
    "json_fields": JSON_FIELDS,
    "metadata_without_nulls": METADATA,
    "colour_badges": """
        SELECT doc_id, CASE WHEN toxic = 1 THEN '🔴' WHEN quality = 1 THEN '🟢' WHEN quality = 0 THEN '🟠'
                            ELSE '⚪' END AS badge
        FROM documents LEFT JOIN labels USING (doc_id)""",
}
