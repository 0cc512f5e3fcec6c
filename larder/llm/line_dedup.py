"""Removal of lines that many documents share, by range-partitioned line hashes.

Every line of at least ``min_chars`` characters becomes a 128-bit hash of its stripped, A-Z lower-cased text.
The occurrences are range-partitioned by (hash, document) and sorted by position inside, so one frequent line
spreads over as many partitions as its documents need, and each partition is streamed once: it yields one
entry per hash and document. Counting those per hash uses map-side combine. The decision comes back as a
sparse bitmap per document, 64 lines a word, words without a dropped line left out; texts are not shuffled
with the hashes.

Defined results: a null or empty text is one empty line. Rows with one id are one document when documents are
counted, and each keeps its own lines. A null id is an id of its own that sorts before all others. An empty
table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import BLANKS, LOWER, UPPER, lower_az, table
from larder.session import staged

BITMAP = "array<struct<word:bigint,keep:bigint>>"


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_row"))


def line_key(line: Column) -> Column:
    return lower_az(F.btrim(line, F.lit(BLANKS)))


def drop_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """``(_id, _row, n_dropped, keep)`` for the documents that lose lines.

    ``_row`` is the hash of the text and tells rows with the same id apart. ``keep`` is the sparse bitmap:
    bit i of word w says whether line 64 * w + i stays; all lines of a missing word stay.
    """
    lines = _rows(docs, id_col, text_col).select("_id", "_row", F.posexplode(F.split("_text", "\n", -1)).alias("_pos", "_line"))
    keyed = lines.select("_id", "_row", "_pos", line_key(F.col("_line")).alias("_key"))
    hashed = keyed.filter(F.length("_key") >= min_chars).select(F.unhex(F.md5("_key")).alias("_h"), "_id", "_row", "_pos")
    ordered = hashed.repartitionByRange("_h", "_id").sortWithinPartitions("_h", "_id", "_pos")
    by_doc = staged(ordered.groupBy("_h", "_id", "_row").agg(F.collect_set("_pos").alias("_at")), "line-hashes")
    ids = by_doc.groupBy("_h", "_id").agg(F.lit(1).alias("_one"))
    shared = ids.groupBy("_h").agg(F.count("_one").alias("_docs"), F.max("_id").alias("_last"))
    shared = shared.filter((F.col("_docs") >= min_docs)).select("_h", "_last")
    gone = by_doc.join(shared, "_h").filter(~F.col("_id").eqNullSafe(F.col("_last")))
    bits = gone.select("_id", "_row", F.explode("_at").alias("_pos")).select(
        "_id", "_row", F.floor(F.col("_pos") / 64).alias("word"), F.expr("shiftleft(1L, _pos % 64)").alias("_bit")
    )
    words = bits.groupBy("_id", "_row", "word").agg(F.bit_or("_bit").alias("_drop"))
    entry = F.struct("word", F.bitwise_not("_drop").alias("keep"))
    return words.groupBy("_id", "_row").agg(
        F.sum(F.bit_count("_drop")).cast("bigint").alias("n_dropped"), F.array_sort(F.collect_list(entry)).alias("keep")
    )


def kept_text(text: Column, keep: Column) -> Column:
    """The text without the lines whose bit is off."""
    words = F.map_from_entries(keep)
    word = lambda i: F.try_element_at(words, F.floor(i / 64))
    stays = F.filter(F.split(text, "\n", -1), lambda _, i: F.coalesce(F.getbit(word(i), i % 64) == 1, F.lit(True)))
    return F.when(keep.isNull(), text).otherwise(F.array_join(stays, "\n"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``(id, text, n_lines, n_dropped, keep)`` per row; ``kept_text(text, keep)`` is what stays."""
    rows, maps = _rows(docs, id_col, text_col), drop_bitmaps(docs, id_col, text_col, **options)
    maps = maps.withColumnsRenamed({"_id": "_mid", "_row": "_mrow"})
    same = (F.col("_row") == F.col("_mrow")) & F.col("_id").eqNullSafe(F.col("_mid"))
    return rows.join(maps, same, "left").select(
        F.col("_id").alias("id"), F.col("_text").alias("text"),
        F.size(F.split("_text", "\n", -1)).cast("bigint").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"), F.col("keep").cast(BITMAP).alias("keep"),
    )


def op6_line_dedup(spark, folder):
    rows = line_dedup(table(spark, folder, "documents"))
    digest = F.sha2(kept_text(F.col("text"), F.col("keep")), 256)
    return rows.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", digest.alias("kept_sha256"))


QUERIES = {"op6_line_dedup": op6_line_dedup}
SQL = {
    "op6_line_dedup": rf"""
WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM parts),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS k FROM lines),
shared AS (SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT keyed.*, shared.last IS NOT NULL AND doc_id <> shared.last AS gone FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""
}
