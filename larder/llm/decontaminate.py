"""Benchmark decontamination: a prefix-filtered set join of item windows with the documents.

A window is ``window`` consecutive words of an item (an item of fewer words is one window). Its tokens are
shingles of ``shingle`` words. A document holds a window only if it holds each of its tokens, so one necessary
token, the prefix, is enough to find all candidates: the one that is rarest in the corpus. The documents are
searched once for the places of all tokens. These occurrences give the exact frequencies that order the tokens;
the prefix tokens are joined with them, a candidate has to pass the length and position bounds (the window starts
at word 0 or later and ends inside the document), and its words are compared one by one with those of the text.

The tokens sent to the tasks are those of the benchmark, in blocks of at most ``block`` hashes: a larger
benchmark takes several passes over the documents. Up to ``sent_candidates`` candidate windows are sent to the texts; more shuffle the texts
once.

Defined results: null texts have no words and no windows. Repeated rows get one result each. Items with one
text are found together. A null item id marks words as hit but adds no item. Empty tables give empty results
or no hits. Further columns of either table are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import LOWER, SEPARATORS, UPPER, lower_az, table
from larder.session import staged

END = -1  # the extra token that gives each document one row


def with_words(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the lower-cased alphanumeric words of a text."""
    split = df.withColumn("_parts", F.split(lower_az(F.coalesce(F.col(text), F.lit(""))), SEPARATORS, -1))
    size = F.size("_parts")
    lead = (F.col("_parts")[0] == "").cast("int")
    tail = ((size > 1) & (F.try_element_at("_parts", F.lit(-1)) == "")).cast("int")
    return split.withColumn(name, F.slice("_parts", lead + 1, size - lead - tail)).drop("_parts")


def token_hashes(hashes: Column, n: Column, width: int) -> Column:
    """Hash of each run of ``width`` words, from the hashes of the words."""
    runs = F.transform(F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(F.lit(width), *[F.get(hashes, i + j) for j in range(width)]))
    return F.when(n >= width, runs).otherwise(F.array().cast("array<bigint>"))


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """``(item, words, key)`` of every window of every item."""
    items = with_words(benchmark.select(F.col(id_col).alias("item"), F.col(text_col).alias("_text")), "_text", "_words")
    items = items.filter(F.size("_words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("_words") - window, F.lit(0)))
    each = items.select("item", "_words", F.explode(starts).alias("_at"))
    cut = each.select("item", F.slice("_words", F.col("_at") + 1, F.lit(window)).alias("words"))
    return cut.withColumn("key", F.md5(F.array_join("words", " ")))


def row_key(key: Column, text: Column) -> Column:
    """Hash of id and text (null: empty) in 128 bits; equal rows share it."""
    text = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(key, text).alias("a"), F.xxhash64(F.lit(1), text, key).alias("b"))


def document_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(_row, _id, _text)``; equal rows share their result."""
    key = row_key(F.col(id_col), F.col(text_col))
    return docs.select(key.alias("_row"), F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))


def occurrences(rows: DataFrame, tokens: DataFrame, widths: list[int], block: int) -> DataFrame:
    """``(_row, _id, _n, _h, _pos)``: one row per document, with the token ``END``, and one per place of a token."""
    split = with_words(rows, "_text", "_words")
    hashed = split.select("_row", "_id", F.size("_words").alias("_n"), F.transform("_words", lambda w: F.xxhash64(w)).alias("_wh"))
    lists = [token_hashes(F.col("_wh"), F.col("_n"), w) for w in widths]
    # The outer form, as the plain one would copy the hashing into a filter below, once per word.
    flat = hashed.select("_row", "_id", "_n", F.concat(*lists, F.array(F.lit(END).cast("bigint"))).alias("_all"))
    flat = flat.select("_row", "_id", "_n", F.posexplode_outer("_all").alias("_k", "_h"))

    blocks = max(1, -(-tokens.count() // block))
    found = None
    for b in range(blocks):
        some = tokens.filter(F.pmod("_t", F.lit(blocks)) == b)
        if b == 0:
            some = some.union(rows.sparkSession.range(1).select(F.lit(END).cast("bigint").alias("_t"))).distinct()
        part = flat.join(F.broadcast(some), F.col("_h") == F.col("_t"))
        found = part if found is None else found.union(part)
    pos, start = F.col("_k"), F.lit(0)
    for w in widths:
        pos = F.when(F.col("_k") >= start, F.col("_k") - start).otherwise(pos)
        start = start + F.greatest(F.col("_n") - w + 1, F.lit(0))
    found = found.withColumn("_end", F.col("_k") == start).filter(F.col("_end") | (F.col("_h") != END))
    return found.select("_row", "_id", "_n", "_h", "_end", pos.alias("_pos"))


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    shingle: int = 5,
    block: int = 2_000_000,
    sent_candidates: int = 200_000,
) -> tuple[DataFrame, DataFrame]:
    """``(summary, matches)``.

    The summary has ``(_row, id, n_words, n_hit, n_items, items)`` for each row of ``docs``, items being the
    sorted ids as strings; matches has ``(_row, id, start, length, key)`` for each place of a window.
    """
    spark = docs.sparkSession
    windows = staged(item_windows(benchmark, item_col, item_text_col, window), "benchmark-windows")
    distinct = windows.groupBy("key").agg(F.first("words").alias("words"))
    width = F.least(F.size("words"), F.lit(shingle)).alias("w")
    widths = sorted(r["w"] for r in distinct.select(width).distinct().collect()) or [shingle]
    own = distinct.withColumn("_n", F.size("words")).withColumn("_wh", F.transform("words", lambda w: F.xxhash64(w)))
    chosen = F.lit(None).cast("array<bigint>")
    for w in widths:
        chosen = F.when(F.least(F.col("_n"), F.lit(shingle)) == w, token_hashes(F.col("_wh"), F.col("_n"), w)).otherwise(chosen)
    parts = own.select("key", "words", F.posexplode_outer(chosen).alias("_o", "_t"))
    tokens = staged(parts, "benchmark-tokens")
    rows = document_rows(docs, id_col, text_col)
    hits = staged(occurrences(rows, tokens.select("_t").distinct(), widths, block), "token-places")

    places = hits.filter(~F.col("_end"))
    rarity = places.groupBy("_h").agg(F.count(F.lit(1)).alias("_f"))
    ordered = tokens.join(rarity, F.col("_t") == F.col("_h"), "left")
    rank = F.struct(F.coalesce("_f", F.lit(0)).alias("f"), F.col("_t").alias("t"), F.col("_o").alias("o"))
    prefix = ordered.groupBy("key").agg(F.min(rank).alias("_p"), F.first("words").alias("words"))
    prefix = prefix.select("key", "words", F.size("words").alias("_len"), F.col("_p.t").alias("_t"), F.col("_p.o").alias("_o"))
    if prefix.count() <= block // 20:
        prefix = F.broadcast(prefix)
    start = F.col("_pos") - F.col("_o")
    inside = (start >= 0) & (start + F.col("_len") <= F.col("_n"))
    found = places.join(prefix, (F.col("_h") == F.col("_t")) & inside).select("_row", start.alias("start"), "key", "words")
    found = staged(found.distinct(), "window-candidates")
    few = found.count() <= sent_candidates
    found = found.groupBy(F.col("_row").alias("_crow")).agg(F.collect_list(F.struct("start", "key", "words")).alias("_found"))
    near = rows.join(F.broadcast(found) if few else found, F.col("_row") == F.col("_crow"))
    same = F.filter("_found", lambda c: F.slice("_words", c["start"] + 1, F.size(c["words"])) == c["words"])
    # The outer form again: a filter on the matches would be copied below the splitting and split the text once per candidate.
    each = with_words(near, "_text", "_words").select("_row", F.col("_id").alias("id"), F.explode_outer(same).alias("m")).filter("m IS NOT NULL")
    matches = staged(each.select("_row", "id", "m.start", F.size("m.words").alias("length"), "m.key"), "window-matches")

    spans = matches.select("_row", "start", "length").distinct()
    covered = spans.select("_row", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("_at")).distinct()
    covered = covered.groupBy("_row").agg(F.count(F.lit(1)).alias("n_hit"))
    items = windows.select("key", F.col("item").cast("string").alias("item")).filter("item is not null").distinct()
    named = matches.select("_row", "key").distinct().join(items, "key").select("_row", "item").distinct()
    named = named.groupBy("_row").agg(F.count(F.lit(1)).alias("n_items"), F.array_sort(F.collect_list("item")).alias("items"))
    summary = hits.filter("_end").join(covered, "_row", "left").join(named, "_row", "left").select(
        "_row", F.col("_id").alias("id"), F.col("_n").cast("bigint").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
    return summary, matches


def op3_decontaminate(spark, folder):
    summary, _ = decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return summary.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


QUERIES = {"op3_decontaminate": op3_decontaminate}
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = {
    "op3_decontaminate": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS l, array_to_string(w[s:s + 9], ' ') AS k FROM iw),
lens AS (SELECT DISTINCT l FROM win),
dp AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS s FROM d),
dw AS (SELECT doc_id, s, l, array_to_string(w[s:s + l - 1], ' ') AS k FROM dp, lens WHERE s + l - 1 <= len(w)),
m AS (SELECT dw.doc_id, dw.s, dw.l, win.item_id FROM dw JOIN win ON dw.l = win.l AND dw.k = win.k),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + l)) AS p FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(it.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)"""
}
