"""Mixing sources to target weights by systematic sampling.

Each source's target is its share of all words; a target stops at ``cap`` times the words the source has and
the excess goes to the others by weight. A document's expected copies are target / words of its source. The
expected copies are summed up along the documents of a source in order of size, one random offset per source is
added, and a document is emitted once for every integer the sum crosses. As the sum runs along the sizes, the words taken stay
near the target, also with few long documents.

The prefix sum is taken in two levels: documents are numbered inside cells of (source, size class, hash chunk),
and the sizes of the earlier cells are added. A source with a third of all rows, or a third of all rows of one
size, so falls into many small windows. Only one row per source passes the driver.

Defined results: a null text has no words. The null source is a source, the last in order. Documents without
words may be emitted any number of times up to the cap; they add no words. Repeated rows are documents of
their own. Equal input gives equal output. An empty table gives an empty result. Columns of the input named
like an output column are replaced.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import WORD, count_words, hex_number, table
from larder.session import staged

OUTPUT = ("size", "source_size", "target", "copies")
PLAN = pa.schema([
    ("__mix_source", pa.string()), ("__mix_s", pa.int32()), ("source_size", pa.int64()), ("target", pa.float64()),
    ("__mix_rate", pa.float64()), ("__mix_u", pa.float64()),
])


def targets(sizes: list[tuple[str | None, int]], weights: tuple[int, ...], cap: int) -> list[tuple[float, float]]:
    """Target of each ``(source, words)`` in the given order, weights repeating.

    Sources are capped in order of cap / weight: one is capped when its share of what the capped ones
    before it leave is larger than its cap.
    """
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    rest, weight = sum(n for _, n in sizes), sum(w)
    out: list[float] = [0.0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda i: (cap * sizes[i][1] / w[i], i))
    for i in order:
        full = cap * sizes[i][1]
        if full * weight < w[i] * rest:
            out[i] = float(full)
            rest, weight = rest - full, weight - w[i]
        else:
            out[i] = -1.0
    return [out[i] if out[i] >= 0 else w[i] * rest / weight for i in range(len(sizes))]


def size_class(size: Column) -> Column:
    """Class that rises with the size, eight to each power of two."""
    bits = F.length(F.bin(size))
    top = F.call_function("shiftright", size, F.greatest(bits - 4, F.lit(0)))
    return (bits * 16 + top).cast("bigint")


def planned(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """The sources' rows as a local table: its size is known, so it is sent to the documents, and no Python worker has to unpack it."""
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(PLAN.names, r)) for r in rows], schema=PLAN))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (5, 2, 1),
    cap: int = 3,
    seed: int = 17,
    chunks: int = 64,
    chunk_rows: int = 10_000_000,
) -> DataFrame:
    """Columns of ``docs`` plus ``size, source_size, target, copies``; copies is 0 for what is left out.

    ``chunks`` is the least number of hash chunks a size class is cut into; beyond ``chunk_rows`` documents
    it grows with the table.
    """
    spark = docs.sparkSession
    body = docs.select(*[c for c in docs.columns if c.lower() not in OUTPUT])
    sized = body.withColumn("size", count_words(body[text_col])).withColumn("__mix_class", size_class(F.col("size")))
    draw = hex_number(F.lit(seed), body[id_col])
    narrow = sized.select(F.col(source_col).alias("__mix_source"), "size", "__mix_class", draw.alias("__mix_draw"))
    fine = F.pmod(F.col("__mix_draw"), F.lit(chunks * 1024)).alias("__mix_fine")
    counted = staged(narrow.groupBy("__mix_source", "__mix_class", fine).agg(F.count(F.lit(1)).alias("__mix_n"), F.sum("size").alias("__mix_words")), "mixing-cells")

    sums = counted.groupBy("__mix_source").agg(F.sum("__mix_n").alias("n"), F.sum("__mix_words").alias("words")).collect()
    split = chunks * min(1024, 1 + sum(r["n"] for r in sums) // chunk_rows)
    sums = sorted(sums, key=lambda r: (r["__mix_source"] is None, r["__mix_source"] or ""))
    plan = []
    for i, (row, target) in enumerate(zip(sums, targets([(r["__mix_source"], r["words"]) for r in sums], weights, cap))):
        name = f"{seed}:{'' if row['__mix_source'] is None else row['__mix_source']}"
        start = int(hashlib.md5(name.encode()).hexdigest()[:8], 16) / 4294967296.0
        rate = min(float(cap), target / row["words"]) if row["words"] else 0.0
        plan.append((row["__mix_source"], i, row["words"], float(target), rate, start))
    sources = planned(spark, plan)

    chunk = F.pmod(F.col("__mix_fine"), F.lit(split)).alias("__mix_chunk")
    cells = counted.groupBy("__mix_source", "__mix_class", chunk).agg(F.sum("__mix_n").alias("__mix_n"))
    classes = counted.groupBy("__mix_source", "__mix_class").agg(F.sum("__mix_n").alias("__mix_n"))
    earlier = "coalesce(sum(__mix_n) OVER (PARTITION BY {} ORDER BY {} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    classes = classes.select(F.col("__mix_source").alias("__mix_cs"), F.col("__mix_class").alias("__mix_cc"), F.expr(earlier.format("__mix_source", "__mix_class")).alias("__mix_low"))
    cells = cells.withColumn("__mix_inner", F.expr(earlier.format("__mix_source, __mix_class", "__mix_chunk")))
    cells = cells.join(classes, F.col("__mix_source").eqNullSafe(F.col("__mix_cs")) & (F.col("__mix_class") == F.col("__mix_cc")))
    cells = cells.join(sources.withColumnRenamed("__mix_source", "__mix_ps"), F.col("__mix_source").eqNullSafe(F.col("__mix_ps")))
    cells = cells.select(
        F.col("__mix_s"), F.col("__mix_class").alias("__mix_k"), F.col("__mix_chunk").alias("__mix_c"), (F.col("__mix_low") + F.col("__mix_inner")).alias("__mix_offset")
    )

    keyed = sized.withColumn("__mix_chunk", F.pmod(F.pmod(draw, F.lit(chunks * 1024)), F.lit(split)))
    keyed = keyed.join(sources, keyed[source_col].eqNullSafe(sources["__mix_source"])).withColumnRenamed("__mix_s", "__mix_own")
    placed = keyed.join(cells, (F.col("__mix_own") == F.col("__mix_s")) & (F.col("__mix_class") == F.col("__mix_k")) & (F.col("__mix_chunk") == F.col("__mix_c")))
    within = f"row_number() OVER (PARTITION BY __mix_own, __mix_class, __mix_chunk ORDER BY size, `{id_col}`)"
    ranked = placed.withColumn("__mix_rank", (F.col("__mix_offset") + F.expr(within)).cast("double"))
    crossed = F.floor(F.col("__mix_rate") * F.col("__mix_rank") + F.col("__mix_u")) - F.floor(F.col("__mix_rate") * (F.col("__mix_rank") - 1) + F.col("__mix_u"))
    copies = F.least(crossed, F.lit(cap)).cast("int").alias("copies")
    return ranked.select(*body.columns, "size", "source_size", "target", copies)


def emit(mixed: DataFrame) -> DataFrame:
    """The mixed corpus: each document as many times as it has copies, without the planning columns."""
    kept = mixed.filter(F.col("copies") > 0)
    repeated = kept.withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.drop("__mix_copy", *OUTPUT)


def op8_mixing(spark, folder):
    rows = mix(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


QUERIES = {"op8_mixing": op8_mixing}
SQL = {
    "op8_mixing": rf"""
WITH sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM documents),
src AS (SELECT source, count(*) AS n, sum(size)::BIGINT AS words FROM sized GROUP BY source),
weighed AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM src),
run AS (SELECT *, (sum(words) OVER ())::BIGINT - coalesce(sum(3 * words) OVER before, 0)::BIGINT AS rest,
    (sum(w) OVER ())::BIGINT - coalesce(sum(w) OVER before, 0)::BIGINT AS wrest
  FROM weighed WINDOW before AS (ORDER BY 3 * words / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
flagged AS (SELECT *, (3 * words)::HUGEINT * wrest < w::HUGEINT * rest AS capped FROM run),
free AS (SELECT max(rest) AS rest, max(wrest) AS wrest FROM flagged WHERE NOT capped),
plan AS (SELECT source, words, CASE WHEN capped THEN (3 * words)::DOUBLE ELSE (w * free.rest)::DOUBLE / free.wrest::DOUBLE END AS target,
    ('0x' || substr(md5('17:' || coalesce(source, '')), 1, 8))::UBIGINT::DOUBLE / 4294967296.0 AS u FROM flagged, free),
keyed AS (SELECT *, length(bin(size)) * 16 + (size >> greatest(length(bin(size)) - 4, 0)::BIGINT) AS k,
    ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::UBIGINT % 65536 % 64 AS chunk FROM sized),
ranked AS (SELECT doc_id, size, source, (row_number() OVER (PARTITION BY source ORDER BY k, chunk, size, doc_id))::DOUBLE AS r FROM keyed),
rated AS (SELECT ranked.*, words, target, u, CASE WHEN words = 0 THEN 0.0 ELSE least(3.0, target / words::DOUBLE) END AS rate
  FROM ranked JOIN plan ON ranked.source IS NOT DISTINCT FROM plan.source)
SELECT doc_id, size, words AS source_size, target, (size * (floor(rate * r + u) - floor(rate * (r - 1) + u)))::BIGINT AS taken FROM rated"""
}
