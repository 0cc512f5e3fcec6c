"""Two-pass external shuffle of documents into shards.

The first pass scatters the rows: the shard follows from the law ``key`` (highest of the seeded hashes of
(id, shard number), so a further shard takes rows only into itself), and inside a shard a seeded hash deals
the rows to buckets of about ``bucket_bytes``, small enough for a task's memory whatever the size of the
table. The second pass loads one bucket at a time, puts it into a fixed order and applies ``shuffle``, Spark's
Fisher-Yates permutation of an array, with a seed. Slots number the rows of a shard without gaps: the sizes of
the earlier buckets plus the place in the shuffled bucket.

Defined results: a null text counts 8 bytes and has the CRC of no bytes, 0. A null id is hashed like any value. Equal
rows are kept, each with a slot of its own. An empty table gives an empty result. Columns of the input named
like an output column are replaced. The shard depends on id and shard count alone; slots repeat for the same
rows, seed and number of shuffle partitions.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import table

OUTPUT = ("size", "shard", "slot", "grown_shard", "law")


def size_of(text: Column) -> Column:
    """Bytes a record takes: its text and an eight-byte header."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("bigint")


def shard_of(key: Column, shards: int, seed: int = 0) -> Column:
    """Shard number by rendezvous hashing."""
    drawn = [F.struct(F.xxhash64(F.lit(seed), key, F.lit(i)).alias("h"), F.lit(i).alias("i")) for i in range(shards)]
    return F.array_max(F.array(*drawn))["i"]


def scatter(docs: DataFrame, shards: int, id_col: str, text_col: str, bucket_bytes: int, seed: int) -> DataFrame:
    """First pass: ``(_shard, _bucket, _order, _doc)`` rows."""
    body = docs.select(*[c for c in docs.columns if c.lower() not in OUTPUT])
    text, key = body[text_col], body[id_col]
    total = body.agg(F.sum(size_of(text))).first()[0] or 0
    buckets = max(1, ceil(total / shards / bucket_bytes))
    order = F.xxhash64(F.lit(seed + 1), key, text)
    doc = F.struct(*[body[c] for c in body.columns])
    return body.select(
        shard_of(key, shards, seed).alias("_shard"), F.pmod(order, F.lit(buckets)).alias("_bucket"),
        order.alias("_order"), size_of(text).alias("_size"), shard_of(key, shards + 1, seed).alias("_grown"), doc.alias("_doc"),
    )


def shard(
    docs: DataFrame,
    shards: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_bytes: int = 4 << 20,
    seed: int = 17,
) -> DataFrame:
    """Columns of ``docs`` plus ``size, law, shard, slot, grown_shard``."""
    rows = scatter(docs, shards, id_col, text_col, bucket_bytes, seed)
    sizes = rows.groupBy("_shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = F.expr("sum(_n) OVER (PARTITION BY _shard ORDER BY _bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    offsets = sizes.select("_shard", "_bucket", F.coalesce(before, F.lit(0)).alias("_offset"))
    record = F.struct("_order", "_size", "_grown", "_doc")
    packed = rows.groupBy("_shard", "_bucket").agg(F.collect_list(record).alias("_rows"))
    fixed = F.array_sort("_rows", lambda a, b: F.when(a["_order"] < b["_order"], -1).when(a["_order"] > b["_order"], 1).otherwise(0))
    mixed = packed.join(offsets, ["_shard", "_bucket"]).withColumn("_rows", F.shuffle(fixed, F.lit(seed)))
    out = mixed.select("_shard", "_offset", F.posexplode("_rows").alias("_pos", "_row"))
    return out.select(
        "_row._doc.*", F.col("_row._size").alias("size"), F.lit("key").alias("law"), F.col("_shard").cast("int").alias("shard"),
        (F.col("_offset") + F.col("_pos")).cast("bigint").alias("slot"), F.col("_row._grown").cast("int").alias("grown_shard"),
    )


def write_shards(sharded: DataFrame, path: str, files: int = 1) -> None:
    """Write one folder per shard, rows in slot order; ``files`` range parts per shard."""
    dealt = sharded.repartitionByRange(max(1, files) * 24, "shard", "slot").sortWithinPartitions("shard", "slot")
    dealt.write.partitionBy("shard").parquet(path)


def op10_sharding(spark, folder):
    rows = shard(table(spark, folder, "documents"))
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return rows.select("doc_id", "size", crc.alias("text_crc32"), "law", "shard", "slot", "grown_shard")


QUERIES = {"op10_sharding": op10_sharding}
SQL: dict[str, str] = {}
