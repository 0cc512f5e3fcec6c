"""Positions inside groups that may hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.session import checkpointed, staged, staging_path


def chunk_of(order: Column | str, width: int = 65_536) -> Column:
    """Chunk number of an integer order column: at most ``width`` distinct values fall in one chunk."""
    c = F.col(order) if isinstance(order, str) else order
    return F.floor(c / F.lit(width)).cast("bigint")


def group_rank(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    chunk: Sequence[str] | None = None,
    limit: int = 1_000_000,
) -> DataFrame:
    """Add the 1-based position of each row within its ``keys`` group, ordered by ``order``.

    A plain window would sort a whole group in one task. Here groups are cut into ordered chunks: rows
    are numbered inside their chunk, and the sizes of the earlier chunks of the group are added.
    ``chunk`` names columns that rise with ``order`` and bound the rows of one chunk (an input split,
    ``chunk_of`` of an integer). Without it the largest group is measured first; up to ``limit`` rows a
    window is used, beyond it the chunks are the range partitions of a checkpointed sort.
    """
    if chunk is None:
        largest = df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
        if largest <= limit:
            window = Window.partitionBy(*keys).orderBy(*order)
            return df.withColumn(name, F.row_number().over(window).cast("bigint"))
        ranged = df.repartitionByRange(*keys, *order).withColumn("_chunk", F.spark_partition_id())
        ranked = group_rank(checkpointed(ranged), keys, order, name, chunk=["_chunk"])
        return ranked.drop("_chunk")

    before = Window.partitionBy(*keys).orderBy(*chunk).rowsBetween(Window.unboundedPreceding, -1)
    sizes = df.groupBy(*keys, *chunk).agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_size").over(before), F.lit(0))).select(
        *[F.col(c).alias(f"_o_{c}") for c in (*keys, *chunk)], "_offset"
    )
    local = Window.partitionBy(*keys, *chunk).orderBy(*order)
    rows = df.withColumn("_local", F.row_number().over(local))
    same = [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in (*keys, *chunk)]
    joined = rows.join(offsets, same, "inner")
    return joined.withColumn(name, F.col("_offset") + F.col("_local")).select(*df.columns, name)


def keys_per_id(
    df: DataFrame,
    id_col: str = "id",
    key_col: str = "key",
    chunk: Column | None = None,
    list_size: int = 100_000,
    limit: int = 1_000_000,
) -> DataFrame:
    """Sorted distinct keys of each id as ``(id, part, keys)``.

    A list holds at most ``list_size`` keys; an id with more goes on in part 1, 2, ... in key order, so
    no id has to fit in one row or one task.
    """
    pairs = df.select(F.col(id_col).alias("id"), F.col(key_col).alias("key")).distinct()
    by = None
    if chunk is not None:
        pairs, by = pairs.withColumn("_key_chunk", chunk), ["_key_chunk"]
    ranked = group_rank(pairs, ["id"], ["key"], "n", chunk=by, limit=limit)
    part = F.floor((F.col("n") - 1) / F.lit(list_size)).cast("bigint")
    return (
        ranked.withColumn("part", part)
        .groupBy("id", "part")
        .agg(F.sort_array(F.collect_list("key")).alias("keys"))
    )


def weighted_cut(rows: DataFrame, order: str, weight: Column, cap: int, width: int = 1_000_000):
    """Smallest ``order`` value up to which the weights add up to ``cap`` or more; None when they never do.

    Weights are summed per value and stored in ordered ranges of about ``width`` values. The sums of the ranges tell in which one the
    cap is reached, and only that range is read again.
    """
    spark = rows.sparkSession
    sums = staged(rows.groupBy(order).agg(F.sum(weight).alias("_w")).filter(F.col(order).isNotNull()), "order-weights")
    ranges = max(1, -(-sums.count() // width))
    path = staging_path(spark, "order-ranges")
    sums.repartitionByRange(ranges, order).withColumn("_range", F.spark_partition_id()).write.partitionBy("_range").parquet(path)
    ranged = spark.read.parquet(path)
    before = 0
    for row in ranged.groupBy("_range").agg(F.sum("_w").alias("w")).orderBy("_range").toLocalIterator():
        if before + row["w"] < cap:
            before += row["w"]
            continue
        upto = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        reached = ranged.filter(F.col("_range") == row["_range"]).withColumn("_sum", F.sum("_w").over(upto))
        return reached.filter(F.col("_sum") >= cap - before).agg(F.min(order)).first()[0]
    return None
