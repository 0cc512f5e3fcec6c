"""Sets of ids that add up across runs, and the keys of each id.

Ids are numbered once, in the order of their arrival in the set; a run leaves one bitmap per 32,768 numbers and its pairs of id and key. The
distinct ids of any runs together are the bits of the joined bitmaps: exact, without reading ids, and much smaller than these. A run that is
repeated replaces what it left before. One run at a time may add to a set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators.ranking import group_rank, keys_per_id
from larder.session import staged

NUMBERS = "id string, n bigint"


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def _number(ids: DataFrame, path: str) -> DataFrame:
    """Numbers of all ids of the set, the new ones being numbered on."""
    spark = ids.sparkSession
    known = _stored(spark, f"{path}/numbers", NUMBERS)
    new = ids.join(known, "id", "left_anti").repartitionByRange("id").withColumn("_chunk", F.spark_partition_id()).withColumn("_all", F.lit(0))
    ranked = group_rank(staged(new, "new-ids"), ["_all"], ["id"], "_r", chunk=["_chunk"])
    last = known.agg(F.max("n")).first()[0]
    ranked.select("id", (F.col("_r") + (last or 0)).alias("n")).write.mode("append").parquet(f"{path}/numbers")
    return spark.read.schema(NUMBERS).parquet(f"{path}/numbers")


def add_ids(pairs: DataFrame, path: str, run: str) -> int:
    """Add the ids of ``pairs (id, key)`` to the set under ``path`` as a run; returns the distinct ids of all runs."""
    spark = pairs.sparkSession
    pairs = staged(pairs.select(F.col("id").cast("string").alias("id"), "key").filter("id IS NOT NULL").distinct(), "id-keys")
    numbers = _number(pairs.select("id").distinct(), path)
    bits = pairs.select("id").distinct().join(numbers, "id")
    sets = bits.groupBy(F.bitmap_bucket_number("n").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits"))
    for name, rows in (("keys", pairs), ("sets", sets)):
        rows.write.mode("overwrite").parquet(f"{path}/{name}/run={run}")
    return count_ids(spark, path).first()["ids"]


def _runs(spark: SparkSession, path: str, runs: Sequence[str] | None) -> DataFrame:
    rows = spark.read.parquet(path)
    return rows if runs is None else rows.filter(F.col("run").cast("string").isin(*runs))


def count_ids(spark: SparkSession, path: str, runs: Sequence[str] | None = None) -> DataFrame:
    """One row: the distinct ``ids`` of some runs together, of all by default."""
    joined = _runs(spark, f"{path}/sets", runs).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return joined.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("ids"))


def keys_of_ids(spark: SparkSession, path: str, runs: Sequence[str] | None = None) -> DataFrame:
    """Sorted distinct keys of each id, ``id, part, keys``, in parts of bounded length."""
    return keys_per_id(_runs(spark, f"{path}/keys", runs).select("id", "key").distinct())
