"""Incremental landing as a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larder.functions import keys as K
from larder.functions.keys import utc_timestamp
from larder.operators.landing import organise
from larder.session import many_files, staged
from larder.sources.objects import LISTED, listed_objects, opened_in_tasks, read_objects, root_of

SOURCE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def _arrivals(spark: SparkSession, root: str, log: str, batch_files: int) -> DataFrame:
    """Stream of the listed files (``key, length``) of a folder, ``batch_files`` in a batch.

    What is below the folder and not yet in the listings is added to them, a file of the table for each batch. So the paths that were read
    are rows of a table, and the stream remembers the files of that table only.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(log)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    new = listed_objects(spark, root).join(spark.read.schema(LISTED).parquet(log).select("key"), "key", "left_anti")
    new = staged(new.select("key", "length"), "arrivals")
    placed = new.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select("_file", (F.sum("_n").over(Window.orderBy("_file")) - F.col("_n")).alias("_start"))
    number = ((F.col("_start") + F.col("_row")) / F.lit(batch_files)).cast("int")
    placed = placed.join(F.broadcast(starts), "_file").select("key", "length", number.alias("_batch"))
    whole, rest = divmod(new.count(), batch_files)
    # Batches are taken by the age of their files: the one that is not full comes last.
    if whole:
        full = placed.filter(F.col("_batch") < whole).repartitionById(whole, "_batch")
        full.drop("_batch").write.mode("append").parquet(log)
    if rest:
        placed.filter(F.col("_batch") == whole).drop("_batch").coalesce(1).write.mode("append").parquet(log)
    return spark.readStream.schema(LISTED).option("maxFilesPerTrigger", 1).parquet(log)


def _spark_files(spark: SparkSession, source: str, clean: str, archive: str | None, batch_files: int) -> DataFrame:
    """Stream of the files of a folder by Spark's own source."""
    many_files(spark)
    reader = (
        spark.readStream.format("binaryFile")
        .schema(SOURCE_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("cleanSource", clean)
        .option("maxFilesPerTrigger", batch_files)
    )
    if archive:
        reader = reader.option("sourceArchiveDir", archive)
    return reader.load(source)


def land_stream(
    spark: SparkSession,
    source: str,
    checkpoint: str,
    table: str,
    dataset: str,
    clean: str = "off",
    archive: str | None = None,
    batch_files: int = 100_000,
) -> StreamingQuery:
    """Land files not seen before: classify, key and store them, then stop.

    The checkpoint remembers the paths read, and in a state store the name and content hash of each file: a file that is delivered again in
    another folder with the same name and content lands once, also after a restart, and one with a new content lands anew. The state holds 32 bytes
    and the name of every file; set a RocksDB state store for very many. ``clean`` is ``off``, ``archive`` or ``delete``; Spark
    removes a source only after a later batch has been committed. All files are landed, in batches of at most ``batch_files``. Tasks list the source
    into a table in the checkpoint; with ``clean``, and where only Spark's readers can open the store, the driver lists it and keeps the paths.
    """
    root = root_of(spark, source)
    if clean == "off" and root is not None and opened_in_tasks(root):
        listed = _arrivals(spark, root, f"{checkpoint}/listings", batch_files)
        files = read_objects(listed, root, batch_files).withColumn("path", F.concat(F.lit(f"{root}/"), "key"))
    else:
        files = _spark_files(spark, source, clean, archive, batch_files)
    objects = files.select(
        F.col("path").alias("key"), F.lit(None).cast("string").alias("content_type"), "length", "content"
    )
    named = objects.withColumns({"_name": K.file_name("key"), "_hash": F.md5("content")})
    once = named.dropDuplicates(["_name", "_hash"]).drop("_name", "_hash")
    landed = organise(once, source, dataset, utc_timestamp()).filter(F.col("class") != "skip")
    return (
        landed.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .partitionBy("class")
        .trigger(availableNow=True)
        .start(table)
    )
