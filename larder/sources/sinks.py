"""Writers: merged records, JSON lines, image tables, logs, reports, collections, traces."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from larder.session import ship_package


def sorted_by(df: DataFrame, *columns: str) -> DataFrame:
    """Globally ordered output by range partitions, each sorted on its own."""
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def write_merged(merged: DataFrame, path: str) -> None:
    """Merged records as a parquet table ordered by id."""
    sorted_by(merged, "id", "part").write.mode("overwrite").parquet(path)


def merged_json(merged: DataFrame) -> DataFrame:
    """JSON text per merged row: the id followed by its fields."""
    fields = F.to_json("fields")
    rest = F.when(fields == "{}", F.lit("}")).otherwise(F.concat(F.lit(","), F.substring(fields, 2, 2**31 - 1)))
    head = F.to_json(F.struct("id"))
    line = F.concat(F.left(head, F.length(head) - 1), rest)
    return merged.select("id", "part", line.alias("value"))


def write_merged_jsonl(merged: DataFrame, path: str) -> None:
    """Merged records as JSON lines ordered by id, one per row."""
    sorted_by(merged_json(merged), "id", "part").select("value").write.mode("overwrite").text(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per row; an empty input leaves an empty data set."""
    df.write.mode("overwrite").json(path)


def _bracketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of one partition as one JSON array: commas behind all but the last."""
    held = None
    for batch in batches:
        values = batch.column("value").to_pylist()
        if values:
            yield pa.RecordBatch.from_pydict({"value": ["[" if held is None else f"{held},", *[f"{v}," for v in values[:-1]]]})
            held = values[-1]
    yield pa.RecordBatch.from_pydict({"value": ["[]"] if held is None else [held, "]"]})


def write_json_arrays(rows: DataFrame, path: str) -> None:
    """JSON texts (``value``) as files that are one array each, one element per line; a partition makes a file."""
    ship_package(rows.sparkSession)
    rows.select("value").mapInArrow(_bracketed, "value string").write.mode("overwrite").text(path)


def write_images(images: DataFrame, path: str, overwrite: bool = True) -> None:
    """Normalised rasters as a parquet table ``dst_key, image``."""
    images.write.mode("overwrite" if overwrite else "append").parquet(path)


def write_skip_log(log: DataFrame, path: str) -> None:
    log.write.mode("overwrite").option("header", True).csv(path)


def write_report(report: DataFrame, path: str) -> None:
    """A one-row report as a JSON document; the row itself is written by one task."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_collection(entries: DataFrame, path: str, kind: str | None = None) -> DataFrame:
    """Store vector entries by type and return the stored rows.

    Only the types present in ``entries`` are replaced, so texts and images of a mixed collection are
    written by separate jobs, and a repeated run ends in the same state. ``kind`` names the one type the
    job is about: its earlier entries go also when there is no new one.
    """
    spark = entries.sparkSession
    seen = Observation()
    writer = entries.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("type").parquet(path)
    stored = spark.read.schema(entries.schema).parquet(path)
    if kind is None:
        return stored
    stored = stored.filter(F.col("type") == kind)
    if not seen.get.get("n"):
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/type={kind}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        stored = spark.createDataFrame([], entries.schema)
    return stored


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    """All entries of a collection; columns of either kind may be null."""
    return spark.read.option("mergeSchema", True).parquet(path)


def write_traces(traces: DataFrame, path: str) -> None:
    """Traces as JSON lines; ``s3_key`` names each one."""
    traces.write.mode("append").json(path)
