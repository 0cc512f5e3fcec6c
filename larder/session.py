"""Session helpers."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taking it from ``spark.checkpoint.dir``.

    A folder of our own is made only in local mode: on a cluster a machine-local folder would be
    lost with its executor, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        path = tempfile.mkdtemp(prefix="larder-checkpoint-")
    sc.setCheckpointDir(path)
    return path


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and return the stored rows."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet table next to the checkpoints and read it back.

    Unlike a checkpoint the table is columnar: readers that need only the small columns do not touch
    the large ones.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staging_path(spark: SparkSession, name: str) -> str:
    """New path for an intermediate table, next to the checkpoints."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/staged/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a scan with too few splits out to all cores; a no-op for a large input.

    Meant for costly row-wise work on a table stored as one small file.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() * 2 > cores else df.repartition(cores)


def long_rows(spark: SparkSession | None = None, rows: int = 500) -> None:
    """Ship the package to the Python workers and bound the rows of an Arrow batch, as texts and rasters can be long."""
    session = spark or SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    ship_package(session)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(session.conf.get(name)) <= rows:
        session.conf.set(name, rows)


def many_files(spark: SparkSession, cost: int = 64 << 10) -> None:
    """Let the session read folders of many small files: thousands in a task, and few tasks to look them up.

    By default every file counts as 4 MB more than it has, so that a task takes 32, and up to 10,000 tasks list the files of a batch.
    """
    opened, listers = "spark.sql.files.openCostInBytes", "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    if spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(opened)) > cost:
        spark.conf.set(opened, cost)
    few = 4 * spark.sparkContext.defaultParallelism
    if int(spark.conf.get(listers)) > few:
        spark.conf.set(listers, few)


def ship_package(spark: SparkSession | None = None) -> None:
    """Send this package to the Python workers, once per application.

    Needed where it is neither installed on the executors nor passed with ``--py-files``.
    """
    session = spark or SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    sc = session.sparkContext
    if any(Path(name).name == "larder.zip" for name in sc._python_includes):
        return
    root = Path(__file__).resolve().parent
    folder = Path(tempfile.mkdtemp(prefix="larder-package-"))
    sources = folder / "src"
    shutil.copytree(root, sources / "larder", ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(str(folder / "larder"), "zip", sources))
