"""One object per row under its computed key, written as a whole or not at all.

Tasks stage their objects under names of their own attempt and return one manifest row for each; the manifest is a Parquet table, so
Spark's commit leaves the rows of the successful attempts only. A second job moves what the manifest names to the final keys, which may be
repeated. What lost or failed attempts left goes with the staging folder. The driver sees counts, never keys; folders are listed by tasks, too.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from functools import reduce
from posixpath import dirname, join

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.session import many_files, ship_package, staged, staging_path

MANIFEST = "key string, staged string, bytes bigint"
LISTED = "key string, length bigint"
STORED = f"{LISTED}, content binary"
LISTED_ROWS = 10_000  # names in a batch
READ_ROWS, READ_BYTES = 500, 8 << 20  # objects in a batch
TASK_OBJECTS = 20_000  # objects that a task reads


def _files(path: str):
    """File system and root of a path or URI; Spark writes local URIs with one slash."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return (fs.LocalFileSystem(), path) if "://" not in path else fs.FileSystem.from_uri(path)


def _stage(path: str, run: str, overwrite: bool = True):
    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, root = _files(path)
        task = TaskContext.get()
        folder = f"_staged/{run}/{task.partitionId()}-{task.taskAttemptId()}"
        files.create_dir(join(root, folder), recursive=True)
        n = 0
        for batch in batches:
            rows = []
            for key, content in zip(batch.column("key").to_pylist(), batch.column("content").to_pylist()):
                if not key or key.startswith("/") or ".." in key.split("/") or key.split("/")[0] == "_staged":
                    raise ValueError(f"no key for an object: {key!r}")
                if not overwrite and files.get_file_info(join(root, key)).type != fs.FileType.NotFound:
                    continue
                name, n = f"{folder}/{n}", n + 1
                with files.open_output_stream(join(root, name)) as out:
                    out.write(content or b"")
                rows.append((key, name, len(content or b"")))
            keys, names, sizes = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(names, pa.string()), pa.array(sizes, pa.int64())], names=["key", "staged", "bytes"])

    return stage


def _publish(path: str):
    """Move staged objects to their keys; one that was moved by an earlier attempt is left."""

    def publish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, root = _files(path)
        made: set[str] = set()
        for batch in batches:
            for key, name in zip(batch.column("key").to_pylist(), batch.column("staged").to_pylist()):
                source, target = join(root, name), join(root, key)
                if files.get_file_info(source).type == fs.FileType.NotFound:
                    if files.get_file_info(target).type == fs.FileType.NotFound:
                        raise FileNotFoundError(source)
                    continue
                if dirname(target) not in made:
                    files.create_dir(dirname(target), recursive=True)
                    made.add(dirname(target))
                files.move(source, target)
            yield batch.select(["key", "bytes"])

    return publish


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_objects(rows: DataFrame, path: str, overwrite: bool = True, empty_key: str | None = None) -> DataFrame:
    """Write ``rows (key, content)`` as objects under ``path``; returns ``key, bytes`` of those written.

    A key that comes twice, is empty or leaves the folder stops the job before anything is published. ``overwrite=False`` leaves existing objects
    alone. Without rows an empty object is written under ``empty_key``.
    """
    spark = rows.sparkSession
    ship_package(spark)
    run, manifest = uuid.uuid4().hex, staging_path(spark, "object-manifest")
    objects = rows.select(F.col("key").cast("string").alias("key"), F.col("content").cast("binary").alias("content"))
    try:
        objects.mapInArrow(_stage(path, run, overwrite), MANIFEST).write.parquet(manifest)
        listed = spark.read.schema(MANIFEST).parquet(manifest)
        twice = listed.groupBy("key").count().filter("count > 1").first()
        if twice:
            raise ValueError(f"{twice['count']} objects under the key {twice['key']!r}")
        if empty_key is not None and listed.isEmpty():
            empty = spark.createDataFrame([(empty_key, bytearray())], "key string, content binary")
            empty.mapInArrow(_stage(path, run), MANIFEST).write.mode("append").parquet(manifest)
            listed = spark.read.schema(MANIFEST).parquet(manifest)
        listed.mapInArrow(_publish(path), "key string, bytes bigint").write.parquet(f"{manifest}-published")
    finally:
        _remove(spark, f"{path}/_staged/{run}")
    return spark.read.schema("key string, bytes bigint").parquet(f"{manifest}-published")


def remove_objects(keys: DataFrame, path: str) -> int:
    """Delete the objects of ``keys (key)`` under ``path``, in the tasks; returns how many there were."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, root = _files(path)
        for batch in batches:
            there = [k for k in batch.column("key").to_pylist() if files.get_file_info(join(root, k)).type == fs.FileType.File]
            for key in there:
                files.delete_file(join(root, key))
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(there)], pa.int64())})

    ship_package(keys.sparkSession)
    return keys.select("key").mapInArrow(remove, "n bigint").agg(F.sum("n")).first()[0] or 0


def root_of(spark: SparkSession, path: str) -> str | None:
    """A folder with its scheme, as Spark's readers name it; None when there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getFileStatus(folder).getPath().toString().rstrip("/") if files.exists(folder) else None


def opened_in_tasks(root: str) -> bool:
    """Whether tasks can open a folder by themselves; some stores are known to Spark's readers only."""
    try:
        return _files(root) is not None
    except (pa.ArrowException, OSError, ValueError):
        return False


def _hidden(name: str) -> bool:
    """Names that Spark's readers leave out."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _entries(files, folder: str) -> Iterator[tuple[str, int | None]]:
    """Names and lengths, none for a folder, of what is in a folder; a local one is never held as a whole."""
    from pyarrow import fs

    if not isinstance(files, fs.LocalFileSystem):
        for info in files.get_file_info(fs.FileSelector(folder)):
            yield info.base_name, None if info.type == fs.FileType.Directory else info.size
        return
    with os.scandir(folder) as found:
        for entry in found:
            try:
                yield entry.name, None if entry.is_dir() else entry.stat().st_size
            except FileNotFoundError:  # a link to nothing, or gone meanwhile
                continue


def _list(root: str):
    """Files and folders in each of some folders, under their keys."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int | None]]:
        files, top = _files(root)
        for batch in batches:
            for folder in batch.column("key").to_pylist():
                for name, length in _entries(files, join(top, folder)):
                    if not _hidden(name):
                        yield join(folder, name), length

    def listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[str, int | None]] = []

        def sent() -> pa.RecordBatch:
            keys, lengths = zip(*held)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(lengths, pa.int64())], names=["key", "length"])

        for row in rows(batches):
            held.append(row)
            if len(held) == LISTED_ROWS:
                yield sent()
        if held:
            yield sent()

    return listing


def listed_objects(spark: SparkSession, root: str) -> DataFrame:
    """``key, length`` of the objects that are not empty below a folder (``root_of``), as a stored table.

    Folders are listed in the tasks, one level after the other, each folder by one task. Hidden names are left out as by Spark's readers.
    """
    ship_package(spark)
    folders, levels = spark.range(1).select(F.lit("").alias("key")), []
    while True:
        levels.append(staged(folders.mapInArrow(_list(root), LISTED), "listing"))
        inner = levels[-1].filter("length IS NULL").select("key")
        count = inner.count()
        if not count:
            break
        folders = inner.repartition(min(count, 4 * spark.sparkContext.defaultParallelism))
    return reduce(DataFrame.union, levels).filter("length > 0")


def read_objects(listed: DataFrame, root: str, count: int | None = None) -> DataFrame:
    """``key, length, content`` of listed objects (``key``), dealt out to the tasks; ``count`` of them, if known."""
    spark = listed.sparkSession
    skipped = str(spark.conf.get("spark.sql.files.ignoreMissingFiles")).lower() == "true"

    def contents(keys: Iterator[str]) -> Iterator[tuple[str, bytes]]:
        files, top = _files(root)
        for key in keys:
            try:
                with files.open_input_stream(join(top, key), compression=None) as stored:
                    yield key, stored.read()
            except FileNotFoundError:
                if not skipped:
                    raise

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[str, bytes]] = []
        size = 0

        def sent() -> pa.RecordBatch:
            keys, texts = zip(*held)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array(texts, pa.binary())], names=["key", "length", "content"])

        for key, content in contents(key for batch in batches for key in batch.column("key").to_pylist()):
            if held and size + len(content) > READ_BYTES:
                yield sent()
                size = 0
            held.append((key, content))
            size += len(content)
            if len(held) == READ_ROWS:
                yield sent()
                size = 0
        if held:
            yield sent()

    ship_package(spark)
    cores, n = spark.sparkContext.defaultParallelism, listed.count() if count is None else count
    tasks = max(1, min(cores, -(-n // 16)), -(-n // TASK_OBJECTS))
    return listed.select("key").repartition(tasks).mapInArrow(read, STORED)


def stored_objects(spark: SparkSession, path: str) -> DataFrame:
    """``key, length, content`` of the objects under a folder; an absent folder has none, and empty objects are left out.

    Where only Spark's readers can open the store, the driver lists the folder.
    """
    root = root_of(spark, path)
    if root is None:
        return spark.createDataFrame([], STORED)
    if opened_in_tasks(root):
        return read_objects(listed_objects(spark, root), root)
    many_files(spark)
    bare = F.regexp_replace("path", "^file:/+", "file:/")
    key = F.substring(bare, len("file:/" + root[len("file:"):].lstrip("/") if root.startswith("file:") else root) + 2, 2**31 - 1)
    stored = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return stored.select(key.alias("key"), "length", "content").filter(~F.col("key").startswith("_staged/"))
