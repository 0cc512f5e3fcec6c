"""Stored vector index: inverted lists around trained centroids, compressed residuals, exact re-ranking.

Centroids come from k-means on a bounded sample; every vector is stored in the list of its nearest one. Lists are partitions of a
table, so a search reads the probed ones only, and of those the compressed column first: each residual as one byte per dimension, with the
distance by which the bytes miss the vector. These give a lower and an upper bound of each distance. A vector whose lower bound is beyond the
k-th smallest upper bound of a query cannot be among its nearest; the vectors of the others are read and compared exactly. So within the probed
lists the result is exact, however coarse the bytes, and probing all lists gives the exact neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.functions import vectors as X
from larder.operators.knn import _named, as_matrix, top_per_query, with_payload, with_vector
from larder.session import ship_package, staged

LEVELS = 127
CELLS = 1 << 20  # distances a task computes at once
HELD = 1_000_000  # pairs a task holds back until its bounds are tight
OUT_ROWS = 50_000


def train_centroids(vectors: DataFrame, lists: int, sample: int = 100_000, rounds: int = 10, seed: int = 17) -> np.ndarray:
    """Centroids of about ``sample`` of the rows (``vector``), drawn by a seed."""
    if lists == 1:
        means = vectors.select(F.posexplode("vector").alias("at", "x")).groupBy("at").agg(F.avg("x").alias("x")).orderBy("at").collect()
        return np.array([[r["x"] for r in means]])
    share = min(1.0, sample / max(1, vectors.count()))
    drawn = vectors if share == 1.0 else vectors.sample(share, seed)
    model = KMeans(k=lists, maxIter=rounds, seed=seed, featuresCol="features").fit(drawn.select(array_to_vector(F.col("vector").cast("array<double>")).alias("features")))
    return np.array(model.clusterCenters())


def nearest_lists(matrix: np.ndarray, centroids: np.ndarray, probes: int) -> np.ndarray:
    """Numbers of the nearest centroids of each row, nearest first."""
    distance = np.square(centroids).sum(1)[None, :] - 2.0 * matrix @ centroids.T
    if probes >= len(centroids):
        return np.argsort(distance, axis=1, kind="stable")
    some = np.argpartition(distance, probes - 1, axis=1)[:, :probes]
    return np.take_along_axis(some, np.argsort(np.take_along_axis(distance, some, 1), axis=1, kind="stable"), 1)


def compress(residuals: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, the step of each row, and an upper bound of the distance between a row and what its bytes say."""
    step = np.maximum(np.abs(residuals).max(1, initial=0.0) / LEVELS, 1e-30)
    codes = np.rint(residuals / step[:, None]).astype(np.int8)
    missed = np.sqrt(np.square(residuals - codes * step[:, None]).sum(1))
    return codes, step, missed * (1 + 1e-9) + 1e-12


def build_index(
    collection: DataFrame,
    path: str,
    lists: int | None = None,
    sample: int = 100_000,
    rounds: int = 10,
    seed: int = 17,
    id_col: str = "id",
    vec_col: str = "embedding",
) -> int:
    """Write the index of a collection; returns the number of lists.

    The lists are as many as the square root of the rows, and at most a sixteenth of ``sample``, the rows the centroids are fitted on. All rows with a
    vector are stored.
    """
    spark = collection.sparkSession
    ship_package(spark)
    rows = _named(collection, id_col, vec_col, "id").filter("vector IS NOT NULL")
    count = rows.count()
    lists = max(1, min(lists or ceil(sqrt(count)), sample // 16 or 1, count))
    centroids = train_centroids(rows, lists, sample, rounds, seed) if count else np.zeros((1, 1))
    sent = spark.sparkContext.broadcast(centroids)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = as_matrix(batch.column("vector"))
            nearest = nearest_lists(matrix, sent.value, 1)[:, 0]
            codes, step, missed = compress(matrix - sent.value[nearest])
            columns = [batch.column("id"), batch.column("vector"), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(step), pa.array(missed), pa.array(nearest, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "vector", "code", "step", "missed", "list"])

    kinds = dict(rows.dtypes)
    placed = rows.mapInArrow(place, f"id {kinds['id']}, vector {kinds['vector']}, code binary, step double, missed double, list int")
    placed.write.mode("overwrite").partitionBy("list").parquet(f"{path}/lists")
    table = [(i, c.tolist()) for i, c in enumerate(centroids)]
    spark.createDataFrame(table, "list int, centroid array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")
    return len(centroids)


def _probed(queries: DataFrame, centroids: np.ndarray, probes: int) -> DataFrame:
    """``(query_id, vector, lists)`` with the lists each query looks into."""
    kinds = dict(queries.dtypes)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = nearest_lists(as_matrix(batch.column("vector")), centroids, probes)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.tolist(), pa.list_(pa.int32()))], names=["query_id", "vector", "lists"])

    return queries.mapInArrow(probe, f"query_id {kinds['query_id']}, vector {kinds['vector']}, lists array<int>")


def _candidates(sent, centroids: np.ndarray, k: int):
    """Vectors that may be among the nearest of a query, with the bounds of their distances.

    What is found waits until the bounds of the whole task are known, as far as ``HELD`` pairs go; beyond that it leaves in parts.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries, looks = sent.value
        by_list = {n: np.flatnonzero(looks[:, n]) for n in np.flatnonzero(looks.any(0)).tolist()}
        uppers = np.full((len(queries), k), np.inf)  # the k smallest upper bounds of each query so far
        norms = np.square(queries).sum(1)
        held: list[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray, np.ndarray]] = []
        count = 0

        def prune() -> None:
            nonlocal held, count
            worst, kept = uppers.max(1), []
            for who, ids, numbers, low, high in held:
                stay = np.flatnonzero(low <= worst[who])
                if len(stay):
                    kept.append((who[stay], ids.take(pa.array(stay)), numbers[stay], low[stay], high[stay]))
            if kept:
                who, ids, numbers, low, high = zip(*kept)
                kept = [(np.concatenate(who), pa.concat_arrays(ids), np.concatenate(numbers), np.concatenate(low), np.concatenate(high))]
            held, count = kept, sum(len(x[0]) for x in kept)

        def send() -> Iterator[pa.RecordBatch]:
            nonlocal held, count
            for who, ids, numbers, low, high in held:
                for x in range(0, len(who), OUT_ROWS):
                    y = x + OUT_ROWS
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(query_ids[who[x:y]]), ids[x:y], pa.array(numbers[x:y]), pa.array(low[x:y]), pa.array(high[x:y])],
                        names=["query_id", "id", "list", "low", "high"],
                    )
            held, count = [], 0

        for batch in batches:
            numbers = np.asarray(batch.column("list"))
            for n in np.unique(numbers).tolist():
                every = by_list.get(n)
                if every is None:
                    continue
                at = np.flatnonzero(numbers == n)
                some = batch.take(pa.array(at))
                codes = np.frombuffer(b"".join(some.column("code").to_pylist()), np.int8).reshape(len(at), -1)
                matrix = centroids[n] + codes * np.asarray(some.column("step"))[:, None]
                missed = np.asarray(some.column("missed"))[None, :]
                squares = np.square(matrix).sum(1)[None, :]
                part = max(1, CELLS // len(at))
                for x in range(0, len(every), part):
                    who = every[x : x + part]
                    square = norms[who][:, None] + squares - 2.0 * queries[who] @ matrix.T
                    distance = np.sqrt(np.maximum(square, 0.0, out=square), out=square)
                    slack = missed + 1e-6 * (1.0 + distance)  # rounding of the matrix product
                    worst = uppers[who].max(1)
                    changed = np.flatnonzero((distance + slack < worst[:, None]).any(1))
                    if len(changed):
                        high = distance[changed] + slack[changed]
                        best = np.concatenate([uppers[who[changed]], np.partition(high, min(k, len(at)) - 1, axis=1)[:, :k]], axis=1)
                        best.partition(k - 1, axis=1)
                        uppers[who[changed]] = best[:, :k]
                        worst[changed] = best[:, :k].max(1)
                    a, b = np.nonzero(np.maximum(distance - slack, 0.0) <= worst[:, None])
                    if len(a):
                        d, s = distance[a, b], slack[a, b]
                        held.append((who[a], some.column("id").take(pa.array(b)), np.full(len(a), n, np.int32), np.maximum(d - s, 0.0), d + s))
                        count += len(a)
                    if count > HELD:
                        prune()
                        if count > HELD // 2:
                            yield from send()
        prune()
        yield from send()

    return search


def search_index(
    spark: SparkSession,
    path: str,
    queries: DataFrame,
    k: int,
    probes: int = 8,
    collection: DataFrame | None = None,
    query_id: str = "query_id",
    query_vec: str = "embedding",
    payload: Sequence[str] = (),
    max_query_bytes: int = 32 << 20,
) -> DataFrame:
    """``query_id, rank, id, score`` of the ``k`` nearest vectors in the ``probes`` nearest lists of each query.

    Exact within these lists, and wholly when ``probes`` is the number of lists. A query that finds fewer than ``k`` looks into all lists. Queries are
    sent to the tasks in blocks of at most ``max_query_bytes``.
    """
    ship_package(spark)
    stored = spark.read.parquet(f"{path}/centroids").orderBy("list").select("centroid").collect()
    centroids = np.array([r["centroid"] for r in stored])
    lists = spark.read.parquet(f"{path}/lists")
    asked = staged(_probed(_named(queries, query_id, query_vec, "query_id").filter("vector IS NOT NULL"), centroids, probes), "probed-queries")
    hits = staged(_search(spark, lists, asked, centroids, k, max_query_bytes), "index-hits")
    if probes < len(centroids):
        short = asked.join(hits.filter(F.col("rank") == k).select("query_id"), "query_id", "left_anti")
        every = F.sequence(F.lit(0), F.lit(len(centroids) - 1))
        more = _search(spark, lists, staged(short.withColumn("lists", every), "short-queries"), centroids, k, max_query_bytes)
        hits = hits.join(short.select("query_id"), "query_id", "left_anti").unionByName(more)
    return hits if collection is None else with_payload(hits, collection, "id", payload)


def _search(spark: SparkSession, lists: DataFrame, asked: DataFrame, centroids: np.ndarray, k: int, max_query_bytes: int) -> DataFrame:
    count = asked.count()
    blocks = max(1, -(-count * (centroids.shape[1] * 8 + len(centroids)) // max_query_bytes))
    kinds = dict(asked.dtypes)["query_id"], dict(lists.dtypes)["id"]
    schema = f"query_id {kinds[0]}, id {kinds[1]}, list int, low double, high double"
    out = spark.createDataFrame([], f"query_id {kinds[0]}, rank int, id {kinds[1]}, score double")
    for block in range(blocks if count else 0):
        some = asked.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block)
        table = with_vector(some.toArrow())
        if not table.num_rows:
            continue
        looks = np.zeros((table.num_rows, len(centroids)), bool)
        for i, numbers in enumerate(table.column("lists").to_pylist()):
            looks[i, numbers] = True
        sent = spark.sparkContext.broadcast((table.column("query_id").to_numpy(), as_matrix(table.column("vector")), looks))
        probed = np.flatnonzero(looks.any(0)).tolist()
        read = lists if len(probed) == len(centroids) else lists.filter(F.col("list").isin(probed))
        found = staged(read.select("id", "list", "code", "step", "missed").mapInArrow(_candidates(sent, centroids, k), schema), "candidates")
        ordered = Window.partitionBy("query_id").orderBy("high", "id")
        limit = found.withColumn("_r", F.row_number().over(ordered)).filter(F.col("_r") <= k).groupBy("query_id").agg(F.max("high").alias("limit"))
        near = found.join(limit, "query_id").filter(F.col("low") <= F.col("limit")).select("query_id", "id", "list")
        exact = near.join(read.select("id", "list", "vector"), ["list", "id"]).join(some.select("query_id", F.col("vector").alias("_q")), "query_id")
        scores = exact.select("query_id", "id", X.l2_sq("vector", "_q").alias("score"))
        out = out.unionByName(top_per_query(scores, k))
    return out
