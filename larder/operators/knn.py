"""Nearest neighbours of a table of queries in a collection of vectors.

The distance is squared Euclidean, smaller is nearer, ties go to the smaller id. Vector blocks meet in
numpy matrix products inside the tasks, and only the best ``k`` rows per query and block leave them, so
no pair table is ever made.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.session import ship_package, staged

QUERY_BLOCK = 512
CHUNK = 4096  # vectors that meet a block of queries at once
PAIRS = 50_000  # pairs whose distances are computed at once
OUT_ROWS = 50_000


def as_matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows x dimensions matrix of a list column."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), flat.size // max(len(vectors), 1))


def best_rows(queries: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and exact distances of the ``k`` nearest vectors of each query.

    Vectors have to come in id order: equal distances are settled by row number. The matrix product
    only proposes rows; their distances are computed again from differences, and where the proposal
    might have cut through a tie the whole row of distances is looked at.
    """
    n, k = len(vectors), min(k, len(vectors))
    m = min(n, k + 8)
    q2 = (queries * queries).sum(axis=1)[:, None]
    v2 = (vectors * vectors).sum(axis=1)[None, :]
    rough = q2 + v2 - 2.0 * (queries @ vectors.T)
    slack = 1e-9 * (1.0 + q2[:, 0] + v2.max())
    rows = np.argpartition(rough, m - 1, axis=1)[:, :m] if m < n else np.tile(np.arange(n), (len(queries), 1))
    diff = vectors[rows] - queries[:, None, :]
    exact = (diff * diff).sum(axis=2)
    order = np.lexsort((rows, exact), axis=1)[:, :k]
    rows, exact = np.take_along_axis(rows, order, 1), np.take_along_axis(exact, order, 1)
    if m < n:
        close = (rough <= (exact[:, -1] + slack)[:, None]).sum(axis=1) > m
        for i in np.flatnonzero(close):
            tied = np.flatnonzero(rough[i] <= exact[i, -1] + slack[i])
            diff = vectors[tied] - queries[i]
            distance = (diff * diff).sum(axis=1)
            pick = np.argsort(distance, kind="stable")[:k]
            rows[i], exact[i] = tied[pick], distance[pick]
    return rows, exact


def first_copies(vectors: np.ndarray, k: int) -> np.ndarray:
    """Row numbers, in order, without the copies of a vector after its first ``k``: at one distance smaller rows win."""
    rows = np.ascontiguousarray(vectors + 0.0)  # one zero, not two
    _, number, count = np.unique(rows.view(np.dtype((np.void, rows.shape[1] * rows.itemsize))).ravel(), return_inverse=True, return_counts=True)
    if not len(count) or count.max() <= k:
        return np.arange(len(rows))
    order = np.argsort(number, kind="stable")
    place = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
    return np.sort(order[place < k])


def _ranks(ids: np.ndarray) -> np.ndarray:
    """Numbers in the order of the ids."""
    return ids if ids.dtype.kind in "iu" else np.unique(ids, return_inverse=True)[1].reshape(ids.shape)


class TopK:
    """Best ``k`` (distance, id) pairs of each query over the blocks seen so far.

    Once ``k`` are known, matrix products in single precision leave out what is farther than the worst of them by more
    than rounding can explain; the distances of the others are computed from differences.
    """

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        self.ids = self.scores = None
        self.norms = (queries * queries).sum(axis=1)
        self.small = queries.astype(np.float32) if len(queries) and np.abs(queries).max(initial=0.0) < 1e15 else None

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        if not len(self.queries):
            return
        for start in range(0, len(ids), CHUNK):
            self._add(ids[start : start + CHUNK], vectors[start : start + CHUNK])

    def _add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        order = order[first_copies(vectors[order], self.k)]
        ids, vectors = ids[order], vectors[order]
        if self.ids is not None and self.ids.shape[1] == self.k:
            return self._better(ids, vectors)
        found, scores = [], []
        for start in range(0, len(self.queries), QUERY_BLOCK):
            rows, exact = best_rows(self.queries[start : start + QUERY_BLOCK], vectors, self.k)
            found.append(ids[rows])
            scores.append(exact)
        found, scores = np.concatenate(found), np.concatenate(scores)
        if self.ids is not None:
            found, scores = np.concatenate([self.ids, found], axis=1), np.concatenate([self.scores, scores], axis=1)
            order = np.lexsort((_ranks(found), scores), axis=1)[:, : self.k]
            found, scores = np.take_along_axis(found, order, 1), np.take_along_axis(scores, order, 1)
        self.ids, self.scores = found, scores

    def _better(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Replace pairs by nearer ones among more vectors."""
        v2 = (vectors * vectors).sum(axis=1)
        plain = self.small is not None and np.abs(vectors).max(initial=0.0) < 1e15
        q, v = (self.small, vectors.astype(np.float32)) if plain else (self.queries, vectors)
        slack = (4 * vectors.shape[1] + 32) * np.finfo(v.dtype).eps * (self.norms + v2.max()) + 1e-30
        for start in range(0, len(q), QUERY_BLOCK):
            stop = start + QUERY_BLOCK
            # Not farther than the worst so far: 2qv >= q2 + v2 - worst - slack; numbers that are none stay in.
            least = (self.norms[start:stop] - self.scores[start:stop, -1] - slack[start:stop]) / 2
            product = q[start:stop] @ v.T
            product -= (v2 / 2).astype(v.dtype)[None, :]
            a, b = np.nonzero(~(product < least.astype(v.dtype)[:, None]))
            if not len(a):
                continue
            exact = np.empty(len(a))
            for x in range(0, len(a), PAIRS):
                diff = vectors[b[x : x + PAIRS]] - self.queries[start + a[x : x + PAIRS]]
                exact[x : x + PAIRS] = (diff * diff).sum(axis=1)
            near = ~(exact > self.scores[start + a, -1])
            a, b, exact = a[near], b[near], exact[near]
            who = np.unique(a)
            query = np.concatenate([np.repeat(who, self.k), a])
            some = np.concatenate([self.ids[start + who].ravel(), ids[b]])
            score = np.concatenate([self.scores[start + who].ravel(), exact])
            order = np.lexsort((_ranks(some), score, query))
            edge = np.searchsorted(query[order], who)
            pick = order[(edge[:, None] + np.arange(self.k)[None, :])]
            self.ids[start + who], self.scores[start + who] = some[pick], score[pick]

    def frame(self, query_ids: np.ndarray) -> pd.DataFrame:
        if self.ids is None or not len(query_ids):
            return pd.DataFrame({"query_id": query_ids[:0], "id": [], "score": []})
        ids, scores = self.ids, self.scores
        return pd.DataFrame(
            {
                "query_id": np.repeat(query_ids, ids.shape[1]),
                "id": ids.ravel(),
                "score": scores.ravel(),
            }
        )

    def batches(self, query_ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The rows of ``frame`` in batches of bounded size."""
        if self.ids is None or not len(query_ids):
            return
        ids, scores = self.ids, self.scores
        step = max(1, OUT_ROWS // max(ids.shape[1], 1))
        for a in range(0, len(query_ids), step):
            part = {
                "query_id": np.repeat(query_ids[a : a + step], ids.shape[1]),
                "id": ids[a : a + step].ravel(),
                "score": scores[a : a + step].ravel(),
            }
            yield pa.RecordBatch.from_pandas(pd.DataFrame(part), preserve_index=False)


def _hit_schema(queries: DataFrame, collection: DataFrame) -> str:
    kinds = dict(queries.dtypes)["query_id"], dict(collection.dtypes)["id"]
    return f"query_id {kinds[0]}, id {kinds[1]}, score double"


def top_per_query(hits: DataFrame, k: int) -> DataFrame:
    """Rank hits within their query by distance, then id, and keep the first ``k``."""
    window = Window.partitionBy("query_id").orderBy("score", "id")
    ranked = hits.withColumn("rank", F.row_number().over(window))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def gathered(batches: Iterator[pa.RecordBatch], rows: int = CHUNK) -> Iterator[pa.Table]:
    """The rows of small batches in tables of at least ``rows``, the last one apart."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def _scan_with_queries(queries: DataFrame, collection: DataFrame, k: int) -> DataFrame:
    """One pass over the collection with the (size-checked) queries sent to every task."""
    table = with_vector(queries.toArrow())
    query_ids = table.column("query_id").to_numpy()
    sent = queries.sparkSession.sparkContext.broadcast((query_ids, as_matrix(table.column("vector"))))
    schema = _hit_schema(queries, collection)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix = sent.value
        top = TopK(matrix, k)
        for batch in gathered(map(with_vector, batches)):
            top.add(batch.column("id").to_numpy(), as_matrix(batch.column("vector")))
        yield from top.batches(ids)

    return collection.mapInArrow(search, schema)


def search_cells(
    queries: DataFrame, collection: DataFrame, k: int, block_rows: int = 20_000, slice_rows: int = 200_000
) -> DataFrame:
    """Best ``k`` rows per query, block and slice among vectors that share the query's ``cell``.

    A cell with many queries is split into blocks and one with many vectors into slices; every block
    meets every slice of its cell, each in a task of bounded size.
    """
    q_sizes = queries.groupBy("cell").agg(F.count(F.lit(1)).alias("q"))
    c_sizes = collection.groupBy("cell").agg(F.count(F.lit(1)).alias("c"))
    plan = q_sizes.join(c_sizes, "cell").select(
        "cell",
        F.ceil(F.col("q") / F.lit(block_rows)).cast("int").alias("blocks"),
        F.ceil(F.col("c") / F.lit(slice_rows)).cast("int").alias("slices"),
    )

    def spread(df: DataFrame, key: str, own: str, parts: str, other: str, others: str) -> DataFrame:
        return df.join(plan, "cell").select(
            "cell",
            key,
            "vector",
            F.pmod(F.xxhash64(key), F.col(parts)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.col(others) - 1)).alias(other),
        )

    left = spread(queries, "query_id", "block", "blocks", "slice", "slices")
    right = spread(collection, "id", "slice", "slices", "block", "blocks")
    return _meet(left, right, ("cell", "block", "slice"), k)


def search_blocks(queries: DataFrame, collection: DataFrame, k: int, blocks: int, slices: int) -> DataFrame:
    """Best ``k`` rows per query and slice: each of ``blocks`` query blocks meets each of ``slices`` slices."""

    def spread(df: DataFrame, key: str, own: str, parts: int, other: str, others: int) -> DataFrame:
        part = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int").alias(own)
        return df.select(key, "vector", part, F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other))

    left = spread(queries, "query_id", "block", blocks, "slice", slices)
    right = spread(collection, "id", "slice", slices, "block", blocks)
    return _meet(left, right, ("block", "slice"), k)


def _meet(left: DataFrame, right: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """Search of the collection rows by the query rows that share the keys."""
    schema = _hit_schema(left, right)

    def search(q: pa.Table, c: pa.Table) -> pa.Table:
        q, c = with_vector(q), with_vector(c)
        columns = {"query_id": q.column("query_id"), "id": c.column("id")}
        if not len(q) or not len(c):
            empty = {n: x.slice(0, 0) for n, x in columns.items()}
            return pa.table({**empty, "score": pa.array([], pa.float64())})
        top = TopK(as_matrix(q.column("vector")), k)
        ids, vectors = c.column("id").to_numpy(), c.column("vector").combine_chunks()
        for start in range(0, len(ids), CHUNK):
            top.add(ids[start : start + CHUNK], as_matrix(vectors.slice(start, CHUNK)))
        return pa.Table.from_pandas(top.frame(q.column("query_id").to_numpy()), preserve_index=False)

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, schema)


def _named(df: DataFrame, id_col: str, vec_col: str, name: str) -> DataFrame:
    """Id and vector; rows without a vector are dropped inside the tasks.

    A filter here would be pushed below a vector that a Python function makes and compute it twice.
    """
    return df.select(F.col(id_col).alias(name), F.col(vec_col).alias("vector"))


def with_vector(rows):
    """Arrow rows whose vector is not null."""
    return rows.filter(pc.is_valid(rows.column("vector")))


def with_payload(hits: DataFrame, collection: DataFrame, id_col: str, payload: Sequence[str]) -> DataFrame:
    """Attach payload columns of the collection to hits by id."""
    if not payload:
        return hits
    return hits.join(collection.select(F.col(id_col).alias("id"), *payload), "id").select(
        "query_id", "rank", "id", "score", *payload
    )


def knn(
    queries: DataFrame,
    collection: DataFrame,
    k: int,
    query_id: str = "query_id",
    query_vec: str = "embedding",
    id_col: str = "id",
    vec_col: str = "embedding",
    payload: Sequence[str] = (),
    max_query_bytes: int = 64 << 20,
    block_bytes: int = 32 << 20,
) -> DataFrame:
    """Exact nearest neighbours: ``query_id, rank, id, score`` plus payload columns.

    The size of the queries is measured. Up to ``max_query_bytes`` they go to every task and the
    collection is read once without a shuffle; beyond that both sides are cut into blocks of about
    ``block_bytes`` that meet in cogrouped tasks. The size counts the ``k`` hits a task keeps per query.
    """
    ship_package(queries.sparkSession)
    q = _named(queries, query_id, query_vec, "query_id")
    c = _named(collection, id_col, vec_col, "id")
    size = q.agg(F.count("vector").alias("n"), F.max(F.size("vector")).alias("d")).first()
    width = 8 * (size["d"] or 0) + 64
    if size["n"] * (width + 32 * k) <= max_query_bytes:
        hits = _scan_with_queries(q, c, k)
    else:
        blocks = max(1, math.ceil(size["n"] * (width + 32 * k) / block_bytes))
        slices = max(1, math.ceil(collection.count() * width / block_bytes))
        hits = search_blocks(q, c, k, blocks, slices)
    return with_payload(top_per_query(hits, k), collection, id_col, payload)


def projection_cells(vector: Column | str, dim: int, tables: int, width: float, seed: int) -> Column:
    """Cell of a vector in each hash table: sign-and-width buckets of ``tables`` groups of projections."""
    generator = np.random.default_rng(seed)
    planes = generator.normal(size=(tables, 2, dim))
    shifts = generator.uniform(0.0, width, size=(tables, 2))

    @F.arrow_udf("array<string>")
    def cells(vectors: pa.Array) -> pa.Array:
        matrix = as_matrix(vectors)
        places = np.floor((np.einsum("nd,tpd->ntp", matrix, planes) + shifts) / width).astype(np.int64)
        return pa.array([[f"{t}:{a}:{b}" for t, (a, b) in enumerate(row)] for row in places])

    return cells(vector)


def knn_approx(
    queries: DataFrame,
    collection: DataFrame,
    k: int,
    bucket_length: float = 2.0,
    tables: int = 10,
    seed: int = 17,
    query_id: str = "query_id",
    query_vec: str = "embedding",
    id_col: str = "id",
    vec_col: str = "embedding",
    payload: Sequence[str] = (),
) -> DataFrame:
    """Approximate nearest neighbours from random-projection cells.

    A query meets only the vectors that share a cell with it in one of the tables; nothing is capped
    within a cell. A query that finds fewer than ``k`` vectors this way is searched exactly.
    """
    ship_package(queries.sparkSession)
    q = _named(queries, query_id, query_vec, "query_id")
    c = _named(collection, id_col, vec_col, "id")
    first = c.filter("vector IS NOT NULL").select(F.size("vector").alias("d")).first()
    if first is None:
        return knn(queries, collection, k, query_id, query_vec, id_col, vec_col, payload)

    def in_cells(df: DataFrame, key: str) -> DataFrame:
        cells = projection_cells("vector", first["d"], tables, bucket_length, seed)
        return df.filter("vector IS NOT NULL").select(key, "vector", F.explode(cells).alias("cell"))

    hits = search_cells(in_cells(q, "query_id"), in_cells(c, "id"), k)
    found = hits.groupBy("query_id", "id").agg(F.min("score").alias("score"))
    near = staged(top_per_query(found, k), "near")
    full = near.filter(F.col("rank") == k).select("query_id")
    short = q.join(full, "query_id", "left_anti")
    exact = knn(short, c, k, "query_id", "vector", "id", "vector")
    both = near.join(full, "query_id", "left_semi").unionByName(exact)
    return with_payload(both, collection, id_col, payload)
