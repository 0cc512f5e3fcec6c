from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import knn as N
from larder.operators.embed import embed, hash_embed

VECTORS = "id string, embedding array<float>"


@pytest.fixture(scope="module")
def data(spark):
    """Vectors of which a third are one and the same."""
    g = np.random.default_rng(11)
    matrix = g.normal(size=(900, 12)).astype(np.float32)
    matrix[::3] = matrix[0]
    ids = [f"v{i:04d}" for i in g.permutation(900)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, matrix)], VECTORS).repartition(7).cache()
    queries = np.concatenate([matrix[:40], g.normal(size=(20, 12)).astype(np.float32)])
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "query_id bigint, embedding array<float>")
    a, b = queries.astype(np.float64), matrix.astype(np.float64)
    distance = ((a[:, None] - b[None]) ** 2).sum(axis=2)
    order = [sorted(range(900), key=lambda j: (distance[i, j], ids[j])) for i in range(len(queries))]
    return q, df, [[(ids[j], distance[i, j]) for j in o] for i, o in enumerate(order)]


def check(hits, expected, k):
    rows = hits.orderBy("query_id", "rank").collect()
    assert len(rows) == len(expected) * min(k, 900)
    for r in rows:
        id_, d = expected[r["query_id"]][r["rank"] - 1]
        assert r["id"] == id_ and r["score"] == pytest.approx(d, abs=1e-12)


@pytest.mark.parametrize("k", [1, 5, 1000])
def test_scan(data, k):
    check(N.knn(data[0], data[1], k), data[2], k)


def test_blocks(data):
    check(N.knn(data[0], data[1], 5, max_query_bytes=0), data[2], 5)


def test_hot_cells_are_split(data):
    q = N._named(data[0], "query_id", "embedding", "query_id").withColumn("cell", F.lit("hot"))
    c = N._named(data[1], "id", "embedding", "id").withColumn("cell", F.lit("hot"))
    hits = N.search_cells(q, c, 5, block_rows=16, slice_rows=100)
    check(N.top_per_query(hits, 5), data[2], 5)


def test_partitions_do_not_matter(data):
    assert N.knn(data[0], data[1].repartition(1), 5).exceptAll(N.knn(data[0], data[1], 5)).isEmpty()


def test_approximate_recall_and_count(spark, data):
    got = N.knn_approx(data[0], data[1], 5, seed=3).collect()
    assert len(got) == 5 * len(data[2])
    near = {(i, p) for i, o in enumerate(data[2]) for p, _ in o[:5]}
    assert sum((r["query_id"], r["id"]) in near for r in got) / len(got) > 0.6
    narrow = N.knn_approx(data[0], data[1], 5, bucket_length=0.01, tables=1)
    assert narrow.count() == 5 * len(data[2])


def test_empty_sides(data):
    assert N.knn(data[0].limit(0), data[1], 3).isEmpty()
    assert N.knn(data[0], data[1].limit(0), 3).isEmpty()
    assert N.knn_approx(data[0], data[1].limit(0), 3).isEmpty()


def test_rows_without_vector(spark, data):
    none = spark.createDataFrame([("a", None)], VECTORS)
    for size in (0, 1 << 20):
        check(N.knn(data[0], data[1].union(none), 5, max_query_bytes=size), data[2], 5)


def test_payload(data):
    named = data[1].withColumn("name", F.upper("id"))
    assert all(r["name"] == r["id"].upper() for r in N.knn(data[0], named, 2, payload=("name",)).collect())


def test_hashing_encoder(spark):
    texts = ["", "onion potato bake", "Potato, ONION bake!", "noodle soup", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for method in ("xxhash64", "md5"):
        v = [np.array(r["embedding"]) for r in hash_embed(df, "t", method=method).orderBy("i").collect()]
        assert not v[0].any() and not v[4].any() and np.allclose(v[1], v[2]) and not np.allclose(v[1], v[3])
        assert all(np.isclose(np.linalg.norm(x), 1.0, atol=1e-6) for x in v[1:4])


def test_own_encoder(spark):
    def encoder():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    df = spark.createDataFrame([("ab",), ("abc",)], "t string")
    assert sorted(r["embedding"] for r in embed(df, "t", encoder).collect()) == [[2.0, 1.0], [3.0, 1.0]]


def test_state_is_k_pairs_per_query_and_exact():
    g = np.random.default_rng(9)
    vectors = np.concatenate([g.normal(size=(9000, 16)), np.tile(g.normal(size=(1, 16)), (4000, 1)), g.normal(size=(500, 16)) * 1e6])
    vectors, queries = vectors[g.permutation(len(vectors))], None
    queries = np.concatenate([vectors[:40], g.normal(size=(30, 16)), np.zeros((1, 16))])
    ids = g.permutation(len(vectors))
    top = N.TopK(queries, 5)
    for start in range(0, len(ids), 3000):
        top.add(ids[start : start + 3000], vectors[start : start + 3000])
        assert top.ids.shape == top.scores.shape == (len(queries), 5)
    for q, found, scores in zip(queries, top.ids, top.scores):
        exact = np.square(vectors - q).sum(1)
        want = np.lexsort((ids, exact))[:5]
        assert found.tolist() == ids[want].tolist() and scores.tolist() == exact[want].tolist()


def test_top_k_with_text_ids_and_numbers_that_are_none():
    vectors = np.array([[0.0, 1.0], [np.nan, 0.0], [3.0, 3.0], [0.0, 1.0], [0.0, 2.0]])
    top = N.TopK(np.array([[0.0, 0.0]]), 2)
    for i, v in zip("ebdac", vectors):
        top.add(np.array([i], object), v[None, :])
    assert top.ids.tolist() == [["a", "e"]]
