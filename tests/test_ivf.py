"""The stored vector index against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import ivf


def frame(spark, ids, vectors, name="id"):
    return spark.createDataFrame([(int(i), None if v is None else [float(x) for x in v]) for i, v in zip(ids, vectors)], f"{name} bigint, embedding array<float>")


def brute(queries, vectors, k):
    out = {}
    for i, q in enumerate(queries):
        score = np.square(vectors.astype(np.float32).astype(float) - q.astype(np.float32).astype(float)).sum(1)
        out[i] = [int(j) for j in np.lexsort((np.arange(len(vectors)), score))[:k]]
    return out


def ranked(hits):
    out = {}
    for r in sorted(hits.collect(), key=lambda r: r["rank"]):
        out.setdefault(r["query_id"], []).append(r["id"])
    return out


@pytest.fixture(scope="module")
def data():
    g = np.random.default_rng(5)
    centres = g.normal(size=(12, 8)) * 6
    vectors = np.concatenate([c + g.normal(size=(40, 8)) for c in centres] + [np.tile(centres[0], (150, 1))])  # a third is one vector
    return vectors, np.concatenate([vectors[::17], g.normal(size=(20, 8)) * 6])


@pytest.fixture(scope="module")
def index(spark, data, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "i")
    rows = frame(spark, range(len(data[0])), data[0]).union(frame(spark, [9999], [None]))
    return path, ivf.build_index(rows, path, lists=12, rounds=5)


def test_bytes_bound_the_distance():
    residuals = np.random.default_rng(1).normal(size=(200, 16)) * 10.0 ** np.random.default_rng(2).integers(-6, 6, (200, 1))
    codes, step, missed = ivf.compress(np.concatenate([residuals, np.zeros((1, 16))]))
    again = codes * step[:, None]
    assert (np.sqrt(np.square(again[:-1] - residuals).sum(1)) <= missed[:-1]).all() and not again[-1].any()


@pytest.mark.parametrize("k", [1, 7, 200])
def test_all_lists_give_the_exact_result(spark, data, index, k):
    vectors, queries = data
    path, lists = index
    asked = frame(spark, range(len(queries)), queries, "query_id").union(frame(spark, [777], [None], "query_id"))
    assert ranked(ivf.search_index(spark, path, asked, k, lists)) == brute(queries, vectors, k)


def test_blocks_of_queries_and_more_neighbours_than_rows(spark, data, index):
    vectors, queries = data
    path, lists = index
    asked = frame(spark, range(6), queries[:6], "query_id")
    assert ranked(ivf.search_index(spark, path, asked, 3, lists, max_query_bytes=300)) == brute(queries[:6], vectors, 3)
    every = ranked(ivf.search_index(spark, path, asked, 1000, 2))  # too few in two lists: all are searched
    assert every == brute(queries[:6], vectors, 1000)
    assert ivf.search_index(spark, path, asked.filter("false"), 3, 2).count() == 0


def test_few_probes_find_most(spark, data, index):
    vectors, queries = data
    path, _ = index
    near = queries[: len(vectors[::17])]
    got, want = ranked(ivf.search_index(spark, path, frame(spark, range(len(near)), near, "query_id"), 5, 3)), brute(near, vectors, 5)
    assert sum(len(set(got[i]) & set(want[i])) for i in want) >= 0.9 * 5 * len(want)


def test_only_probed_lists_and_bytes_are_read(spark, index):
    path, _ = index
    lists = spark.read.parquet(f"{path}/lists").filter(F.col("list").isin([1, 3])).select("id", "list", "code", "step", "missed")
    plan = lists._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [list#" in plan and "vector" not in plan.split("ReadSchema:")[1]


def test_empty_and_single(spark, tmp_path):
    rows = frame(spark, [5], [[1, 2]])
    assert ivf.build_index(rows, str(tmp_path / "a")) == 1
    assert ranked(ivf.search_index(spark, str(tmp_path / "a"), rows.toDF("query_id", "embedding"), 3)) == {5: [5]}


def test_few_candidates_leave_a_task_that_sees_the_nearest_last():
    import pyarrow as pa

    class Sent:
        value = (np.arange(50), np.random.default_rng(3).normal(size=(50, 8)), np.ones((50, 1), bool))

    g = np.random.default_rng(4)
    vectors = g.normal(size=(4000, 8))
    vectors = vectors[np.argsort(-np.square(vectors).sum(1))] * np.linspace(9, 1, 4000)[:, None]
    codes, step, missed = ivf.compress(vectors)
    names = ["id", "list", "code", "step", "missed"]
    rows = pa.RecordBatch.from_arrays([pa.array(np.arange(4000)), pa.array(np.zeros(4000, np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(step), pa.array(missed)], names=names)
    found = list(ivf._candidates(Sent, np.zeros((1, 8)), 5)(rows.slice(x, 100) for x in range(0, 4000, 100)))
    got = set(zip(np.concatenate([np.asarray(b.column("query_id")) for b in found]).tolist(), np.concatenate([np.asarray(b.column("id")) for b in found]).tolist()))
    want = {(i, int(j)) for i, q in enumerate(Sent.value[1]) for j in np.argsort(np.square(vectors - q).sum(1))[:5]}
    assert want <= got and len(got) <= 3 * len(want)


def test_every_stored_vector_is_a_query(spark, tmp_path):
    from larder.catalog import retrieval as C

    vectors = np.random.default_rng(9).normal(size=(130, 4))
    rows = [(i + 1, [float(x) for x in v], i % 10) for i, v in enumerate(vectors)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    want = {i + 1: [j + 1 for j in found] for i, found in brute(vectors.astype(np.float32), vectors.astype(np.float32), 5).items()}
    assert ranked(C.knn_index(spark, str(tmp_path))) == want
    assert tuple(C.knn_index_recall(spark, str(tmp_path)).first()) == (130, 650, True)
