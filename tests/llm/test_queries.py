"""Registered queries against their SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from larder.llm import catalog
from tests import oracle


@pytest.fixture(scope="module")
def con(folder):
    return oracle.connect(folder)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_matches_sql(spark, con, folder, name):
    ok, note = oracle.compare(spark, con, name, folder)
    assert ok, note


def test_all_are_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))


def test_pipeline_keeps_clean_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    import corpus_pipeline

    kept = docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, folder)
    assert 0.8 * docs.count() < kept.count() < docs.count()
