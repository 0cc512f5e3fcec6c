"""Nulls, empty and very long texts, repeated rows, empty tables and clashing column names for every operator."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from larder.llm import (
    class_model, decontaminate, fill_middle, language_id, license_scan, line_dedup, mixing, ngram_join, packing, periodic_runs, quality_rules,
    sharding, substring_dedup,
)

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, size string, shard string, copies string, "
    "marks string, _row string, tag string, n_words string, word string, _words string, component_id string"
)
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
TEXTS = [None, "", " \n\t ", "one", "the same text here twice\nthe same text here twice", LONG, LONG, "mit license", "été à la plage\n\n\nété", "!!! 123"]


def documents(spark, texts=tuple(TEXTS)):
    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else f"s{i % 2}", 0) + ("x",) * 11 for i, t in enumerate(texts)]
    rows += [rows[-1], (None, "no id", "en", None, None) + ("y",) * 11] if rows else []
    return spark.createDataFrame(rows, SCHEMA)


def benchmark(spark, rows=((1, "mit license"), (None, "one"), (2, None), (3, ""))):
    return spark.createDataFrame(list(rows), "item_id bigint, text string")


def scored(spark, docs):
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), F.lit(False).alias("flag"), F.col("text").cast("binary").alias("text"))
    model, counts = class_model.train(rows, known=5)
    return class_model.score_texts(rows, model, counts)


OPERATORS = {
    "ngram_join": lambda spark, docs: ngram_join.similarity_groups(docs)[0],
    "substring_dedup": lambda spark, docs: substring_dedup.substring_dedup(docs),
    "decontaminate": lambda spark, docs: decontaminate.decontaminate(docs, benchmark(spark))[0],
    "class_model": scored,
    "language_id": lambda spark, docs: language_id.classify(docs, language_id.fit(docs)),
    "line_dedup": lambda spark, docs: line_dedup.line_dedup(docs),
    "license_scan": lambda spark, docs: license_scan.license_scan(docs),
    "mixing": lambda spark, docs: mixing.mix(docs),
    "quality_rules": lambda spark, docs: quality_rules.quality(docs),
    "sharding": lambda spark, docs: sharding.shard(docs),
    "fill_middle": lambda spark, docs: fill_middle.fill_middle(docs),
    "periodic_runs": lambda spark, docs: periodic_runs.periodic_runs(docs),
    "packing": lambda spark, docs: packing.pack(packing.token_pieces(docs, WORD_BPE)).filter("piece = 0"),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows_keep_one_result_each(spark, name):
    docs = documents(spark)
    assert len(OPERATORS[name](spark, docs).collect()) == docs.count()


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, documents(spark, ())).collect() == []


def test_empty_benchmark(spark):
    summary, matches = decontaminate.decontaminate(documents(spark), benchmark(spark, ()))
    assert matches.count() == 0 and summary.filter("n_hit > 0").count() == 0


def test_defined_results(spark):
    docs = documents(spark)
    groups = {r["id"]: r for r in ngram_join.similarity_groups(docs)[0].collect()}
    assert groups[6]["component_id"] == 5 and groups[0]["n_shingles"] == 0 and groups[None]["component_id"] is None
    cut = {r["id"]: r for r in substring_dedup.substring_dedup(docs).collect()}
    assert cut[6]["n_removed"] == 60_000 and cut[5]["n_removed"] == 60_000 - 977 * 13 and cut[0]["n_words"] == 0 and cut[None]["text"] == "no id"
    hits = {r["id"]: r for r in decontaminate.decontaminate(docs, benchmark(spark))[0].collect()}
    assert hits[7]["n_hit"] == 2 and hits[7]["items"] == ["1"] and hits[3]["n_hit"] == 1 and hits[3]["items"] == []
    lang = {r["doc_id"]: r["language"] for r in language_id.classify(docs, language_id.fit(docs)).collect()}
    assert lang[0]["lang"] == lang[9]["lang"] == "und" and lang[0]["score"] == 0.0 and lang[3]["lang"] == "en"
    assert {r["doc_id"]: r["size"] for r in mixing.mix(docs).collect()}[0] == 0
    assert {r["doc_id"]: r["size"] for r in sharding.shard(docs).collect()}[0] == 8
    filled = {r["id"]: r for r in fill_middle.fill_middle(docs).collect()}
    assert filled[0]["n"] == 0 and filled[0]["form"] == "plain" and filled[0]["output"] == "" and filled[2]["n"] == 1 and filled[5]["n"] == 60_000
    cycles = {r["id"]: r for r in periodic_runs.periodic_runs(docs).collect()}
    assert [tuple(r) for r in cycles[6]["runs"]] == [(0, 60_000, 977 * 13)] and len(cycles[5]["collapsed"].split()) == 977 * 13 and cycles[0]["collapsed"] == ""
    packed = packing.pack(packing.token_pieces(docs, WORD_BPE)).collect()
    assert [(r["length"], r["ids"]) for r in packed if r["id"] == 0] == [(1, [1])] and max(r["length"] for r in packed if r["id"] == 5) == 4096
    lines = {r["id"]: r for r in line_dedup.line_dedup(docs, min_docs=2).collect()}
    assert lines[0]["n_lines"] == 1 and lines[5]["n_dropped"] == 1 and lines[6]["n_dropped"] == 0


def test_rows_of_one_id_with_different_texts(spark):
    texts = ["a b c d e f g h " * 5, "q r s t u v w x " * 5, "a b c d e f g h " * 5]
    docs = spark.createDataFrame([(1, texts[0]), (1, texts[1]), (2, texts[2])], "doc_id bigint, text string")
    assert sorted(r["component_id"] for r in ngram_join.similarity_groups(docs)[0].collect()) == [1, 1, 1]
    cut = sorted((r["id"], r["n_removed"]) for r in substring_dedup.substring_dedup(docs).collect())
    assert cut == [(1, 32), (1, 32), (2, 40)]


def test_pipeline_stages_keep_columns(spark, folder):
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns, name
    out = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {"doc_id", "text", "shard", "slot"} <= set(out.columns)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents(spark, ()), folder).count() == 0
