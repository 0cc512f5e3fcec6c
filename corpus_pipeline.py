"""A training corpus from raw documents in five stages.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; ``run`` writes each result
as Parquet and reads it again. All stages but the last return the columns of ``documents``, further ones included.

* ``language_id``: documents whose language is rejected go (no letters, or far from every centroid).
* ``near_duplicates``: of each group of documents linked by five-word shingles at a similarity of 0.8 the one with
  the smallest id stays.
* ``decontamination``: documents that hold a window of a benchmark item go.
* ``mixing``: sources are brought to their target weights; a document may come several times.
* ``sharding``: documents are dealt to 24 shards and shuffled.

Rows without an id are never duplicates. Rows of one id are copies: one stays. Empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import decontaminate, language_id, mixing, ngram_join, sharding
from larder.llm.common import table
from larder.session import staged

SENT_ROWS = 2_000_000  # keys of up to so many rows are sent to the tasks instead of shuffling the texts


def _without(docs: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    keys = staged(keys, "dropped-keys")
    return docs.join(F.broadcast(keys) if keys.count() <= SENT_ROWS else keys, on, "left_anti")


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.fit(docs)
    return language_id.classify(docs, model, name="__language").filter(~F.col("__language.rejected")).drop("__language")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, _ = ngram_join.similarity_groups(docs)
    dropped = rows.filter("id <> component_id").select(F.col("id").alias("doc_id")).distinct()
    kept = _without(docs, dropped, "doc_id").select(*docs.columns)
    if docs.groupBy("doc_id").count().filter("doc_id IS NOT NULL AND count > 1").limit(1).count():
        named = kept.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
        kept = named.unionByName(kept.filter("doc_id IS NULL"))
    return kept


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    summary, _ = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    hit = summary.filter("n_hit > 0").select(F.col("_row").alias("__row")).distinct()
    keyed = docs.withColumn("__row", decontaminate.row_key(F.col("doc_id"), F.col("text")))
    return _without(keyed, hit, "__row").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    whole = docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("__doc"))
    return mixing.emit(mixing.mix(whole)).select("__doc.*")


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard(docs)


STAGES = [
    ("language_id", by_language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixed),
    ("sharding", sharded),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
