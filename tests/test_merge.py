from __future__ import annotations

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from larder.operators import merge as M
from larder.operators.ranking import group_rank, keys_per_id

SCHEMA = "id string, tag string, file string, block bigint, pos bigint, j string"


def records(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return df.withColumn("v", F.try_parse_json("j")).drop("j")


def expected(rows, always_tag, skip=("url", "partition")):
    """Brute force: every arrival takes the first name that its id does not have yet."""
    out = {}
    for id_, tag, _, _, _, text in sorted(rows, key=lambda r: r[2:5]):
        if not (id_ or "").strip():
            continue
        names = out.setdefault(id_, {})
        for field, value in json.loads(text).items():
            if field in (*skip, "id"):
                continue
            tagged = f"{field}__from_{tag}"
            options = itertools.chain([] if always_tag else [field], [tagged], (f"{tagged}_{i}" for i in itertools.count(2)))
            names[next(n for n in options if n not in names)] = value
    return out


def merged(spark, rows, always_tag, **options):
    found = {}
    for r in M.tagged_merge(records(spark, rows), always_tag=always_tag, **options).select("id", "part", F.to_json("fields").alias("f")).collect():
        part = json.loads(r["f"])
        assert not set(part) & set(found.get(r["id"], {}))
        found.setdefault(r["id"], {}).update(part)
    return found


@pytest.mark.parametrize("always_tag", [True, False])
def test_first_free_names(spark, always_tag):
    generator = random.Random(5)
    fields = ["x", "title", "x__from_a", "x__from_a_2", "url", "title__from_b_3", "id"]
    tags = ["a", "a_2", "b", "b_3"]
    rows = []
    for n in range(160):
        chosen = generator.sample(fields, 3)
        rows.append((f"r{generator.randrange(9)}", generator.choice(tags), f"f{n % 5}", n % 2, n, json.dumps({f: n for f in chosen})))
    rows.append(("only", "a", "f9", 0, 1, '{"id": "only"}'))
    rows.append(("  ", "a", "f9", 0, 2, '{"x": 1}'))
    assert merged(spark, rows, always_tag) == expected(rows, always_tag)


@pytest.mark.parametrize("seed", range(6))
def test_names_that_look_generated(spark, seed):
    """Queues, claims of their numbers by fields called so, and fields called like those."""
    g = random.Random(seed)
    fields = ["x", "x__from_t_2", "x__from_t_3", "x__from_t_2_2", "x__from_t_1", "x__from_t_02", "y", "y__from_t_4"]
    rows = []
    for n in range(140):
        tag = g.choice(["t", "t_2", "t_3", "t_2_2", "u"])
        rows.append((f"r{g.randrange(5)}", tag, f"f{n // 30}", n // 15 % 2, n, json.dumps({g.choice(fields): n})))
    rows += [("hot", g.choice(["t", "t_2", "t_3", "t_4", "t_9", "t_30"]), "g", n // 20, n, '{"x": 1}') for n in range(90)]
    assert {i: sorted(f) for i, f in merged(spark, rows, True).items()} == {i: sorted(f) for i, f in expected(rows, True).items()}
    assert merged(spark, rows, True) == expected(rows, True)


def test_parts_hold_the_whole_record(spark):
    rows = [("hot", "t", f"f{n // 10:02d}", 0, n, json.dumps({"x": n})) for n in range(50)]
    whole = M.tagged_merge(records(spark, rows), part_width=8)
    assert whole.count() == 7
    assert merged(spark, rows, True, part_width=8) == expected(rows, True)


def test_pick_fields(spark):
    rows = [("1", "t", "f", 0, 0, '{"a": 1, "b": "x"}'), ("2", "t", "f", 0, 1, '{"b": "y"}')]
    long = M.tagged_merge_long(records(spark, rows))
    got = M.pick_fields(long, ["a__from_t", "b__from_t"]).orderBy("id")
    assert [(r[0], str(r[1]), str(r[2])) for r in got.collect()] == [("1", "1", '"x"'), ("2", "None", '"y"')]


def test_group_rank_paths_agree(spark):
    df = spark.range(3000).select((F.col("id") % 3 % 2).alias("k"), F.xxhash64("id").alias("o"))
    plain = group_rank(df, ["k"], ["o"], "n")
    split = group_rank(df, ["k"], ["o"], "n", limit=10)
    assert sorted(plain.collect()) == sorted(split.collect())


def test_keys_per_id_splits_long_lists(spark):
    df = spark.range(100).select(F.lit("hot").alias("id"), F.format_string("k%03d", "id").alias("key"))
    rows = keys_per_id(df.union(df), list_size=30, limit=5).orderBy("part").collect()
    assert [len(r["keys"]) for r in rows] == [30, 30, 30, 10]
    assert [k for r in rows for k in r["keys"]] == [f"k{i:03d}" for i in range(100)]
