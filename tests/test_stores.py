"""Objects written as a whole, versioned collections, and cuts by running weights."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from larder.operators.ranking import weighted_cut
from larder.plans.landing import land_move
from larder.plans.trusted import dry_run_documents, trust_documents
from larder.sources import idsets, objects, versions
from larder.streaming.landing import land_stream


def files_under(path):
    return sorted(str(p.relative_to(path)) for p in Path(path).rglob("*") if p.is_file())


def object_rows(spark, rows):
    return spark.createDataFrame(rows, "key string, content binary").repartition(3)


def test_objects_are_written_and_read(spark, tmp_path):
    rows = [(f"a b/{i % 4}/é{i}.bin", bytes([i]) * i) for i in range(40)]
    done = objects.write_objects(object_rows(spark, rows), str(tmp_path / "o"))
    assert sorted((r["key"], r["bytes"]) for r in done.collect()) == sorted((k, len(c)) for k, c in rows)
    assert files_under(tmp_path / "o") == sorted(k for k, _ in rows)
    stored = objects.stored_objects(spark, f"file:{tmp_path}/o").collect()
    assert {r["key"]: bytes(r["content"]) for r in stored} == {k: c for k, c in rows if c}
    again = objects.write_objects(object_rows(spark, [("a b/0/é0.bin", b"new"), ("n", b"new")]), str(tmp_path / "o"), overwrite=False)
    assert [r["key"] for r in again.collect()] == ["n"] and (tmp_path / "o" / "a b/0/é0.bin").read_bytes() == b""
    objects.write_objects(object_rows(spark, [("a b/0/é0.bin", b"new")]), str(tmp_path / "o"))
    assert (tmp_path / "o" / "a b/0/é0.bin").read_bytes() == b"new"


@pytest.mark.parametrize("bad", [("", b"x"), (None, b"x"), ("../up", b"x"), ("/top", b"x"), ("_staged/x", b"x"), ("k3", b"twice")])
def test_a_failed_job_leaves_nothing(spark, tmp_path, bad):
    objects.write_objects(object_rows(spark, [("old", b"1")]), str(tmp_path))
    with pytest.raises(Exception):
        objects.write_objects(object_rows(spark, [(f"k{i}", b"x") for i in range(30)] + [("old", b"2"), bad]), str(tmp_path))
    assert files_under(tmp_path) == ["old"] and (tmp_path / "old").read_bytes() == b"1"


def test_a_lost_attempt_leaves_nothing(spark, tmp_path):
    """Objects staged by an attempt that is not in the manifest go with the staging folder; a repeated move is none."""
    run = objects._stage(str(tmp_path), "run")
    rows = object_rows(spark, [(f"k{i}", b"x") for i in range(9)])
    lost = rows.mapInArrow(run, objects.MANIFEST).collect()
    kept = rows.mapInArrow(run, objects.MANIFEST).collect()
    assert {r["staged"] for r in lost}.isdisjoint(r["staged"] for r in kept)
    manifest = spark.createDataFrame(kept, objects.MANIFEST)
    for _ in range(2):
        manifest.mapInArrow(objects._publish(str(tmp_path)), "key string, bytes bigint").collect()
    objects._remove(spark, f"{tmp_path}/_staged/run")
    assert files_under(tmp_path) == [f"k{i}" for i in range(9)]


def test_an_empty_object_when_nothing_is_kept(spark, tmp_path):
    none = object_rows(spark, [("a", b"x")]).filter("false")
    assert objects.write_objects(none, str(tmp_path / "o")).count() == 0
    assert [tuple(r) for r in objects.write_objects(none, str(tmp_path / "o"), empty_key="all.jsonl").collect()] == [("all.jsonl", 0)]
    assert (tmp_path / "o" / "all.jsonl").read_bytes() == b""


def entries(spark, rows):
    return spark.createDataFrame(rows, "id string, type string")


def ids(df):
    return sorted((r["id"], r["type"]) for r in df.collect())


def test_readers_keep_their_version(spark, tmp_path):
    path = str(tmp_path / "c")
    assert versions.upsert(entries(spark, [("a", "text"), ("b", "image")]), path) == 1
    pinned = versions.read_version(spark, path)
    assert versions.upsert(entries(spark, [("c", "text")]), path, "text") == 2
    assert versions.drop_type(spark, path, "image") == 3
    assert ids(pinned) == [("a", "text"), ("b", "image")] and ids(versions.read_version(spark, path)) == [("c", "text")]
    assert ids(versions.read_version(spark, path, 2)) == [("b", "image"), ("c", "text")]
    wide = spark.createDataFrame([("d", "image", 5)], "id string, type string, width int")
    versions.upsert(wide, path)
    assert {(r["id"], r["width"]) for r in versions.read_version(spark, path).collect()} == {("c", None), ("d", 5)}
    assert versions.vacuum(spark, path, keep=1) == 1 and versions.versions(spark, path) == [4]
    assert ids(versions.read_version(spark, path).select("id", "type")) == [("c", "text"), ("d", "image")]


def test_a_failed_change_keeps_the_version(spark, tmp_path):
    path = str(tmp_path / "c")
    with pytest.raises(Exception):
        versions.read_version(spark, path)
    versions.upsert(entries(spark, [("a", "text")]), path)
    with pytest.raises(Exception):
        versions.upsert(entries(spark, [("b", "text")]).withColumn("id", F.raise_error(F.lit("lost"))), path)
    with pytest.raises(ValueError):
        versions.upsert(entries(spark, [("b", "image")]), path, "text")
    assert versions.versions(spark, path) == [1] and ids(versions.read_version(spark, path)) == [("a", "text")]


def test_the_slower_of_two_changes_starts_over(spark, tmp_path, monkeypatch):
    path, old = str(tmp_path / "c"), versions.manifest
    versions.upsert(entries(spark, [("a", "text"), ("b", "image")]), path)
    raced = []

    def manifest(session, where, version=None):
        read = old(session, where, version)
        if not raced and version is None:
            raced.append(True)
            versions.drop_type(session, where, "image")
        return read

    monkeypatch.setattr(versions, "manifest", manifest)
    assert versions.upsert(entries(spark, [("c", "text")]), path, "text") == 3
    monkeypatch.undo()
    assert ids(versions.read_version(spark, path)) == [("c", "text")] and ids(versions.read_version(spark, path, 2)) == [("a", "text")]


def test_weighted_cut_against_running_sums(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(60), rng.randrange(4)) for _ in range(300)] + [(17, 1)] * 200
    df = spark.createDataFrame(rows + [(None, 9)], "place int, w int")
    for cap in (1, 2, 50, 333, sum(w for _, w in rows), sum(w for _, w in rows) + 1):
        want, total = None, 0
        for place in sorted({p for p, _ in rows}):
            total += sum(w for p, w in rows if p == place)
            if total >= cap:
                want = place
                break
        for width in (1_000_000, 7):
            assert weighted_cut(df, "place", F.col("w"), cap, width) == want


def test_dry_run_counts_equal_the_run(spark):
    rows = [(f"r{i}", f'{{"energy": {i}}}', "nutr_values_per100g") for i in range(9)] + [("far", '{"energy": 9999}', "nutr_values_per100g"), ("none", '"x"', "title")]
    merged = spark.createDataFrame(rows, "id string, v string, name string").selectExpr("id", "0 AS part", "map(name, parse_json(v)) AS fields")
    image_ids, bad = merged.select("id").filter("id <> 'r3'"), spark.range(2)
    for need in (False, True):
        dry = dry_run_documents(merged, image_ids, require_nutrition=need, malformed=bad).first().asDict()
        run = trust_documents(merged, image_ids, require_nutrition=need, malformed=bad)["report"].first().asDict()
        assert dry == {c: run[c] for c in dry}


def test_a_file_delivered_again_lands_once_across_restarts(spark, tmp_path):
    src, run = tmp_path / "src", lambda: land_stream(spark, str(src), str(tmp_path / "cp"), str(tmp_path / "out"), "ds").awaitTermination()
    src.mkdir()
    for name in ("a.json", "b.png", "c.tar"):
        (src / name).write_text(name)
    run()
    for folder in ("again", "and again"):
        (src / folder).mkdir()
        for name, text in (("a.json", "a.json"), ("b.png", "changed"), ("d.json", "d")):
            (src / folder / name).write_text(text)
        run()
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(bytes(r["content"]).decode() for r in rows.collect()) == ["a.json", "b.png", "changed", "d"]


def test_sources_go_once_their_targets_are_there(spark, tmp_path):
    src, out = tmp_path / "src", tmp_path / "out"
    (src / "x").mkdir(parents=True)
    for name in ("x/a.json", "x/b.png", "c.tar"):
        (src / name).write_text(name)
    kept = land_move(spark, str(src), str(out), "ds", "t", remove=False).first()
    assert len(files_under(out)) == 2 and len(files_under(src)) == 3 and tuple(kept) == (3, 1, 1, 1)
    land_move(spark, str(src), str(out), "ds", "t")
    assert files_under(src) == ["c.tar"] and len(files_under(out)) == 2
    assert land_move(spark, str(src), str(out), "ds", "t").first()["skipped_files"] == 1


def test_id_sets_add_up_across_runs(spark, tmp_path):
    rng, seen, path = random.Random(8), {}, str(tmp_path / "ids")
    for run in ("1", "b", "1", "c", "none"):
        seen[run] = [] if run == "none" else [(f"id{rng.randrange(400)}", f"k{rng.randrange(3)}") for _ in range(rng.choice([50, 300]))]
        pairs = spark.createDataFrame(seen[run] + [(None, "k")], "id string, key string").repartition(3)
        union = {i for rows in seen.values() for i, _ in rows}
        assert idsets.add_ids(pairs, path, run) == len(union)
    for runs in (["1"], ["b", "c"], ["none"], ["other"], None):
        rows = [x for r in runs or seen for x in seen.get(r, [])]
        assert idsets.count_ids(spark, path, runs).first()["ids"] == len({i for i, _ in rows})
        got = {r["id"]: r["keys"] for r in idsets.keys_of_ids(spark, path, runs).collect()}
        assert got == {i: sorted({k for j, k in rows if j == i}) for i in {i for i, _ in rows}}
    numbers = spark.read.parquet(f"{path}/numbers").collect()
    assert len({r["id"] for r in numbers}) == len({r["n"] for r in numbers}) == len(numbers)


def test_stream_lands_all_files_in_batches_of_bounded_size(spark, tmp_path):
    from larder.streaming.landing import land_stream

    for i in range(7):
        (tmp_path / "in" / f"d{i % 2}").mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / f"d{i % 2}" / f"f{i}.json").write_text(f"{{{i}}}")
    query = land_stream(spark, str(tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "out"), "d", batch_files=3)
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [3, 3, 1]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 7


def test_many_small_files_come_in_few_tasks(spark, tmp_path):
    from larder.sources.objects import stored_objects

    for i in range(400):
        (tmp_path / f"f{i}.txt").write_text("x")
    assert stored_objects(spark, str(tmp_path)).rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism


def test_tasks_list_folders_as_spark_does(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"d{i % 3}" / "é f").mkdir(parents=True, exist_ok=True)
        (tmp_path / f"d{i % 3}" / "é f" / f"{i} %.txt.gz").write_text(f"{i}")
    for name in ("top.txt", ".hidden", "_left", "_a=b", "d0/empty", "d1/x._COPYING_", "d2/_metadata_x"):
        (tmp_path / name).write_text("" if name.endswith("empty") else name)
    (tmp_path / "_staged").mkdir()
    (tmp_path / "_staged" / "x").write_text("x")
    (tmp_path / "d0" / "nowhere").symlink_to(tmp_path / "none")
    stored = objects.stored_objects(spark, str(tmp_path))
    assert len(stored.inputFiles()) <= 3 * spark.sparkContext.defaultParallelism
    got = sorted((r["key"], r["length"], bytes(r["content"])) for r in stored.collect())
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path)).collect()
    assert got == sorted((r["path"].split(f"{tmp_path}/")[1], r["length"], bytes(r["content"])) for r in files) and len(got) == 302


def test_a_stream_keeps_no_path_of_a_file_at_the_driver(spark, tmp_path):
    src, run = tmp_path / "src", lambda: land_stream(spark, str(src), str(tmp_path / "cp"), str(tmp_path / "out"), "ds", batch_files=20).awaitTermination()
    src.mkdir()
    for i in range(50):
        (src / f"f{i}.json").write_text(f"{i}")
    run()
    remembered = "".join(p.read_text() for p in (tmp_path / "cp" / "sources").rglob("*") if p.is_file() and not p.name.startswith("."))
    assert remembered.count('"path"') == 3 and "f7.json" not in remembered
    (src / "new.json").write_text("new")
    # Listed by a run that ended before it landed anything.
    spark.createDataFrame([("new.json", 3)], objects.LISTED).write.mode("append").parquet(str(tmp_path / "cp" / "listings"))
    (src / "f7.json").write_text("read before")
    run()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(bytes(r["content"]).decode() for r in rows) == sorted([f"{i}" for i in range(50)] + ["new"])
    assert all(r["key"].startswith(f"file:{tmp_path}/src/") for r in rows)
