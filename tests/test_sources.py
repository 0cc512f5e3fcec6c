from __future__ import annotations

import gzip
import json
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.functions import images as I
from larder.functions import text as T
from larder.operators import landing as L
from larder.operators import outliers as O
from larder.plans import landing
from larder.sources import scan, sinks


def test_large_root_array_is_whole(spark, tmp_path):
    rows, filler = 70_000, "x" * 2_000
    with open(tmp_path / "big.json", "w") as f:
        f.write("[" + ",\n".join(json.dumps({"id": f"r{i}", "t": filler}) for i in range(rows)) + "]")
    assert (tmp_path / "big.json").stat().st_size > 130 << 20
    ids = scan.scan_documents(spark, str(tmp_path)).agg(F.countDistinct("id"), F.count("id"), F.max("pos")).first()
    assert tuple(ids) == (rows, rows, rows - 1)


def test_roots_of_all_kinds(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": "1"}, 5, {"id": "2"}]')
    (tmp_path / "b.json").write_text('{"id": "3"}')
    (tmp_path / "c.json").write_text("[]")
    (tmp_path / "d.json").write_text('[{"id": "x"}, {"id": ')
    (tmp_path / "e.jsonl").write_text('{"id": "4"}\n\n{bad\n{"id": "5"}\n')
    with gzip.open(tmp_path / "f.jsonl.gz", "wt") as f:
        f.write('{"id": "6"}\n')
    got = scan.scan_documents(spark, str(tmp_path)).select("id").collect()
    assert sorted(r["id"] for r in got) == ["1", "2", "3", "4", "5", "6", "x"]
    assert scan.scan_json(spark, str(tmp_path)).filter("v IS NULL").count() == 2
    with pytest.raises(Exception):
        scan.scan_json(spark, str(tmp_path), mode="failfast").collect()


def test_readers_agree_on_keys(spark, tmp_path):
    for name in ("a%20b.json", "a b.json", "a+b.json"):
        (tmp_path / name).write_text("{}")
    listed, _ = landing.land_organise(spark, str(tmp_path), "d", "t")
    keys = {r[0].rsplit("/", 1)[-1] for r in listed.select("source_key" if "source_key" in listed.columns else listed.columns[0]).collect()}
    assert len(keys) == 3
    bytes_ = {r["key"] for r in scan.scan_image_bytes(spark, str(tmp_path), "b").collect()}
    images = {r["key"] for r in scan.scan_images(spark, str(tmp_path)).select("key").collect()}
    assert bytes_ == images and all(k.startswith("file:/") and not k.startswith("file://") for k in bytes_)


def test_manifest_has_no_caps_by_default(spark):
    files = spark.createDataFrame([("a.json",)], "path string")
    recipes = spark.createDataFrame([(i, f"r{i}", [("u",)]) for i in range(1200)], "pos int, id string, images array<struct<url:string>>")
    assert landing.land_manifest(files, "p", recipes)["images"].count() == 1200
    assert landing.land_manifest(files, "p", recipes, max_images=7)["images"].count() == 7
    assert landing.land_manifest(files, "p", recipes, max_recipes=9)["images"].count() == 9


def test_scripts_and_marks(spark):
    cases = {
        unicodedata.normalize("NFD", "jalapeño"): "jalapeno", "⅓ cup ﬁlet": "1 3 cup filet", "Тёплый борщ": "teplyi borshch",
        "σούπα": "soupa", "寿司 rice": "寿司 rice", "Crème brûlée": "creme brulee",
    }
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    got = [r[0] for r in df.select(T.clean_text("x", stop=None)).collect()]
    assert got == list(cases.values())
    fish = spark.createDataFrame([("fish & chips",)], "x string").select(T.clean_text("x", stop=None, extra={"&": "and"}), T.to_ascii("x", {"&": "and"}))
    assert tuple(fish.first()) == ("fish and chips", "fish and chips")


def test_quantile_methods_agree_to_the_bit(spark):
    g = np.random.default_rng(3)
    df = spark.createDataFrame([tuple(map(float, r)) for r in g.normal(size=(501, 6))], ", ".join(f"c{i} double" for i in range(6)))
    names = df.columns
    assert O.iqr_bounds(df, names, method="percentile").first() == O.iqr_bounds(df, names, method="select").first()


def test_emptied_type_leaves_a_collection(spark, tmp_path):
    path = str(tmp_path / "c")
    texts = spark.createDataFrame([("a", "text"), ("b", "image")], "id string, type string")
    sinks.write_collection(texts, path)
    assert sinks.write_collection(texts.filter("id = 'none'"), path, "text").count() == 0
    assert [r["id"] for r in sinks.read_collection(spark, path).collect()] == ["b"]


def test_letterbox_of_a_large_picture_is_quick():
    import time

    pixels = np.random.default_rng(1).integers(0, 256, (1500, 2000, 3)).astype(np.uint8)
    I.letterboxed(pixels, (256, 256))
    start = time.time()
    I.letterboxed(pixels, (256, 256))
    assert time.time() - start < 2.0


def test_report_counts_apart(spark):
    from larder.plans.trusted import trust_documents

    rows = [(f"r{i}", f'{{"energy": {i}}}', "nutr_values_per100g") for i in range(9)] + [("far", '{"energy": 9999}', "nutr_values_per100g"), ("none", '"x"', "title")]
    merged = spark.createDataFrame(rows, "id string, v string, name string").selectExpr("id", "0 AS part", "map(name, parse_json(v)) AS fields")
    ids = merged.select("id")
    bad = spark.range(3).toDF("line")
    row = trust_documents(merged, ids, require_nutrition=True, malformed=bad)["report"].first()
    assert (row["total_doc_count"], row["malformed_doc_count"], row["written_doc_count"]) == (14, 3, 9)
    assert (row["dropped_missing_nutrition"], row["dropped_outliers"]) == (1, 1)
    row = trust_documents(merged, ids)["report"].first()
    assert (row["written_doc_count"], row["dropped_missing_nutrition"], row["dropped_outliers"]) == (10, 0, 1)


@pytest.mark.parametrize("most,want", [(5, [0, 1, 2, 3, 4]), (4, [0, 1, 2, 3, 4]), (3, [0, 1, 2]), (1, [0, 1]), (0, [])])
def test_image_cap_alone_keeps_recipes_behind_the_last_image(spark, most, want):
    recipes = spark.createDataFrame([(0, 0), (1, 2), (2, 1), (3, 0), (4, 0)], "id int, ok int")
    got = L.ingest_cap(recipes, "id", max_recipes=None, max_images=most).collect()
    assert sorted(r["id"] for r in got) == want
