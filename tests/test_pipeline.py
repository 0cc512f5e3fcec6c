from __future__ import annotations

import gzip
import json

import pytest
from pyspark.sql import functions as F

from larder.operators.search import search_summary
from larder.plans import exploitation, tasks
from larder.plans.formatted import format_documents
from larder.plans.landing import land_organise
from larder.plans.trusted import image_ids, trust_documents
from larder.sources import scan, sinks
from larder.streaming.landing import land_stream

LAYER1 = [
    {"id": "r1", "title": "Tomato Pasta", "url": "u", "partition": "train", "ingredients": [{"text": "Tomatoes"}, {"text": "Pasta"}], "instructions": [{"text": "Boil."}, {"text": "Mix."}]},
    {"id": "r2", "title": "Basil Pesto", "ingredients": [{"text": "Basil"}], "instructions": []},
    {"id": "r3", "title": "No picture", "ingredients": []},
    {"id": "", "title": "no id"},
    {"id": 7, "title": "Number Seven", "ingredients": [{"text": None}, {"text": "seven"}]},
]
NUTRITION = [
    {"id": "r1", "nutr_values_per100g": {"energy": 1, "fat": 2.0, "salt": "9"}, "fsa_lights_per100g": {"fat": "green", "salt": None}},
    {"id": "r2", "nutr_values_per100g": {"energy": 2}, "nutr_per_ingredient": [{"fat": 1}]},
]


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    root = tmp_path_factory.mktemp("docs with space")
    (root / "a$b$c$x__layer1.json").write_text(json.dumps(LAYER1))
    lines = [json.dumps(r) for r in NUTRITION]
    with gzip.open(root / "x__recipes_with_nutritional_info.jsonl.gz", "wt") as f:
        f.write("\n".join([lines[0], "", "{broken", "[1, 2]"]) + "\n")
    (root / "y__recipes_with_nutritional_info.NDJSON").write_text(lines[1])
    (root / "z__single.json").write_text('  {"id": "r1", "note": 1.0}')
    (root / "bad.json").write_text("{oops")
    (root / "list.txt").write_text('{"id": "skipped"}')
    return str(root)


def test_scan(spark, source):
    rows = scan.scan_documents(spark, source).select("id", "tag", F.to_json("v").alias("j")).collect()
    assert sorted((r["id"], r["tag"]) for r in rows) == [
        ("", "layer1"), ("7", "layer1"), ("r1", "layer1"), ("r1", "recipes_with_nutritional_info"),
        ("r1", "single"), ("r2", "layer1"), ("r2", "recipes_with_nutritional_info"), ("r3", "layer1"),
    ]
    assert [r["j"] for r in rows if r["tag"] == "single"] == ['{"id":"r1","note":1}']
    roots = scan.scan_json(spark, source)
    assert roots.filter("v IS NULL").count() == 2
    with pytest.raises(Exception, match="MALFORMED"):
        scan.scan_json(spark, source, mode="failfast").collect()


@pytest.fixture(scope="module")
def merged(spark, source, tmp_path_factory):
    rows, counters = format_documents(spark, source, str(tmp_path_factory.mktemp("out") / "merged"))
    return rows, counters


def test_merged(spark, merged, tmp_path):
    rows, counters = merged
    assert [r["id"] for r in rows.collect()] == ["7", "r1", "r2", "r3"]
    assert counters.select("total_records", "unique_ids").distinct().collect() == [(7, 4)]
    sinks.write_merged_jsonl(rows, str(tmp_path / "j"))
    lines = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "j")).collect()]
    assert lines[1]["id"] == "r1" and lines[1]["note__from_single"] == 1 and "url__from_layer1" not in lines[1]


@pytest.fixture(scope="module")
def trusted(spark, merged, tmp_path_factory):
    keys = spark.createDataFrame([(f"i/h__{r}_0.jpg",) for r in ("r1", "r2", "r9")] + [("i/h__7_0.jpg",)], "key string")
    out = str(tmp_path_factory.mktemp("trusted"))
    return trust_documents(merged[0], image_ids(keys), out=out)


def test_trusted(trusted):
    rows = {r["id"]: r for r in trusted["trusted"].collect()}
    assert sorted(rows) == ["7", "r1", "r2"]
    assert rows["r1"]["title_text_clean"] == "tomato pasta" and rows["r1"]["instructions_text_raw"] == "Boil. Mix."
    assert rows["r1"]["has_nutrition_data"] and not rows["r1"]["nutrition_normalized"]
    assert rows["r2"]["nutrition_normalized"]
    assert not any(k.startswith("nutr_values") for k in rows["r2"]["fields"])
    assert rows["7"]["ingredients_text_raw"] == "seven" and not rows["7"]["has_nutrition_data"]
    report = trusted["report"].first()
    assert (report["total_doc_count"], report["written_doc_count"], report["filtering_rate"]) == (4, 3, "75.00%")
    assert report["nutrition_totals_dropped"] == 1 and report["unique_ids_with_images"] == 4
    assert report["tokens_title_text_raw"] == 2.0
    assert trusted["bounds"].first()["energy_q1"] == 1.25 and trusted["bounds"].first()["salt_q1"] is None


def test_no_ids_is_an_error(merged):
    with pytest.raises(ValueError, match="no recipe ids"):
        trust_documents(merged[0], merged[0].select("id").limit(0))


def test_require_nutrition(merged):
    result = trust_documents(merged[0], merged[0].select("id"), require_nutrition=True)
    assert sorted(r["id"] for r in result["trusted"].collect()) == ["r1", "r2"]


@pytest.fixture(scope="module")
def collections(spark, trusted, tmp_path_factory):
    root = tmp_path_factory.mktemp("collections")
    docs, mixed, pictures = (str(root / n) for n in ("documents", "mixed", "images"))
    for _ in range(2):
        exploitation.exploit_documents(trusted["trusted"], docs, mixed)
        images = spark.createDataFrame([(f"images/h__r{i}_0.jpg", i) for i in range(1, 4)], "key string, n int").select(
            "key",
            F.struct(
                F.col("key").alias("origin"), F.when(F.col("n") < 3, 2).otherwise(-1).alias("height"), F.lit(2).alias("width"),
                F.lit(1).alias("nChannels"), F.lit(0).alias("mode"), F.unhex(F.format_string("%02x00ff0a", F.col("n") * 20)).alias("data"),
            ).alias("image"),
        )
        exploitation.exploit_images(images, "trusted-zone", "images", "2024-01-01T00-00-00Z", pictures, mixed)
    return tuple(sinks.read_collection(spark, p) for p in (docs, mixed, pictures))


def test_collections(collections):
    docs, mixed, pictures = collections
    entry = docs.filter("id = 'r1'").first()
    assert entry["document"] == "title: tomato pasta\ningredients: tomatoes pasta\ninstructions: boil mix"
    assert (entry["fsa_fat"], entry["fsa_salt"], entry["type"]) == ("green", None, "text")
    assert {r["type"]: r["count"] for r in mixed.groupBy("type").count().collect()} == {"text": 3, "image": 2}
    assert sorted(r["id"] for r in pictures.collect()) == ["images__h__r1_0.jpg", "images__h__r2_0.jpg"]


def test_unreadable_images_can_be_kept(spark):
    bad = spark.sql("""SELECT 'k' AS key, named_struct('origin', 'k', 'height', -1, 'width', -1, 'nChannels', -1,
        'mode', -1, 'data', cast('' AS binary)) AS image""")
    row = exploitation.exploit_images(bad, "b", "p", "t", keep_unreadable=True).first()
    assert (row["image_height"], row["image_width"], row["image_channels"]) == (224, 224, 3)
    assert exploitation.exploit_images(bad, "b", "p", "t").isEmpty()


def test_tasks(spark, collections):
    docs, mixed, pictures = collections
    queries = spark.createDataFrame([(1, "pasta with tomato", None), (2, "basil", "me.jpg")], "query_id int, query string, user_image_path string")
    hits = tasks.retrieve_text(queries, docs, 2).collect()
    assert [r["id"] for r in sorted(hits) if r["rank"] == 1] == ["r1", "r2"]
    found, summary = tasks.multimodal_search(queries, mixed, 127)
    row = summary.orderBy("query_id").first()
    assert (row["total_count"], row["image_count"], row["text_count"], row["num_results"]) == (5, 2, 3, 5)
    data = spark.createDataFrame([("trusted-zone", "images/h__r1_0.jpg", bytearray(b"abc" * 60))], "bucket string, key string, content binary")
    traces = tasks.rag_prepare(queries, docs, pictures, data, timestamp="2024-01-01T00-00-00Z").orderBy("query_id").collect()
    assert [len(t["retrieved_text"]) for t in traces] == [3, 3]
    assert [[i["key"] for i in t["retrieved_images"]] for t in traces] == [["images/h__r1_0.jpg"]] * 2
    assert "\n" not in traces[0]["retrieved_images"][0]["b64"]
    assert "- TEXT 1 (score " in traces[0]["prompt"] and "- IMAGE 1: bucket=trusted-zone, key=images/h__r1_0.jpg" in traces[0]["prompt"]
    assert "attached no photo" in traces[0]["prompt"] and "attached a photo" in traces[1]["prompt"]
    empty = tasks.rag_prepare(queries, docs.limit(0), pictures.limit(0), data, timestamp="t").first()
    assert "(no text candidates found)" in empty["prompt"] and "(no image candidates found)" in empty["prompt"]
    assert tasks.demo_results(queries, tasks.retrieve_text(queries, docs, 3)).first()["num_results"] == 3


def test_summary_fixture(spark):
    hits = spark.createDataFrame([(1, "image", 0.5), (1, "text", 0.3), (1, "image", 0.8), (1, "text", 0.4)], "query_id int, type string, score double")
    queries = spark.createDataFrame([(1, "q"), (2, "none")], "query_id int, query string")
    rows = search_summary(queries, hits, hits, 127).orderBy("query_id").collect()
    assert all(x in rows[0]["summary"] for x in ("0.500", "0.800", "0.300", "0.400")) and rows[1]["summary"].count("N/A") == 4
    assert (rows[0]["closest_distance"], rows[0]["farthest_distance"], rows[1]["num_results"]) == (0.3, 0.8, 0)


def test_landing_stream_equals_batch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for name in ("a.json", "b.JPEG", "c.tar"):
        (src / name).write_text(name)
    run = lambda: land_stream(spark, str(src), str(tmp_path / "cp"), str(tmp_path / "out"), "ds").awaitTermination()
    run()
    first = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["class"] for r in first.collect()) == ["document", "image"]
    (src / "d.png").write_text("d")
    run()
    landed = spark.read.parquet(str(tmp_path / "out"))
    batch, counters = land_organise(spark, str(src), "ds")
    cut = F.regexp_replace("dst_key", r"\d{4}-[^$]*Z", "")
    keys = lambda df: sorted(r[0] for r in df.filter("dst_key IS NOT NULL").select(cut).collect())
    assert keys(landed) == keys(batch) and len(keys(batch)) == 3
    assert tuple(counters.first()) == (4, 2, 1, 1)
