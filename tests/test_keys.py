from __future__ import annotations

import hashlib
import re
from pathlib import PurePosixPath

from pyspark.sql import functions as F

from larder.functions import keys as K

PATHS = [
    "a/b.txt", "a//b/./c.tar.gz", "a/b/", "", ".", "/", ".hidden", "a/.hidden.json", "x.", "noext", "dir.d/noext",
    "a b/ü ñ.JPEG", "./a", "a/.",
]


def column(spark, values, *exprs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    rows = df.select("i", *[e.alias(f"r{n}") for n, e in enumerate(exprs)]).orderBy("i").collect()
    return [tuple(r)[1:] for r in rows]


def test_path_parts_equal_pathlib(spark):
    x = F.col("x")
    got = column(spark, PATHS, K.posix_path(x), K.file_name(x), K.file_stem(x), K.file_suffix(x))
    for path, (p, name, stem, suffix) in zip(PATHS, got):
        ref = PurePosixPath(path)
        assert (p, name, stem, suffix) == (str(ref), ref.name, ref.stem, ref.suffix.lower().lstrip(".")), path


def test_object_key(spark):
    got = column(spark, PATHS, K.object_key("x"))
    for path, (key,) in zip(PATHS, got):
        p = PurePosixPath(path)
        assert key == hashlib.sha256(str(p).encode()).hexdigest()[:16] + "__" + (p.name or "file")


def test_image_key(spark):
    got = column(spark, ["r1"], K.image_key(F.lit("p"), F.col("x"), F.lit(3), F.lit("png")))[0][0]
    assert got == f"p/{hashlib.sha256(b'r1:3').hexdigest()[:32]}__r1_3.png"


def test_sanitize_fixture(spark):
    names = {
        "a-b.c_9": "a-b.c_9",
        " lead and  trail ": "_lead_and_trail_",
        "50%+tax(?)": "50_tax_",
        "": "",
        "ünï_çode-½.x": re.sub(r"[^\w\-.]+", "_", "ünï_çode-½.x"),
    }
    assert [r[0] for r in column(spark, list(names), K.sanitize("x"))] == list(names.values())


def test_recipe_ids(spark):
    cases = {
        "images/image$ds$ts$hash__000018c8a5_0.jpg": ("000018c8a5", "000018c8a5"),
        "a/h__abcd_ef-12_3.JPEG": ("abcd_ef-12", "abcd_ef-12"),
        "h__a__b_1_2.png": ("a__b_1", "a__b_1"),
        "plain.jpg": ("plain.jpg", None),
        "h__x_1.txt": ("x", None),
    }
    assert column(spark, list(cases), K.recipe_id("x"), K.recipe_id("x", strict=True)) == list(cases.values())


def test_short_tag(spark):
    cases = {
        "p/document$ds$2024$abc__layer1.json": "layer1",
        "p/document$ds$ts$det-ingrs.json": "ingrs",
        "x/" + "a" * 60 + ".json": "a" * 40,
        "x/Some Name!.json": "some_name",
        "x/---.json": "file",
        "x/a__.json": "file",
    }
    assert [r[0] for r in column(spark, list(cases), K.short_tag("x"))] == list(cases.values())


def test_classify_image_first(spark):
    rows = [
        ("a.jpeg", None, "image", "jpg"), ("a.json", "image/png", "image", "json"), ("a", "application/json; x=1", "document", "json"),
        ("a", "image/jpeg", "image", "jpg"), ("a", None, "skip", "bin"), ("a.ndjson", "", "document", "ndjson"), ("a.tar", "text/plain", "skip", "tar"),
    ]
    df = spark.createDataFrame([(i, *r[:2]) for i, r in enumerate(rows)], "i int, k string, c string")
    got = df.orderBy("i").select(K.classify_object("k", "c"), K.extension("k", "c")).collect()
    assert [tuple(r) for r in got] == [r[2:] for r in rows]


def test_url_extension(spark):
    urls = {"http://h/a/b.JPEG?x=1": "jpg", "http://h/a.webp#f": "webp", "http://h/a.tiff": "jpg", "https://h.png": "jpg"}
    assert [r[0] for r in column(spark, list(urls), K.url_extension("x"))] == list(urls.values())
    assert column(spark, ["http://h/x"], K.url_extension("x", F.lit("image/GIF; q=1")))[0][0] == "gif"


def test_timestamp_and_trace_key(spark):
    ts = column(spark, ["q"], K.utc_timestamp())[0][0]
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d-\d\d-\d\dZ", ts) and len(ts) == 20
    key = column(spark, ["test query"], K.trace_key("x", F.lit(ts)))[0][0]
    digest = hashlib.sha1(b"test query").hexdigest()[:8]
    assert key == f"results/generative/rag_multimodal/{ts}_{digest}.json"


def test_jpg_key_and_vector_id(spark):
    got = column(spark, ["a/b.c.png", "a/x"], K.jpg_key(F.lit("out"), "x"), K.vector_id("x"), K.original_name("x"))
    assert got == [("out/b.c.jpg", "a__b.c.png", "b.c.png"), ("out/x.jpg", "a__x", "x")]


def test_a_key_is_taken_apart_few_times(spark):
    from larder.operators.landing import organise

    rows = spark.createDataFrame([("a//b.JPEG", "image/png")], "key string, content_type string")
    plan = organise(rows, "b", "d", "t").select("class", "dst_key")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") < 100


def test_path_parts_of_odd_keys(spark):
    from larder.functions import keys as K

    rows = spark.createDataFrame([("",), (".",), ("/",), ("a/.",), ("\n",), ("x.jpe",), ("x.jpeg",), ("x.JPEG\n",), ("x",), (None,)], "k string")
    got = rows.select(K.posix_path("k"), K.file_name("k"), K.extension("k")).collect()
    assert [tuple(r) for r in got] == [
        (".", "", "bin"), (".", "", "bin"), ("/", "", "bin"), ("a", "a", "bin"), ("\n", "\n", "bin"),
        ("x.jpe", "x.jpe", "jpg"), ("x.jpeg", "x.jpeg", "jpg"), ("x.JPEG\n", "x.JPEG\n", "jpeg\n"), ("x", "x", "bin"), (None, None, None),
    ]
