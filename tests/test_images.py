from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.functions import images as I
from larder.operators import screening as Q
from larder.plans.formatted import format_images, screen_and_box
from larder.plans.trusted import recipe_images, trust_images
from larder.sources.scan import list_objects, scan_images

G = np.random.default_rng(2)


def noise(height, width, channels=3):
    return G.integers(0, 256, (height, width, channels), dtype=np.uint8)


def brute_laplacian(p):
    grey = I.grey_levels(p)
    h, w = grey.shape
    at = lambda y, x: grey[min(abs(y), 2 * (h - 1) - abs(y)) if h > 1 else 0, min(abs(x), 2 * (w - 1) - abs(x)) if w > 1 else 0]
    found = [at(y - 1, x) + at(y + 1, x) + at(y, x - 1) + at(y, x + 1) - 4 * at(y, x) for y in range(h) for x in range(w)]
    return float(np.var(np.array(found, dtype=np.float64)))


@pytest.mark.parametrize("shape", [(5, 7), (1, 6), (6, 1), (2, 2), (1, 1)])
def test_laplacian(shape):
    p = noise(*shape)
    assert I.laplacian_variance(p) == pytest.approx(brute_laplacian(p))


def test_grey_of_primaries():
    bgr = np.array([[[0, 0, 255], [0, 255, 0], [255, 0, 0], [255, 255, 255]]], dtype=np.uint8)
    assert I.grey_levels(bgr)[0].tolist() == [76, 150, 29, 255]


def test_resample_keeps_constants_and_identity():
    flat = np.full((13, 29, 3), 137, dtype=np.uint8)
    for kind in I.FILTERS:
        assert (I.resample(flat, 8, 40, kind) == 137).all()
        p = noise(9, 9)
        assert (I.resample(p, 9, 9, kind) == p).all()


def test_resample_equals_direct_sum():
    p = noise(21, 10, 1)
    kernel, radius = I.FILTERS["bicubic"]
    scale = 21 / 6
    got = I.resample(p, 10, 6, "bicubic")[:, :, 0]
    for t in range(6):
        w = np.array([kernel(np.array((s + 0.5 - (t + 0.5) * scale) / scale)) for s in range(21)])
        w[np.abs((np.arange(21) + 0.5 - (t + 0.5) * scale) / scale) >= radius] = 0
        want = np.clip((w / w.sum()) @ p[:, :, 0], 0, 255)
        assert np.abs(got[t] - want).max() <= 1.0


def test_phash_is_stable_under_scaling_and_differs():
    p = I.resample(noise(8, 8), 64, 64, "bicubic")
    big = np.kron(p, np.ones((2, 2, 1), dtype=np.uint8))
    one, two = int(I.perceptual_hash(p), 16), int(I.perceptual_hash(big), 16)
    assert bin(one ^ two).count("1") <= 4 and len(I.perceptual_hash(p)) == 16
    assert bin(one ^ int(I.perceptual_hash(noise(64, 64)), 16)).count("1") > 10


def test_letterbox_geometry():
    red = np.zeros((50, 100, 3), dtype=np.uint8)
    red[:, :, 2] = 200
    box = I.letterboxed(red, (64, 64))
    assert box.shape == (64, 64, 3) and (box[16:48, :, 2] == 200).all()
    assert not box[:16].any() and not box[48:].any()
    assert I.fit_inside(100, 50, (512, 512)) == (512, 256) and I.fit_inside(50, 100, (512, 512)) == (256, 512)


def test_alpha():
    p = np.array([[[10, 20, 30, 0], [10, 20, 30, 255]]], dtype=np.uint8)
    assert I.flatten_alpha(p).tolist() == [[[255, 255, 255], [10, 20, 30]]]


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """Image files written with the JVM's codecs: two equal ones, a small, a flat, a long, a broken one."""
    root = tmp_path_factory.mktemp("images")
    io, types = spark._jvm.javax.imageio.ImageIO, spark._jvm.java.awt.image.BufferedImage

    def write(name, pixels):
        h, w = pixels.shape[:2]
        image = types(w, h, types.TYPE_INT_RGB)
        rgb = (pixels[:, :, 2].astype(int) << 16) | (pixels[:, :, 1].astype(int) << 8) | pixels[:, :, 0]
        array = spark._sc._gateway.new_array(spark._jvm.int, h * w)
        for i, v in enumerate(rgb.ravel().tolist()):
            array[i] = v
        image.setRGB(0, 0, w, h, array, 0, w)
        io.write(image, "png", spark._jvm.java.io.File(str(root / name)))

    p = noise(48, 40)
    write("h__r1_0.png", p)
    write("h__r1_1.png", p)
    write("h__r2_0.png", p)
    write("h__r1_2.png", noise(8, 40))
    write("h__r1_3.png", np.full((48, 40, 3), 90, dtype=np.uint8))
    write("h__r1_4.png", noise(40, 200))
    (root / "h__r1_5.jpg").write_bytes(b"not an image")
    return str(root)


LIMITS = Q.Thresholds(16, 16, 0.5, 3.0, 50.0)


def test_screening_of_files(spark, files, tmp_path):
    found = format_images(spark, files, str(tmp_path / "out"), limits=LIMITS, size=(32, 32))
    rows = {r["key"].rsplit("__", 1)[1]: r for r in found["screened"].collect()}
    assert {k: r["reason"] for k, r in rows.items()} == {
        "r1_0.png": None, "r1_1.png": "duplicate", "r2_0.png": None, "r1_2.png": "too_small",
        "r1_3.png": "too_blurry", "r1_4.png": "bad_aspect", "r1_5.jpg": "corrupted",
    }
    assert rows["r1_1.png"]["original_key"].endswith("r1_0.png")
    assert rows["r1_2.png"]["detail"] == "too_small:40x8" and rows["r1_4.png"]["detail"] == "bad_aspect:5.00"
    assert rows["r1_3.png"]["detail"] == "blurry:varLap=0.00 < 50.0"
    assert tuple(found["counters"].first()) == (7, 2, 1, 1, 1, 1, 1)
    assert found["skips"].count() == 5
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["dst_key"] for r in stored.collect()) == ["images/h__r1_0.jpg", "images/h__r2_0.jpg"]
    assert {(r["image"]["height"], r["image"]["width"]) for r in stored.collect()} == {(32, 32)}


def test_existing_targets_are_skipped(spark, files):
    done = spark.createDataFrame([("images/h__r1_0.jpg",)], "dst_key string")
    images = scan_images(spark, files)
    kept = screen_and_box(images, limits=LIMITS, size=(16, 16), existing=done, overwrite=False)["kept"]
    assert [r["dst_key"] for r in kept.collect()] == ["images/h__r2_0.jpg"]
    report = screen_and_box(images, limits=LIMITS, size=(16, 16), existing=done, overwrite=False)["report"].first()
    assert (report["kept"], report["images_copied"], report["images_skipped"], report["unique_recipe_ids"]) == (2, 1, 1, 2)
    assert screen_and_box(images, limits=LIMITS, size=(16, 16), dedup=False)["kept"].count() == 3


def test_trusted_images(spark, files, tmp_path):
    found = trust_images(scan_images(spark, files), str(tmp_path), limits=LIMITS, size=(16, 16))
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "ids")).collect()) == ["r1", "r2"]
    log = spark.read.option("header", True).csv(str(tmp_path / "skips"))
    assert log.columns == ["key", "reason", "original_key"] and log.count() == 5
    assert spark.read.json(str(tmp_path / "report")).first()["kept"] == 2
    assert [r["part"] for r in recipe_images(found["screened"]).collect()] == [0, 0]


def test_listing(spark, files):
    assert list_objects(spark, files, ("png",)).count() == 6
    assert list_objects(spark, files).filter(F.col("length") > 0).count() == 7


def test_rasters_come_in_short_batches(spark):
    from larder.functions import images as I

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, 10_000)
    try:
        for make in (I.measure, I.blur, I.letterbox):
            spark.conf.set(name, 10_000)
            make("image")
            assert int(spark.conf.get(name)) <= 500
    finally:
        spark.conf.set(name, before)


def test_neighbours_of_every_twentieth_image_among_all(spark, folder):
    import numpy as np

    from larder.catalog import images as C
    from larder.operators.embed import pixel_embed

    rows = pixel_embed(C.rasters(spark, folder)).select("key", "embedding").collect()
    keys, vectors = [r["key"] for r in rows], np.array([r["embedding"] for r in rows], np.float64)
    want = {}
    for key, q in zip(keys, vectors):
        if int(key.rsplit("_", 1)[1][:-4]) % 20 == 0:
            score = np.square(vectors - q).sum(1)
            want[key] = [keys[i] for i in sorted(range(len(keys)), key=lambda i: (score[i], keys[i]))[:3]]
    got = {}
    for r in sorted(C.image_neighbours(spark, folder).collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["id"])
    assert got == want


def test_entries_hold_the_colour_form_of_an_image(spark):
    from larder.plans.exploitation import image_entries

    shapes = [("grey", 2, 3, 1, 0, bytes(range(6))), ("alpha", 1, 2, 4, 24, bytes(range(8))), ("bgr", 1, 1, 3, 16, b"abc"), ("none", -1, -1, -1, -1, b"")]
    rows = [(n, (n, h, w, c, m, bytearray(d))) for n, h, w, c, m, d in shapes]
    images = spark.createDataFrame(rows, "key string, image struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>")
    got = {r["id"]: (r["image_height"], r["image_width"], r["image_channels"], bytes(r["image"]["data"])) for r in image_entries(images, "b", "p", "t").collect()}
    assert got == {
        "grey": (2, 3, 3, bytes(v for v in range(6) for _ in range(3))), "alpha": (1, 2, 3, bytes([0, 1, 2, 4, 5, 6])), "bgr": (1, 1, 3, b"abc"),
    }


def test_an_empty_text_is_an_image_of_no_pixels(spark, tmp_path):
    from larder.catalog import images as C

    rows = [(1, "", "en", "a", 0), (2, None, "en", "a", None), (3, "x" * 100, "en", "a", 100), (20, "", None, "a", 0), (40, "yz" * 300, "en", "a", 600)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    empty = {"images/en__a_1.jpg", "images"}
    got = {r["key"]: tuple(r)[1:] for r in C.image_metrics(spark, str(tmp_path)).collect()}
    assert {k for k, v in got.items() if v == (0, 0, 0.0, None)} == empty and got["images/en__a_2.jpg"] == (None, None, 0.0, None) and len(got) == 5
    for query in (C.image_reasons, C.image_screen):
        got = {r["key"]: r["reason"] for r in query(spark, str(tmp_path)).collect()}
        assert {k for k, reason in got.items() if reason == "corrupted"} == empty | {"images/en__a_2.jpg"} and len(got) == 5
    whole = {"images/en__a_3.jpg", "images/en__a_40.jpg"}
    assert {r["object_key"] for r in C.image_records(spark, str(tmp_path)).collect()} == whole
    assert {(r["query_id"], r["id"]) for r in C.image_neighbours(spark, str(tmp_path)).collect()} == {("images/en__a_40.jpg", k) for k in whole}
    assert C.image_boxes(spark, str(tmp_path)).count() <= 2
