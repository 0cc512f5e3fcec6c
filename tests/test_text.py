from __future__ import annotations

import random
import textwrap

from pyspark.sql import functions as F

from larder.functions import text as T


def one(spark, value, expr):
    df = spark.createDataFrame([(value,)], "x string")
    return df.select(expr(F.col("x")).alias("r")).first()["r"]


def test_clean_text_steps(spark):
    cases = {
        None: "",
        "": "",
        "  The QUICK, brown fox!  ": "quick brown fox",
        "Crème Brûlée à l'Orange": "creme brulee l orange",
        "Straße Œuf Æble": "strasse oeuf aeble",
        "½ cup at 180° × 2": "1 2 cup 180deg x 2",
        "don't do that": "",
        "tab\tnew\nline": "tab new line",
        "борщ soup": "borshch soup",
    }
    for text, want in cases.items():
        assert one(spark, text, T.clean_text) == want


def test_clean_text_options(spark):
    assert one(spark, "The, Cat", lambda c: T.clean_text(c, stop=None)) == "the cat"
    assert one(spark, "A, Cat", lambda c: T.clean_text(c, punctuation=False)) == "a, cat"
    assert one(spark, "борщ soup", lambda c: T.clean_text(c, extra={"б": "b", "о": "o", "р": "r", "щ": "shch"})) == (
        "borshch soup"
    )


def test_stopword_test_is_a_set_lookup(spark):
    df = spark.createDataFrame([("a b",)], "x string").select(T.clean_text("x"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "INSET" in plan


def test_stopwords_of_other_languages(spark):
    assert "der" in T.stopwords("german") and len(T.ENGLISH_STOPWORDS) == 179


def test_token_len(spark):
    for text in (None, "", "   ", "a", " a  b\tc\n"):
        assert one(spark, text, T.token_len) == len((text or "").split())


def test_join_text_list_skips_nulls(spark):
    df = spark.createDataFrame([([("a",), (None,), (" b ",)],), (None,)], "x array<struct<text:string>>")
    rows = df.select(T.join_text_list("x").alias("p"), T.join_text_list_stripped("x").alias("s")).collect()
    assert [tuple(r) for r in rows] == [("a  b ", "a b"), ("", "")]


def test_document_text_and_sections(spark):
    df = spark.createDataFrame([("t", "", "i"), ("", "", "")], "a string, b string, c string")
    docs = df.select(T.document_text("a", "b", "c").alias("d"))
    assert [r["d"] for r in docs.collect()] == ["title: t\ninstructions: i", ""]
    back = docs.select(*[T.document_section("d", n) for n in ("title", "ingredients", "instructions")])
    assert tuple(back.first()) == ("t", "", "i")


def test_snippet(spark):
    assert one(spark, "x" * 200, T.snippet) == "x" * 200
    assert one(spark, "x" * 201, T.snippet) == "x" * 200 + " ..."


def test_preview_equals_textwrap(spark):
    words = "Slow-cooked well-done beef with half-and-half sauce and 2-inch carrots " * 6
    for n in range(120, 320, 7):
        text = words[:n] + "\n tail  end"
        assert one(spark, text, T.preview) == textwrap.shorten(text, width=180, placeholder="…")
    assert one(spark, "x" * 300, T.preview) == textwrap.shorten("x" * 300, width=180, placeholder="…")


def test_fixed_rounds_like_python(spark):
    g = random.Random(1)
    values = [1.125, 0.375, 2.5, 1.0, 123.456, 0.005, 1.005, 1.015, -0.001, -2.675, 1e11 + 0.125, 0.0]
    values += [g.randrange(10**6) / 1000 for _ in range(500)] + [g.randrange(4000) / g.randrange(1, 4000) for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in values], "x double").select("x", T.fixed("x", 2).alias("f"))
    assert [r["f"] for r in df.collect()] == [f"{x:.2f}" for x in values]
    assert one(spark, None, lambda c: T.fixed(c, 3)) is None


def test_percent_and_badges(spark):
    df = spark.createDataFrame([(1, 3, "red"), (0, 0, None), (2, 4, "pink")], "a int, b int, c string")
    rows = df.select(T.percent(F.col("a"), F.col("b")), T.colour_badge("c")).collect()
    assert [tuple(r) for r in rows] == [("33.33%", "🔴"), ("0%", "⚪"), ("50.00%", "⚪")]
