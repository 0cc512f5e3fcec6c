from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.functions import values as V
from larder.operators import outliers as O


@pytest.fixture(scope="module")
def frame(spark):
    g = np.random.default_rng(3)
    n = 4000
    copies = np.where(g.random(n) < 0.4, 7.0, g.normal(size=n))
    wild = np.exp(g.normal(size=n) * 40)
    rows = [
        (float(a), float(b), None if i % 3 else float(c), None)
        for i, (a, b, c) in enumerate(zip(copies, wild, g.integers(0, 5, n)))
    ]
    return spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(6).cache()


def test_selection_equals_numpy(frame):
    data = frame.toPandas()
    got = O.quantiles(frame, ["a", "b", "c", "d"], (0.0, 0.25, 0.5, 0.75, 1.0), limit=20)
    for c in ("a", "b", "c"):
        assert np.allclose(got[c], np.quantile(data[c].dropna(), [0, 0.25, 0.5, 0.75, 1]), rtol=1e-12)
    assert got["d"] is None


def test_methods_agree(frame):
    one, two = (O.iqr_bounds(frame, ["a", "b", "c", "d"], method=m).first() for m in ("percentile", "select"))
    for x, y in zip(one, two):
        assert (x is None and y is None) or np.isclose(x, y, rtol=1e-9)


def test_filter_passes_missing_and_infinite(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0, None, float("nan"), float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    bounds = O.iqr_bounds(df, ["x"])
    assert tuple(bounds.first()) == (2.0, 4.0, -1.0, 7.0)
    kept = [r["x"] for r in O.iqr_filter(df, ["x"], bounds).collect()]
    assert 100.0 not in kept and len(kept) == 7


def test_null_bounds_pass(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    bounds = O.iqr_bounds(df, ["x"])
    assert tuple(bounds.first()) == (None, None, None, None) and O.iqr_filter(df, ["x"], bounds).count() == 2
    array = df.select(F.array("x").alias("v"))
    assert array.filter(O.all_within("v", ["x"], bounds)).count() == 2


def test_numbers_by_json_type(spark):
    texts = ["1", "1.5", "1e3", '"12"', "true", "null", "[1]", "1e999"]
    df = spark.createDataFrame([(f'{{"f": {t}}}',) for t in texts], "j string")
    got = df.select(V.finite_numbers(V.parse_json("j"), ["f", "g"]).alias("n")).collect()
    assert [r["n"][0] for r in got][:7] == [1.0, 1.5, 1000.0, None, None, None, None]
    assert all(r["n"][1] is None for r in got)


def test_first_present_skips_json_null(spark):
    df = spark.sql("""SELECT map('a', parse_json('null'), 'b', parse_json('{}')) AS f""")
    assert df.select(V.first_present("f", ["x", "a", "b"])).first()[0] == "b"
    assert df.select(V.first_present("f", ["x", "a"])).first()[0] is None
