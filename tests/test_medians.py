"""Exact medians by rank selection."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from crashlens.operators import cleaning
from crashlens.plans import features as PF
from crashlens.sources.tables import crashes


def test_many_distinct_doubles(spark):
    n = 2_000_000
    df = spark.range(n).select((F.pmod(F.col("id") * 7919, F.lit(n)) / 3.0).alias("a"),
                               F.exp(F.pmod(F.col("id") * 104729, F.lit(n)) / 50000.0 - 20).alias("b"))
    got = cleaning.medians(df, ["a", "b"])
    assert got["a"] == ((n - 1) // 2 / 3.0) + ((n // 2 / 3.0) - ((n - 1) // 2 / 3.0)) * 0.5
    low, high = (math.exp(k / 50000.0 - 20) for k in ((n - 1) // 2, n // 2))
    assert got["b"] == pytest.approx((low + high) / 2, rel=1e-12)


def test_awkward_values(spark):
    rng = random.Random(3)
    cases = {
        "ties": [5.0] * 7 + [1.0] * 3, "even": [1.0, 2.0], "one": [-3.5], "signs": [-1e300, -1e-300, 0.0, 1e-300, 1e300],
        "wide": [math.ldexp(rng.random() - 0.5, rng.randint(-1000, 1000)) for _ in range(501)],
        "close": [1.0 + k * 2.0 ** -52 for k in range(1000)], "apart": [1.0] * 5 + [1e9] * 5,
        "denormal": [5e-324 * k for k in range(9)], "infinite": [float("-inf"), 1.0, float("inf")],
    }
    rows = [(g, x) for g, xs in cases.items() for x in [*xs, None, float("nan")]] + [(None, 4.0), (None, 8.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    got = cleaning.grouped_medians(df, ["x"], by="g")
    want = {g: statistics.median(xs) for g, xs in cases.items()} | {None: 6.0}
    assert set(got) == {(g, "x") for g in want}  # a group without a value has no median
    for g, value in want.items():
        assert got[(g, "x")] == pytest.approx(value, rel=1e-15), g


def test_empty_and_clashing_names(spark):
    df = spark.createDataFrame([], "g int, c double, x double")
    assert cleaning.medians(df, ["x", "c"]) == {"x": None, "c": None}
    df = spark.createDataFrame([(1, 2.0, 3.0), (1, 4.0, 9.0)], "g int, c double, x double")
    assert cleaning.medians(df, ["c", "x", "g"]) == {"c": 3.0, "x": 6.0, "g": 1.0}


def test_builders_hold_no_percentile(spark, capsys):
    for built in (PF.build_v1, PF.build_v2):
        built(crashes(spark, SF_SMALL)).df.explain("extended")
    assert "percentile" not in capsys.readouterr().out.lower()
