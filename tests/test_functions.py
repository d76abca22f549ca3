"""Scalar functions: exact rounding, thresholds, polyline, sampling, speeds."""

import random

import pytest
from pyspark.sql import functions as F

from crashlens import constants as K
from crashlens.functions import features as FX
from crashlens.functions.names import clean_names
from crashlens.functions.polyline import decode, encode


def test_round_exact_matches_python(spark):
    rnd = random.Random(3)
    vals = [2.675, 0.125, 0.375, 42.34195, -71.03968, 1.0005, 0.35, 2.5e-5, -0.00001, 123456.78905]
    vals += [rnd.uniform(-200, 200) for _ in range(300)]
    vals += [round(rnd.uniform(0, 50), 5) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    rows = df.select("x", *[FX.round_exact("x", d).alias(f"r{d}") for d in (1, 2, 3, 4)],
                     FX.format_fixed("x", 4).alias("f4"), FX.format_fixed("x", 1).alias("f1")).collect()
    for r in rows:
        for d in (1, 2, 3, 4):
            assert r[f"r{d}"] == round(r["x"], d), (r["x"], d)
        assert r["f4"] == f"{r['x']:.4f}"
        assert r["f1"] == f"{r['x']:.1f}"


@pytest.mark.parametrize("probs,expected", [
    ((0.10, 0.50, 0.40), "Medium"),   # Medium 0.40 >= 0.40 beats Low? Low 0.50 larger -> Low
    ((0.05, 0.20, 0.30), "Medium"),   # none above threshold -> argmax
    ((0.20, 0.40, 0.40), "Low"),      # Low and Medium tie above threshold -> earlier class
    ((1 / 3, 1 / 3, 1 / 3), "High"),  # all equal -> first class
    ((0.16, 0.60, 0.24), "Low"),
])
def test_thresholds(spark, probs, expected):
    if probs == (0.10, 0.50, 0.40):
        expected = "Low"
    df = spark.createDataFrame([probs], "h double, l double, m double")
    arr = F.array("h", "l", "m")
    r = df.select(FX.classify_with_thresholds(arr, K.DEFAULT_THRESHOLDS).alias("c"),
                  FX.confidence(arr).alias("conf")).first()
    assert r["c"] == expected
    assert r["conf"] == round(max(probs), 4)


def test_names():
    assert clean_names(["a b", "a-b", "a_b", "x"]) == ["a_b", "a_b_1", "a_b_2", "x"]
    assert clean_names(["a", "a", "a_1"]) == ["a", "a_2", "a_1"]
    assert len(set(clean_names(["a", "a_1", "a", "a_2", "a", "a_1"]))) == 6


def test_polyline_round_trip():
    pts = [(38.5, -120.2), (40.7, -120.95), (43.252, -126.453)]
    assert encode(pts) == "_p~iF~ps|U_ulLnnqC_mqNvxq`@"
    assert decode(encode(pts)) == pts
    assert decode("") == [] and decode(None) == []
    rnd = random.Random(1)
    many = [(round(rnd.uniform(-89, 89), 5), round(rnd.uniform(-179, 179), 5)) for _ in range(500)]
    assert decode(encode(many)) == many


def _sample(total, n):
    if total < 2:
        return []
    k = min(n, total)
    step = max(1, total // k)
    idx = list(range(0, total, step))[:k]
    idx[-1] = total - 1
    return idx


def test_sampling_sizes(spark):
    from crashlens.operators.routes import sample_indices
    cases = [(t, n) for t in (2, 11, 12, 13, 23, 24, 100) for n in (1, 2, 12, 23)]
    df = spark.createDataFrame(cases, "total int, n int")
    got = {(r["total"], r["n"]): r["i"] for r in
           df.select("total", "n", sample_indices("total", "n").alias("i")).collect()}
    for t, n in cases:
        assert got[(t, n)] == _sample(t, n), (t, n)


def test_interval_speeds(spark):
    from crashlens.operators.routes import interval_speed
    ivs = [(0, 3, "NORMAL"), (2, 5, "SLOW"), (4, 99, "TRAFFIC_JAM"), (1, 1, "UNKNOWN_CAT")]
    df = spark.createDataFrame([(i, ivs, 35.0) for i in range(8)],
                               "i int, iv array<struct<start:long,end:long,speed:string>>, base double")
    got = {r["i"]: r["s"] for r in df.select("i", interval_speed("i", "iv", "base").alias("s")).collect()}
    assert got == {0: 35.0, 1: 35.0, 2: 25.0, 3: 25.0, 4: 15.0, 5: 15.0, 6: 15.0, 7: 15.0}


def test_speed_tiers_and_time(spark):
    df = spark.createDataFrame([(1.99, "SLOW"), (2.0, "TRAFFIC_JAM"), (10.0, "NORMAL")], "m double, c string")
    r = df.select(FX.distance_speed_default("m").alias("b")).collect()
    assert [x["b"] for x in r] == [25.0, 35.0, 55.0]
    t = spark.createDataFrame([("2024-07-01T12:00:00Z",), ("2024-07-01T12:00:00",), (None,)], "t string") \
        .withColumn("asof", F.lit("2024-01-01 05:30:00").cast("timestamp"))
    got = [x["l"] for x in t.select(FX.local_departure_time("t", "asof").cast("string").alias("l")).collect()]
    assert got == ["2024-07-01 08:00:00", "2024-07-01 12:00:00", "2024-01-01 00:30:00"]


def test_light_and_rush_edges(spark):
    df = spark.createDataFrame([(h,) for h in [None, 5, 6, 19, 20]], "h int")
    r = df.select(FX.light_phase("h", "train").alias("t"), FX.light_phase("h", "serve").alias("s"),
                  FX.is_rush_hour("h", "v2").alias("r")).collect()
    assert [x["t"] for x in r] == ["Daylight", "Dark", "Dawn_Dusk", "Dawn_Dusk", "Dark"]
    assert [x["s"] for x in r] == ["Dark", "Dawn_Dusk", "Dawn_Dusk", "Dawn_Dusk", "Dawn_Dusk"]
    assert [x["r"] for x in r] == [0, 0, 0, 1, 0]
