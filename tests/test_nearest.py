"""Nearest places against brute force."""

import math
import random

import pytest

from crashlens import constants as K
from crashlens.operators import nearest


def _metres(a, b):
    s1, s2 = (math.sin((math.radians(b[i]) - math.radians(a[i])) / 2) for i in (0, 1))
    h = s1 * s1 + math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * (s2 * s2)
    return 2 * K.EARTH_RADIUS_M * math.asin(math.sqrt(min(h, 1.0)))


def _spread(rng, n, centre, degrees):
    return [(max(-90.0, min(90.0, centre[0] + rng.uniform(-degrees, degrees))),
             (centre[1] + rng.uniform(-degrees, degrees) + 540.0) % 360.0 - 180.0) for _ in range(n)]


@pytest.mark.parametrize("centre, degrees, radius", [
    ((42.3, -71.1), 0.05, 1000.0), ((0.0, 179.99), 0.05, 3000.0), ((89.9, 10.0), 0.1, 20000.0), ((-60.0, -180.0), 0.3, 9000.0)])
def test_equals_brute_force(spark, centre, degrees, radius):
    rng = random.Random(7)
    places = _spread(rng, 300, centre, degrees)
    places += [(centre[0] * 0.999, centre[1])] * 200 + _spread(rng, 200, (centre[0] * 0.999, centre[1]), degrees / 50)
    points = _spread(rng, 200, centre, degrees * 1.5) + places[:5] + [(None, 1.0), (1.0, None)]
    got = nearest.nearest_places(
        spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, lat double, lng double"),
        spark.createDataFrame([(*p, f"place {k}") for k, p in enumerate(places)], "lat double, lng double, name string"),
        ["name"], radius).collect()
    assert len(got) == len(points)
    for r in got:
        point = points[r["id"]]
        near = [] if None in point else sorted((round(_metres(point, p), 6), *p) for p in set(places)
                                               if _metres(point, p) <= radius)
        if not near:
            assert r["place_m"] is None and r["name"] is None
        else:
            assert r["place_m"] == pytest.approx(near[0][0], abs=2e-6)
            assert _metres(point, (r["place_lat"], r["place_lng"])) == pytest.approx(near[0][0], abs=2e-6)
            assert r["name"] == min(f"place {k}" for k, p in enumerate(places) if p == (r["place_lat"], r["place_lng"]))


def test_awkward_tables(spark):
    schema = "id int, lat double, lng double"
    point = spark.createDataFrame([(1, 0.0, 0.0), (1, 0.0, 0.0)], schema)
    none = spark.createDataFrame([], "lat double, lng double, name string")
    assert [r["name"] for r in nearest.nearest_places(point, none, ["name"]).collect()] == [None, None]
    places = spark.createDataFrame([(0.0, 0.001, "east"), (0.0, -0.001, "west"), (None, 0.0, "nowhere")],
                                   "lat double, lng double, name string")
    got = nearest.nearest_places(point, places, ["name"]).collect()
    assert [r["name"] for r in got] == ["west", "west"]  # the smaller longitude on equal distance
    assert nearest.nearest_places(point.limit(0), places, ["name"]).count() == 0
    with pytest.raises(ValueError, match="name"):
        nearest.nearest_places(point.withColumnRenamed("id", "name"), places, ["name"])


def test_staged_tables_are_not_broadcast(spark, monkeypatch):
    # compressed files of tables that are far larger in memory look small
    plans, real = [], nearest.stage_table
    monkeypatch.setattr(nearest, "stage_table", lambda d, name: plans.append(_plan(d)) or real(d, name))
    points = spark.range(300).selectExpr("id", "42.0 + id * 1e-4 as lat", "-71.0 + id * 1e-4 as lng")
    places = points.selectExpr("lat + 2e-5 as lat", "lng", "'street' as name")
    out = nearest.nearest_places(points, places, ["name"])
    assert out.where("name = 'street'").count() == 300
    assert not any("BroadcastHashJoin" in p for p in [*plans, _plan(out)])


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
