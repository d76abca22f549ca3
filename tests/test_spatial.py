"""Radius join against brute force on hand-made points: empty neighbourhood,
self only, co-located crashes, distances just under and over each radius,
and a hot cell split into salts."""

import math
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from crashlens import constants as K
from crashlens.operators import spatial

R = K.EARTH_RADIUS_M


def hav(a, b):
    p1, p2 = math.radians(a[0]), math.radians(b[0])
    s1 = math.sin((p2 - p1) / 2)
    s2 = math.sin((math.radians(b[1]) - math.radians(a[1])) / 2)
    x = s1 * s1 + math.cos(p1) * math.cos(p2) * (s2 * s2)
    return 2 * R * math.asin(math.sqrt(min(x, 1.0)))


def brute(query, hist, loo):
    out = {}
    for qid, qlat, qlon, qsev in query:
        n1 = f1 = i1 = n5 = f5 = 0
        s1 = 0.0
        for hid, hlat, hlon, hsev in hist:
            if loo and hid == qid:
                continue
            d = hav((qlat, qlon), (hlat, hlon))
            if d <= 1000:
                n1 += 1
                f1 += hsev == "High"
                i1 += hsev == "Medium"
                s1 += K.SEVERITY_SCORE[hsev]
            if d <= 500:
                n5 += 1
                f5 += hsev == "High"
        out[qid] = (n1, f1, i1, n5, f5, round(s1 / n1, 9) if n1 else 0.0)
    return out


def _offset(lat, lon, metres_north):
    return lat + math.degrees(metres_north / R), lon


def fixture_points():
    base = (42.35, -71.06)
    pts = [(1, *base, "Low"), (2, *base, "High"), (3, *base, "Medium")]  # co-located
    for i, m in enumerate([499.9, 500.1, 999.9, 1000.1]):                 # radius edges
        lat, lon = _offset(*base, m)
        pts.append((10 + i, lat, lon, ["Low", "High", "Medium", "High"][i]))
    pts.append((20, 42.5, -71.5, "Medium"))                                 # isolated
    rnd = random.Random(7)
    for i in range(200):                                                    # a dense blob
        pts.append((100 + i, 42.35 + rnd.uniform(-0.01, 0.01), -71.06 + rnd.uniform(-0.013, 0.013),
                    rnd.choice(["Low", "Low", "Medium", "High"])))
    return pts


def _run(spark, query, hist, loo, **grid):
    schema = "crash_id long, lat double, lon double, severity_class string"
    q = spark.createDataFrame(query, schema)
    h = spark.createDataFrame(hist, schema)
    res = spatial.neighbourhood_features(q, h, leave_one_out=loo, **grid).collect()
    return {r["crash_id"]: (r["nearby_crash_count_1km"], r["nearby_fatal_count_1km"],
                            r["nearby_injury_count_1km"], r["nearby_crash_count_500m"],
                            r["nearby_fatal_count_500m"], round(r["nearby_avg_severity_1km"], 9))
            for r in res}


def test_leave_one_out_matches_brute_force(spark):
    pts = fixture_points()
    assert _run(spark, pts, pts, True) == brute(pts, pts, True)


def test_held_out_and_hot_cells(spark):
    pts = fixture_points()
    query, hist = pts[::3], pts[1::3] + pts[2::3]
    want = brute(query, hist, False)
    assert _run(spark, query, hist, False) == want
    # force every non-empty cell to be split into salts
    assert _run(spark, query, hist, False, max_cell_locations=2) == want
    # coarser and finer grids give the same answer: with 1 cell per radius
    # almost everything is joined point by point, with 16 or 40 most of the
    # dense blob comes from whole-cell sums
    for m in (1, 2, 5, 16, 40):
        assert _run(spark, query, hist, False, cells_per_radius=m) == want, m


def test_leave_one_out_fine_grids(spark):
    pts = fixture_points()
    want = brute(pts, pts, True)
    for m in (3, 24):
        assert _run(spark, pts, pts, True, cells_per_radius=m) == want, m


def test_random_points_many_grids(spark):
    # random points at several latitudes, including close to a pole and
    # across the antimeridian, against brute force
    rnd = random.Random(11)
    pts = []
    for centre in ((42.35, -71.06), (-33.9, 151.2), (0.0, 179.995), (89.995, 10.0), (-89.996, -120.0)):
        for _ in range(60):
            lat = max(-90.0, min(90.0, centre[0] + rnd.uniform(-0.012, 0.012)))
            lon = centre[1] + rnd.uniform(-0.02, 0.02)
            lon = (lon + 180.0) % 360.0 - 180.0
            pts.append((len(pts), lat, lon, rnd.choice(["Low", "Medium", "High"])))
    want = brute(pts, pts, True)
    for m in (2, 7, 20):
        assert _run(spark, pts, pts, True, cells_per_radius=m) == want, m


def test_edges(spark):
    pts = fixture_points()
    got = _run(spark, pts, pts, True)
    assert got[20] == (0, 0, 0, 0, 0, 0.0)          # empty neighbourhood
    assert got[1][0] >= 2                             # co-located others still count
    assert all(v[3] <= v[0] for v in got.values())    # 500 m within 1 km


def test_summary_runs(spark):
    pts = fixture_points()
    schema = "crash_id long, lat double, lon double, severity_class string"
    df = spark.createDataFrame(pts, schema)
    enr = spatial.neighbourhood_features(df, df, leave_one_out=True) \
        .withColumn("severity_score", F.when(F.col("severity_class") == "High", 2.0)
                    .when(F.col("severity_class") == "Medium", 1.0).otherwise(0.0))
    rows = spatial.feature_summary(enr).collect()
    assert {r["feature"] for r in rows} == set(K.SPATIAL_COLS)


def test_grid_resolution_follows_density(spark):
    # sparse: points about 10 km apart -> the coarsest grid
    sparse = spark.range(50).select(
        (F.lit(42.0) + (F.col("id") % 7) * F.lit(0.1)).alias("lat"),
        (F.lit(-71.0) + (F.col("id") / 7).cast("int") * F.lit(0.13)).alias("lon"))
    assert spatial.auto_cells_per_radius(sparse) == 2
    # dense: 5,000 distinct locations within about 1 km^2 -> a finer grid
    dense = spark.range(5000).select(
        (F.lit(42.35) + (F.col("id") % 71) * F.lit(1e-4)).alias("lat"),
        (F.lit(-71.06) + (F.col("id") / 71).cast("int") * F.lit(1.3e-4)).alias("lon"))
    m = spatial.auto_cells_per_radius(dense)
    assert 4 <= m <= 32


def test_query_locations_stay_single_rows(spark):
    # a dense square kilometre: each circle meets thousands of locations
    n = 4000
    dense = spark.range(n).select((F.lit(42.35) + F.pmod(F.col("id") * 7919, F.lit(n)) * F.lit(9e-3 / n)).alias("lat"),
                                  (F.lit(-71.06) + F.col("id") * F.lit(1.2e-2 / n)).alias("lon"),
                                  F.lit("Low").alias("severity_class"))
    locations = spatial.history_locations(dense)
    sums = spatial.location_features(locations.select("lat", "lon"), locations)
    plan = sums._jdf.queryExecution().optimizedPlan().toString()
    # only history is laid out, over the tiles its circle meets: bands and cells
    assert plan.count("Generate explode") == 2
    rows = {r["lat"]: r for r in sums.collect()}
    assert len(rows) == n
    points = [(r["lat"], r["lon"]) for r in locations.select("lat", "lon").collect()]
    for p in points[::400]:
        assert rows[p[0]]["n_big"] == sum(hav(p, q) <= 1000 for q in points)
        assert rows[p[0]]["n_small"] == sum(hav(p, q) <= 500 for q in points)


def test_squares_of_queries_equal_single_ones(monkeypatch):
    rnd = np.random.default_rng(5)
    lat, lon = 42.3 + rnd.uniform(0, 0.03, 12_000), -71.1 + rnd.uniform(0, 0.04, 12_000)
    # pairs just at the radii, and co-located rows
    edge = [_offset(lat[0], lon[0], m) for m in (499.9999999, 500, 500.0000001, 999.9999999, 1000, 1000.0000001)]
    lat, lon = np.r_[lat, [p[0] for p in edge]], np.r_[lon, [p[1] for p in edge]]
    n = len(lat)
    hist = pd.DataFrame({"hlat": lat, "hlng": lon, "h_n": rnd.integers(1, 4, n), "h_fatal": rnd.integers(0, 2, n),
                         "h_injury": rnd.integers(0, 2, n), "h_score": rnd.integers(0, 5, n).astype(float)})
    query = pd.DataFrame({"lat": np.r_[lat, lat[:500] + 1e-4], "lng": np.r_[lon, lon[:500]]})
    tiles = spatial._tile_sums(1000.0, 500.0, None, 4.0)
    got, tested = tiles(query, hist), []
    square_sums = spatial._Tile._by_squares
    monkeypatch.setattr(spatial._Tile, "_by_squares", lambda *a: tested.append(a[3]) or square_sums(*a))
    assert got.equals(tiles(query, hist)) and tested == [1000.0, 500.0]  # dense enough for squares
    monkeypatch.setattr(spatial, "_square_side", lambda *a: None)
    assert got.equals(tiles(query, hist)) and len(tested) == 2 and len(got) == n + 500
    # a fraction is no sum of 32 bits
    hist["h_score"] += 1e-9
    single = tiles(query, hist)
    monkeypatch.undo()
    assert np.allclose(tiles(query, hist)["score_big"], single["score_big"], rtol=0, atol=1e-9)
