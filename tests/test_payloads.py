"""Broken payloads never stop a job: they are rejected with a reason."""

import json

from pyspark.sql import functions as F

from crashlens.functions import polyline
from crashlens.operators import routes
from crashlens.sources import payloads


def _route(duration="60s", line="_p~iF~ps|U_ulLnnqC"):
    return {"duration": duration, "distanceMeters": 900, "polyline": {"encodedPolyline": line}}


def test_broken_routes_are_rejected(spark):
    good = "_p~iF~ps|U_ulLnnqC"
    rows = [(1, json.dumps({"routes": [_route(), _route("717.5s"), _route("abc")]})),
            (2, json.dumps({"routes": [_route(line=good[:-1]), _route(line="_p~iF"), _route(line="€"), _route(line="")]})),
            (3, "oops"), (4, None), (5, "{}")]
    df = spark.createDataFrame(rows, "request_id long, route_json string")
    bad = {(r["request_id"], r["route_idx"], r["reason"]) for r in payloads.rejected_routes(df).collect()}
    assert bad == {(1, 1, "malformed duration"), (1, 2, "malformed duration"), (2, 0, "malformed polyline"),
                   (2, 1, "malformed polyline"), (2, 2, "malformed polyline"), (3, None, "no route list"),
                   (4, None, "no route list"), (5, None, "no route list")}
    table = {(r["request_id"], r["route_idx"]): r["num_points"]
             for r in routes.route_table(payloads.parse_routes(df)).collect()}
    assert table == {(1, 0): 2, (2, 3): 0}


def test_polyline_batch_round_trip(spark):
    lists = [[(38.5, -120.2), (40.7, -120.95), (43.252, -126.453)], [], [(0.0, 0.0)], [(-0.000015, 179.99999)]]
    assert polyline.encode(lists[0]) == "_p~iF~ps|U_ulLnnqC_mqNvxq`@"
    df = spark.createDataFrame([(i, [{"lat": a, "lng": b} for a, b in p]) for i, p in enumerate(lists)],
                               "i int, p array<struct<lat: double, lng: double>>").coalesce(1)
    got = df.select("i", polyline.decode_polyline(polyline.encode_polyline(F.col("p"))).alias("p")).collect()
    for r in got:
        want = [(round(a * 1e5 + (1e-9 if a > 0 else -1e-9)) / 1e5, round(b * 1e5) / 1e5) for a, b in lists[r["i"]]]
        assert [(x["lat"], x["lng"]) for x in r["p"]] == want


def test_weather_numbers_are_truncated(spark):
    text = json.dumps({"weather": [{"main": "Rain", "description": "x"}], "visibility": 9000.9,
                       "main": {"temp": 1, "feels_like": 2.5, "humidity": 40.0, "pressure": 1012.5},
                       "wind": {"speed": 1, "deg": 99.9}, "clouds": {"all": 75.0}})
    ok, bad = payloads.parse_weather(spark.createDataFrame([(1, text)], "request_id long, weather_json string"))
    r = ok.first()
    assert bad.count() == 0 and (r["visibility_meters"], r["humidity_pct"], r["pressure_hpa"]) == (9000, 40, 1012)
    assert (r["wind_direction_deg"], r["clouds_pct"], r["is_low_visibility"]) == (99, 75, False)
