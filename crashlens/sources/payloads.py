"""Landed service payloads: schemas and parsers.

The reference calls route, weather and geocoding services one request at a
time. Here their JSON responses are landed as text columns (one row per
request) and parsed in bulk with ``from_json`` and explicit schemas; all
defaults and fallbacks are column expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlens import constants as K
from crashlens.functions import features as FX

INTERVAL = T.StructType([
    T.StructField("startPolylinePointIndex", T.LongType()),
    T.StructField("endPolylinePointIndex", T.LongType()),
    T.StructField("speed", T.StringType()),
])
LEG = T.StructType([T.StructField("travelAdvisory", T.StructType([
    T.StructField("speedReadingIntervals", T.ArrayType(INTERVAL))]))])
ROUTE = T.StructType([
    T.StructField("duration", T.StringType()),
    T.StructField("distanceMeters", T.LongType()),
    T.StructField("polyline", T.StructType([T.StructField("encodedPolyline", T.StringType())])),
    T.StructField("legs", T.ArrayType(LEG)),
])
ROUTES_PAYLOAD = T.StructType([T.StructField("routes", T.ArrayType(ROUTE))])

WEATHER_PAYLOAD = T.StructType([
    T.StructField("weather", T.ArrayType(T.StructType([
        T.StructField("main", T.StringType()), T.StructField("description", T.StringType())]))),
    T.StructField("main", T.StructType([
        T.StructField("temp", T.DoubleType()), T.StructField("feels_like", T.DoubleType()),
        T.StructField("humidity", T.DoubleType()), T.StructField("pressure", T.DoubleType())])),
    T.StructField("visibility", T.DoubleType()),
    T.StructField("wind", T.StructType([
        T.StructField("speed", T.DoubleType()), T.StructField("deg", T.DoubleType()),
        T.StructField("gust", T.DoubleType())])),
    T.StructField("clouds", T.StructType([T.StructField("all", T.DoubleType())])),
    T.StructField("rain", T.StructType([T.StructField("1h", T.DoubleType())])),
    T.StructField("snow", T.StructType([T.StructField("1h", T.DoubleType())])),
])

GEOCODE_PAYLOAD = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("formatted_address", T.StringType()),
        T.StructField("place_id", T.StringType()),
        T.StructField("geometry", T.StructType([
            T.StructField("location", T.StructType([
                T.StructField("lat", T.DoubleType()), T.StructField("lng", T.DoubleType())])),
            T.StructField("location_type", T.StringType())])),
        T.StructField("address_components", T.ArrayType(T.StructType([
            T.StructField("long_name", T.StringType()),
            T.StructField("types", T.ArrayType(T.StringType()))]))),
    ]))),
])


# ------------------------------------------------------------------ routes

def parse_routes(payloads: DataFrame, json_col: str = "route_json",
                 keys: tuple[str, ...] = ("request_id",)) -> DataFrame:
    """One row per route: position in the payload (0 = default route),
    duration seconds, metres, encoded polyline and the speed intervals of all
    legs in order (missing start/end -> 0, missing speed -> NORMAL). Broken
    routes are left to :func:`rejected_routes`."""
    parsed = payloads.select(*keys, F.from_json(F.col(json_col), ROUTES_PAYLOAD).alias("p"))
    routes = parsed.select(*keys, F.posexplode(F.coalesce(F.col("p.routes"), F.array()))
                           .alias("route_idx", "r"))
    intervals = F.flatten(F.transform(
        F.coalesce(F.col("r.legs"), F.array()),
        lambda leg: F.coalesce(leg["travelAdvisory"]["speedReadingIntervals"],
                               F.array().cast(T.ArrayType(INTERVAL)))))
    intervals = F.transform(intervals, lambda iv: F.struct(
        F.coalesce(iv["startPolylinePointIndex"], F.lit(0)).alias("start"),
        F.coalesce(iv["endPolylinePointIndex"], F.lit(0)).alias("end"),
        F.coalesce(iv["speed"], F.lit("NORMAL")).alias("speed")))
    seconds = FX.duration_seconds(F.col("r.duration"))
    line = F.coalesce(F.col("r.polyline.encodedPolyline"), F.lit(""))
    good = routes.where(_route_fault(seconds, line).isNull())
    return good.select(
        *keys, F.col("route_idx").cast("int").alias("route_idx"),
        seconds.alias("duration_seconds"),
        F.coalesce(F.col("r.distanceMeters"), F.lit(0)).alias("distance_meters"),
        line.alias("encoded_polyline"),
        intervals.alias("intervals"))


def _route_fault(seconds, line):
    """Why a route cannot be used, or null. The polyline test is the format's:
    characters from ? to ~, every number ended, numbers in pairs."""
    ended = F.regexp_replace(line, r"[_-~]*[?-^]", "1")
    sound = line.rlike(r"^(?:[_-~]{0,11}[?-^])*$") & (F.length(ended) % 2 == 0)
    return F.when(seconds.isNull(), F.lit("malformed duration")) \
            .when(~sound, F.lit("malformed polyline"))


def rejected_routes(payloads: DataFrame, json_col: str = "route_json",
                    keys: tuple[str, ...] = ("request_id",)) -> DataFrame:
    """Payloads without a readable route list (route_idx null) and single
    routes that cannot be used, each with its reason."""
    parsed = payloads.select(*keys, F.from_json(F.col(json_col), ROUTES_PAYLOAD).alias("p"))
    unread = parsed.where(F.col("p.routes").isNull()).select(
        *keys, F.lit(None).cast("int").alias("route_idx"), F.lit("no route list").alias("reason"))
    routes = parsed.select(*keys, F.posexplode("p.routes").alias("route_idx", "r"))
    fault = _route_fault(FX.duration_seconds(F.col("r.duration")),
                         F.coalesce(F.col("r.polyline.encodedPolyline"), F.lit("")))
    broken = routes.select(*keys, F.col("route_idx").cast("int").alias("route_idx"), fault.alias("reason")) \
        .where("reason is not null")
    return unread.unionByName(broken)


# ------------------------------------------------------------------ weather

def parse_weather(payloads: DataFrame, json_col: str = "weather_json",
                  keys: tuple[str, ...] = ("request_id",)) -> tuple[DataFrame, DataFrame]:
    """(parsed, rejected). Missing gust / rain / snow / wind / clouds /
    visibility default to 0; an empty condition list gives ``Unknown``; rows
    missing any ``main`` field go to ``rejected`` with a reason."""
    p = payloads.select(*keys, F.col(json_col).alias("raw"),
                        F.from_json(F.col(json_col), WEATHER_PAYLOAD).alias("w"))
    m = F.col("w.main")
    ok = (m.isNotNull() & m["temp"].isNotNull() & m["feels_like"].isNotNull()
          & m["humidity"].isNotNull() & m["pressure"].isNotNull() & F.col("w.weather").isNotNull())
    first = F.get(F.col("w.weather"), 0)
    rain = F.coalesce(F.col("w.rain")["1h"], F.lit(0.0))
    snow = F.coalesce(F.col("w.snow")["1h"], F.lit(0.0))
    whole = lambda c: c.cast("long")  # noqa: E731  towards zero, as int() does
    vis = whole(F.coalesce(F.col("w.visibility"), F.lit(0.0)))
    parsed = p.where(ok).select(
        *keys,
        F.coalesce(first["main"], F.lit("Unknown")).alias("condition"),
        F.coalesce(first["description"], F.lit("unknown")).alias("description"),
        m["temp"].alias("temperature_f"), m["feels_like"].alias("feels_like_f"),
        whole(m["humidity"]).alias("humidity_pct"), whole(m["pressure"]).alias("pressure_hpa"),
        vis.alias("visibility_meters"),
        F.coalesce(F.col("w.wind.speed"), F.lit(0.0)).alias("wind_speed_mph"),
        whole(F.coalesce(F.col("w.wind.deg"), F.lit(0.0))).alias("wind_direction_deg"),
        F.coalesce(F.col("w.wind.gust"), F.lit(0.0)).alias("wind_gust_mph"),
        whole(F.coalesce(F.col("w.clouds.all"), F.lit(0.0))).alias("clouds_pct"),
        rain.alias("rain_1h_mm"), snow.alias("snow_1h_mm"),
        FX.is_precipitation(rain, snow).alias("is_precipitation"),
        FX.is_low_visibility(vis).alias("is_low_visibility"))
    rejected = p.where(~ok).select(*keys, "raw",
                                   F.lit("missing weather or main fields").alias("reason"))
    return parsed, rejected


# ------------------------------------------------------------------ geocoding

def parse_reverse_geocode(payloads: DataFrame, json_col: str = "geocode_json",
                          keys: tuple[str, ...] = ("lat", "lng")) -> DataFrame:
    """Street (first ``route`` component), neighbourhood (first component of
    the neighbourhood types) and a short label that falls back street+hood ->
    street -> hood -> formatted address -> ``"lat, lng"`` (4 places). Non-OK
    statuses and empty results give nulls."""
    p = payloads.select(*keys, F.from_json(F.col(json_col), GEOCODE_PAYLOAD).alias("g"))
    ok = (F.col("g.status") == "OK") & (F.size(F.col("g.results")) > 0)
    res = F.get(F.col("g.results"), 0)
    comps = F.coalesce(res["address_components"], F.array())

    def first_of(types: list[str]):
        hit = F.filter(comps, lambda c: F.exists(
            F.coalesce(c["types"], F.array().cast("array<string>")),
            lambda t: t.isin(*types)))
        return F.get(hit, 0)["long_name"]

    street = first_of(["route"])
    hood = first_of(list(K.NEIGHBOURHOOD_TYPES))
    coords = F.concat(FX.format_fixed(F.col(keys[0]), 4), F.lit(", "), FX.format_fixed(F.col(keys[1]), 4))
    label = (F.when(street.isNotNull() & hood.isNotNull(), F.concat_ws(", ", street, hood))
             .when(street.isNotNull(), street).when(hood.isNotNull(), hood)
             .otherwise(F.coalesce(res["formatted_address"], coords)))
    return p.select(*keys,
                    F.when(ok, street).alias("street_name"),
                    F.when(ok, hood).alias("neighborhood"),
                    F.when(ok, label).alias("short_label"),
                    F.when(ok, F.coalesce(res["formatted_address"], F.lit(""))).alias("formatted_address"))


def parse_geocode(payloads: DataFrame, json_col: str = "geocode_json",
                  keys: tuple[str, ...] = ("address",)) -> DataFrame:
    """Forward geocode: first result's location, address, place id and
    location type; ``status`` kept so callers can route failures."""
    p = payloads.select(*keys, F.from_json(F.col(json_col), GEOCODE_PAYLOAD).alias("g"))
    res = F.get(F.col("g.results"), 0)
    ok = (F.col("g.status") == "OK") & res.isNotNull()
    return p.select(*keys, F.col("g.status").alias("status"),
                    F.when(ok, res["geometry"]["location"]["lat"]).alias("lat"),
                    F.when(ok, res["geometry"]["location"]["lng"]).alias("lng"),
                    F.when(ok, res["formatted_address"]).alias("formatted_address"),
                    F.when(ok, res["place_id"]).alias("place_id"),
                    F.when(ok, res["geometry"]["location_type"]).alias("location_type"))
