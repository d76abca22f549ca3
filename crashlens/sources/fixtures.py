"""Route-side inputs derived from the driver tables.

The reference reads route, weather and geocoding responses from live
services. Here they are landed payload tables that Spark derives from
``events`` (points = the derived crash locations of each user's events), so
every route query grows with the data:

* requests: ``request_id`` = user, departure text (zoned, naive or missing),
  an ``as_of`` time for missing departures, and the number of segments.
* routes: a user's located events split by ``event_id % 3`` into routes
  (position in the payload = route index), points ordered by (ts, event_id),
  encoded as a polyline; distance, duration and traffic intervals by formula.
  The rule is the same at every size; a route holds the points of one user.
* weather: one payload per request, conditions and fields by formula, with
  empty condition lists, missing optional fields and rejected rows.
* reverse geocode: one payload per distinct route point.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlens.functions.polyline import encode_polyline
from crashlens.sources.tables import CRASH_EXPRS, crashes, load_table

_LATLON = [e for e in CRASH_EXPRS if e.endswith(" AS lat") or e.endswith(" AS lon")]
WEATHER_CONDITIONS = ["Clear", "Clouds", "Rain", "Drizzle", "Snow", "Mist", "Thunderstorm", "Haze",
                      "Squall", "Volcano"]


def route_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(request_id, route_key, event_id, ts, lat, lng) for located events."""
    ev = load_table(spark, sf_dir, "events")
    return (ev.selectExpr("event_id", "user_id", "ts", *_LATLON).where("lat IS NOT NULL")
            .select(F.col("user_id").alias("request_id"),
                    F.pmod(F.col("event_id"), F.lit(3)).cast("int").alias("route_key"),
                    "event_id", "ts", "lat", F.col("lon").alias("lng")))


def _legs(n, rid, rkey):
    """Traffic intervals by formula: none, two legs (the later overwrites), or
    one leg with overlapping intervals and one running past the last point."""
    def iv(s, e, speed):
        return F.struct(s.cast("long").alias("startPolylinePointIndex"),
                        e.cast("long").alias("endPolylinePointIndex"), speed.alias("speed"))
    third = (n / 3).cast("long")
    two3 = (n * 2 / 3).cast("long")
    first_speed = F.when(F.pmod(rid, F.lit(5)) == 2, F.lit(None).cast("string")).otherwise(F.lit("NORMAL"))
    last_speed = F.when(F.pmod(rkey, F.lit(3)) == 2, F.lit("TRAFFIC_JAM")).otherwise(F.lit("SLOW"))
    main = F.array(iv(F.lit(0), third, first_speed), iv(third, two3, F.lit("SLOW")),
                   iv(two3 - 1, n + 1, last_speed))
    leg = lambda ivs: F.struct(F.struct(ivs.alias("speedReadingIntervals")).alias("travelAdvisory"))
    second = F.array(iv(F.lit(0), F.lit(1), F.lit("TRAFFIC_JAM")))
    kind = F.pmod(rid, F.lit(4))
    return (F.when(kind == 0, F.array().cast("array<struct<travelAdvisory:struct<speedReadingIntervals:"
                                            "array<struct<startPolylinePointIndex:bigint,"
                                            "endPolylinePointIndex:bigint,speed:string>>>>>"))
            .when(kind == 1, F.array(leg(main), leg(second)))
            .otherwise(F.array(leg(main))))


def route_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per request: request columns plus the routes payload JSON."""
    pts = route_points(spark, sf_dir)
    per_route = (pts.groupBy("request_id", "route_key")
                 .agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", "lat", "lng"))).alias("p"),
                      F.min("ts").alias("t0"), F.max("ts").alias("t1")))
    rid, rkey = F.col("request_id"), F.col("route_key")
    n = F.size("p")
    route = F.struct(
        F.concat((F.lit(60) + F.pmod(rid * 37 + rkey * 101, F.lit(3000))).cast("string"), F.lit("s"))
        .alias("duration"),
        (F.lit(400) + F.pmod(rid * 131 + rkey * 977, F.lit(20000))).cast("long").alias("distanceMeters"),
        F.struct(encode_polyline(F.transform("p", lambda x: F.struct(x["lat"].alias("lat"),
                                                                     x["lng"].alias("lng"))))
                 .alias("encodedPolyline")).alias("polyline"),
        _legs(n, rid, rkey).alias("legs"))
    per_route = per_route.select("request_id", "route_key", "t0", "t1", route.alias("route"))
    req = (per_route.groupBy("request_id")
           .agg(F.array_sort(F.collect_list(F.struct("route_key", "route"))).alias("rs"),
                F.min("t0").alias("dep"), F.max("t1").alias("last_ts")))
    dep_text = (F.when(F.pmod(rid, F.lit(7)) == 3, F.lit(None).cast("string"))
                .when(F.pmod(rid, F.lit(2)) == 0, F.date_format("dep", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
                .otherwise(F.date_format("dep", "yyyy-MM-dd'T'HH:mm:ss")))
    nseg = (F.when(F.pmod(rid, F.lit(6)) == 1, F.lit(2)).when(F.pmod(rid, F.lit(6)) == 2, F.lit(23))
            .otherwise(F.lit(12)))
    return req.select(
        "request_id", dep_text.alias("departure_time"),
        F.col("last_ts").cast("timestamp").alias("as_of"), nseg.alias("num_segments"),
        F.to_json(F.struct(F.transform("rs", lambda x: x["route"]).alias("routes"))).alias("route_json"))


def weather_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One weather payload per request (request ids from the route payloads)."""
    reqs = route_points(spark, sf_dir).select("request_id").distinct()
    r = F.col("request_id")
    cond = F.element_at(F.array(*[F.lit(c) for c in WEATHER_CONDITIONS]),
                        (F.pmod(r, F.lit(len(WEATHER_CONDITIONS))) + 1).cast("int"))
    temp = (F.lit(20) + F.pmod(r, F.lit(60))).cast("double")
    weather = F.when(F.pmod(r, F.lit(13)) == 5, F.array().cast("array<struct<main:string,description:string>>")) \
               .otherwise(F.array(F.struct(cond.alias("main"), F.lower(cond).alias("description"))))
    main = F.when(F.pmod(r, F.lit(17)) == 3, F.lit(None)).otherwise(F.struct(
        temp.alias("temp"), (temp - 3).alias("feels_like"),
        (F.lit(30) + F.pmod(r, F.lit(70))).cast("long").alias("humidity"),
        (F.lit(1000) + F.pmod(r, F.lit(30))).cast("long").alias("pressure")))
    payload = F.struct(
        weather.alias("weather"), main.alias("main"),
        F.when(F.pmod(r, F.lit(4)) == 0, F.lit(None)).otherwise(F.lit(1000) * F.pmod(r, F.lit(11)))
        .cast("long").alias("visibility"),
        F.struct((F.pmod(r, F.lit(20)).cast("double") * 1.5).alias("speed"),
                 F.pmod(r * 7, F.lit(360)).cast("long").alias("deg"),
                 F.when(F.pmod(r, F.lit(3)) == 0, F.lit(None).cast("double")).otherwise(F.lit(2.5))
                 .alias("gust")).alias("wind"),
        F.struct(F.pmod(r, F.lit(100)).cast("long").alias("all")).alias("clouds"),
        F.when(cond.isin("Rain", "Drizzle") & (F.pmod(r, F.lit(13)) != 5),
               F.struct(F.lit(0.5).alias("1h"))).alias("rain"),
        F.when((cond == "Snow") & (F.pmod(r, F.lit(13)) != 5),
               F.struct(F.lit(1.2).alias("1h"))).alias("snow"))
    return reqs.select("request_id", F.to_json(payload).alias("weather_json"))


def quantised(col):
    """Coordinate as stored by the polyline format (1e-5, half away from zero)."""
    x = F.col(col) * F.lit(1e5) if isinstance(col, str) else col * F.lit(1e5)
    return F.signum(x) * F.floor(F.abs(x) + F.lit(0.5)) / F.lit(1e5)


def geocode_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reverse-geocode payload per distinct (quantised) route point."""
    pts = route_points(spark, sf_dir)
    locs = (pts.select(quantised("lat").alias("lat"), quantised("lng").alias("lng"), "event_id")
            .groupBy("lat", "lng").agg(F.min("event_id").alias("k")))
    k = F.col("k")
    street = F.when(F.pmod(k, F.lit(5)) != 0, F.struct(
        F.concat(F.lit("Street "), F.pmod(k, F.lit(40)).cast("string")).alias("long_name"),
        F.array(F.lit("route")).alias("types")))
    hood = (F.when(F.pmod(k, F.lit(3)) == 0, F.struct(F.lit("Back Bay").alias("long_name"),
                                                        F.array(F.lit("neighborhood"), F.lit("political"))
                                                        .alias("types")))
            .when(F.pmod(k, F.lit(3)) == 1, F.struct(F.lit("Allston").alias("long_name"),
                                                      F.array(F.lit("sublocality_level_1"),
                                                              F.lit("sublocality")).alias("types"))))
    city = F.struct(F.lit("Boston").alias("long_name"),
                    F.array(F.lit("locality"), F.lit("political")).alias("types"))
    comps = F.filter(F.array(street, hood, city), lambda c: c.isNotNull())
    result = F.struct(
        F.when(F.pmod(k, F.lit(11)) != 0,
               F.concat(k.cast("string"), F.lit(" Harbor Rd, Boston, MA"))).alias("formatted_address"),
        F.concat(F.lit("place-"), k.cast("string")).alias("place_id"),
        F.struct(F.struct(F.col("lat").alias("lat"), F.col("lng").alias("lng")).alias("location"),
                 F.lit("ROOFTOP").alias("location_type")).alias("geometry"),
        comps.alias("address_components"))
    zero = F.pmod(k, F.lit(19)) == 0
    payload = F.struct(F.when(zero, F.lit("ZERO_RESULTS")).otherwise(F.lit("OK")).alias("status"),
                       F.filter(F.array(result), lambda x: ~zero).alias("results"))
    return locs.select("lat", "lng", F.to_json(payload).alias("geocode_json"))


def malformed_route_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload per user, most of them broken: a fractional or a wordy
    duration, a polyline that stops inside a number, and text that is no JSON."""
    users = load_table(spark, sf_dir, "events").select(F.col("user_id").alias("request_id")).distinct()
    kind = F.pmod("request_id", F.lit(5))

    def payload(duration: str, polyline: str):
        return F.lit('{"routes":[{"duration":"60s","distanceMeters":900,"polyline":{"encodedPolyline":'
                     '"_p~iF~ps|U_ulLnnqC"}},{"duration":"%s","distanceMeters":700,"polyline":'
                     '{"encodedPolyline":"%s"}}]}' % (duration, polyline))

    return users.select("request_id", F.when(kind == 0, payload("717.5s", "_p~iF~ps|U"))
                        .when(kind == 1, payload("abc", "_p~iF~ps|U"))
                        .when(kind == 2, payload("90s", "_p~iF~ps|U_ulLnnq"))
                        .when(kind == 3, payload("90s", "_p~iF~ps|U"))
                        .otherwise(F.lit("no json")).alias("route_json"))


def forward_geocode_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One forward-geocode payload per located event, some without a result."""
    ev = load_table(spark, sf_dir, "events").selectExpr("event_id", *_LATLON).where("lat IS NOT NULL")
    k = F.col("event_id")
    result = F.struct(F.concat(k.cast("string"), F.lit(" Harbor Rd, Boston, MA")).alias("formatted_address"),
                      F.concat(F.lit("place-"), k.cast("string")).alias("place_id"),
                      F.struct(F.struct("lat", F.col("lon").alias("lng")).alias("location"),
                               F.lit("ROOFTOP").alias("location_type")).alias("geometry"))
    zero = F.pmod(k, F.lit(19)) == 0
    payload = F.struct(F.when(zero, F.lit("ZERO_RESULTS")).otherwise(F.lit("OK")).alias("status"),
                       F.filter(F.array(result), lambda x: ~zero).alias("results"))
    return ev.select(F.concat(F.lit("Crash site "), k.cast("string")).alias("address"),
                     F.to_json(payload).alias("geocode_json"))


DRIFT_FIELDS = ["crash_id", "year", "severity_3class", "lat", "speed_limit", "numb_vehc", "city_town_name"]


def drifting_crash_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crash rows as JSON lines in four batches: as declared; with a further
    field; without one; with speeds as text, half of them with a unit. Every
    41st line breaks off."""
    df = crashes(spark, sf_dir).withColumn("batch", F.pmod("crash_id", F.lit(4)))
    b, rest = F.col("batch"), [F.col(c) for c in DRIFT_FIELDS if c not in ("speed_limit", "numb_vehc")]
    speed, text = F.col("speed_limit"), F.col("speed_limit").cast("int").cast("string")
    text = F.when(F.pmod("crash_id", F.lit(8)) == 3, text).otherwise(F.concat(text, F.lit(" mph")))
    line = F.when(b == 0, F.to_json(F.struct(*rest, speed, "numb_vehc"))) \
        .when(b == 1, F.to_json(F.struct(*rest, speed, "numb_vehc", F.concat(
            F.lit("unit "), F.pmod("crash_id", F.lit(5)).cast("string")).alias("reporter")))) \
        .when(b == 2, F.to_json(F.struct(*rest, speed))) \
        .otherwise(F.to_json(F.struct(*rest, text.alias("speed_limit"), "numb_vehc")))
    broken = F.concat(F.lit('{"crash_id":'), F.col("crash_id").cast("string"))
    return df.select("batch", F.col("crash_id").alias("line_id"),
                     F.when(F.pmod("crash_id", F.lit(41)) == 0, broken).otherwise(line).alias("value"))
