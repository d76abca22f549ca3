"""Nearest place on the globe for every point, exactly.

The nearest place is sought in growing circles: a level's circle has the radius
of its grid cells, so a point looks at about nine cells, and whatever it finds
within the circle is nearest, as every place of the circle has been seen. Points
that find nothing go on with circles and cells of twice the size, up to the
given radius; beyond it they have no place. The first level is the coarsest
whose fullest cell holds few places, so a dense town does not make its points
meet a whole district, and lonely points only take a few levels more.

Points and places are reduced to distinct locations, so a spot that holds a third
of all rows is one row of the join. Staged tables are joined by merging: the size of
their compressed files would pass some for small enough to broadcast, and the driver
would hold them unpacked.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crashlens import constants as K
from crashlens.session import stage_table

#: Places of a cell that the first level may hold, and levels to choose it from.
CELL_PLACES = 64
LEVELS = 12


def haversine_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance in metres of points in degrees."""
    s1 = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    s2 = F.sin((F.radians(lng2) - F.radians(lng1)) / 2)
    a = s1 * s1 + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * (s2 * s2)
    return F.lit(2.0 * K.EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def _cells_around(band: Column, height: float) -> Column:
    """Cells of a band: as many as are at least ``height`` degrees wide everywhere in it."""
    edge = F.greatest(F.abs(band * height - 90.0), F.abs((band + 1) * height - 90.0))
    return F.greatest(F.floor(F.cos(F.radians(F.least(edge, F.lit(90.0)))) * (360.0 / height)), F.lit(1)).cast("long")


def placed(rows: DataFrame, height: float) -> DataFrame:
    """Rows (lat, lng) with their band and cell of a grid of ``height`` degrees."""
    rows = rows.withColumn("band", F.floor((F.col("lat") + 90.0) / height).cast("long"))
    around = _cells_around(F.col("band"), height)
    return rows.withColumn("cell", F.pmod(F.floor((F.col("lng") + 180.0) / 360.0 * around).cast("long"), around))


def reached(points: DataFrame, height: float, reach: float | None = None) -> DataFrame:
    """Points (lat, lng, ...), once for each cell of ``height`` degrees that their circle
    of ``reach`` degrees (at most, and by default, ``height``) meets."""
    pad = (reach or height) * (1 + 1e-9)

    def band(lat: Column) -> Column:
        return F.floor((lat + 90.0) / height).cast("long")
    rows = points.withColumn("band", F.explode(F.sequence(band(F.col("lat") - pad), band(F.col("lat") + pad))))
    sine = math.sin(math.radians(pad)) / F.cos(F.radians("lat"))
    half = F.when(F.abs("lat") + pad >= 90.0, F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(sine, F.lit(1.0)))) + 1e-9)
    rows = rows.withColumns({"_around": _cells_around(F.col("band"), height), "_half": half})

    def at(lng: Column) -> Column:
        return F.floor((lng + 180.0) / 360.0 * F.col("_around")).cast("long")
    rows = rows.withColumns({"_from": at(F.col("lng") - F.col("_half")), "_to": at(F.col("lng") + F.col("_half"))})
    whole = F.col("_to") - F.col("_from") + 1 >= F.col("_around")
    cells = F.when(whole, F.sequence(F.lit(0).cast("long"), F.col("_around") - 1)) \
        .otherwise(F.transform(F.sequence("_from", "_to"), lambda c: F.pmod(c, F.col("_around"))))
    return rows.select(*points.columns, "band", F.explode(cells).alias("cell"))


def _levels(places: DataFrame, radius: float) -> list[float]:
    """Circle sizes in degrees up to ``radius``, each twice the one before."""
    sizes = [radius / 2 ** k for k in range(LEVELS)]
    tagged = reduce(DataFrame.unionByName, [placed(places, h).select(F.lit(k).alias("k"), "band", "cell")
                                            for k, h in enumerate(sizes)])
    fullest = {r["k"]: r["n"] for r in tagged.groupBy("k", "band", "cell").agg(F.count(F.lit(1)).alias("n"))
               .groupBy("k").agg(F.max("n").alias("n")).collect()}
    first = next((k for k in range(LEVELS) if fullest.get(k, 0) <= CELL_PLACES), LEVELS - 1)
    return sizes[first::-1]


def nearest_places(points: DataFrame, places: DataFrame, carried: list[str], radius_m: float = K.RADIUS_1KM) -> DataFrame:
    """``points`` (lat, lng, ...) with ``place_lat``, ``place_lng``, ``place_m`` (metres,
    to a micrometre) and the columns ``carried`` of the nearest of ``places`` (lat,
    lng, ...) within ``radius_m``; nulls where there is none or a coordinate is null.

    Equal distances go to the smaller latitude, then longitude; of places on one
    spot the smallest ``carried`` values count, nulls first. Rows of ``points`` are
    kept as they are, repeated ones too; their own columns must not be named like
    the new ones (``ValueError``).
    """
    new = ["place_lat", "place_lng", "place_m", *carried]
    clash = sorted(set(new) & set(points.columns))
    if clash:
        raise ValueError(f"points already have columns {clash}")
    spots = stage_table(places.where("lat is not null and lng is not null").groupBy("lat", "lng").agg(
        F.min(F.struct(*[F.col(c) for c in carried], F.lit(0).alias("_"))).alias("carried")), "nearest-places")
    waiting = stage_table(points.where("lat is not null and lng is not null").select("lat", "lng").distinct(),
                          "nearest-points")
    radius = math.degrees(radius_m / K.EARTH_RADIUS_M)
    found = []
    for size in _levels(spots, radius):
        near = placed(spots, size).select("band", "cell", F.col("lat").alias("plat"), F.col("lng").alias("plng"), "carried")
        metres = haversine_m(F.col("lat"), F.col("lng"), F.col("plat"), F.col("plng"))
        within = radius_m if size == radius else math.radians(size) * K.EARTH_RADIUS_M - 1e-5  # ties are rounded
        hits = reached(waiting, size).join(near.hint("merge"), ["band", "cell"]).withColumn("m", metres).where(F.col("m") <= within) \
            .groupBy("lat", "lng").agg(F.min(F.struct(F.round("m", 6).alias("m"), "plat", "plng", "carried")).alias("best"))
        hits = stage_table(hits, "nearest-hits")
        found.append(hits)
        waiting = stage_table(waiting.join(hits.hint("merge"), ["lat", "lng"], "left_anti"), "nearest-waiting")
        if waiting.isEmpty():
            break
    best = reduce(DataFrame.unionByName, found).select(
        F.col("lat").alias("_lat"), F.col("lng").alias("_lng"), F.col("best.plat").alias("place_lat"),
        F.col("best.plng").alias("place_lng"), F.col("best.m").alias("place_m"),
        *[F.col(f"best.carried.{c}").alias(c) for c in carried])
    on = (points["lat"] == best["_lat"]) & (points["lng"] == best["_lng"])
    return points.join(best.hint("merge"), on, "left").select(*[points[c] for c in points.columns], *[best[c] for c in new])
