"""Neighbourhood crash history by a distributed radius join.

For each query point: how many history crashes lie within 1 km / 500 m
(great-circle distance, inclusive), how many of them were fatal or injury
crashes, and their mean severity score within 1 km.

Plan (no all-pairs product, no row per query and grid cell):

1. History is aggregated to distinct (lat, lon) locations with partial sums
   (n, fatal, injury, score), so co-located crashes cost one row.
2. Query points are reduced to distinct locations too; a location that holds
   a third of all rows is still one row in the join.
3. Space is cut into tiles a few radii wide (the wider, the sparser the data).
   A query location goes to its own tile, a history location to every tile
   its circle meets: about (1 + 2 / t)^2 of them for tiles t radii wide.
4. Tiles with more than ``max_cell_locations`` history locations or
   ``QUERY_BLOCK`` query locations are split: each row to one part of its side
   by hash, and there once for each part of the other side.
5. Queries and history of a tile meet in a cogrouped numpy step. The tile's
   history is sorted by narrow lat bands and longitude, with running sums. In
   each band that a circle crosses, the longitudes surely inside it add a
   difference of running sums; only locations between there and the band's
   widest chord are tested one by one. With bands in the square root of a
   circle's locations, work per query grows with that root.
   Where queries are dense, those of a small square are taken together: what lies
   surely inside all their circles is added once, and the rim that is left is
   tested for all of them by one matrix product.
6. Sums of the parts of a tile are added up; results join back to the query
   rows on (lat, lon). Empty neighbourhoods give 0, and in leave-one-out mode
   each row's own contribution is removed (co-located other crashes still count).
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlens import constants as K
from crashlens.functions.features import severity_score
from crashlens.operators import nearest
from crashlens.session import stage_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(K)

FEATURES = list(K.SPATIAL_COLS)
#: Query locations that a tile should hold, and that a task holds at most.
TILE_QUERIES, QUERY_BLOCK = 20_000, 1_500_000
#: Seconds that a square of queries costs, and a pair of a query and a location of its rim.
SQUARE_S, PAIR_S = 3e-4, 1.5e-9
SUMMED = ["h_n", "h_fatal", "h_injury", "h_score"]
SUMS_SCHEMA = T.StructType([T.StructField(c, T.DoubleType()) for c in ("lat", "lon")]
                           + [T.StructField(c, T.LongType()) for c in ("n_big", "fatal_big", "injury_big")]
                           + [T.StructField("score_big", T.DoubleType())]
                           + [T.StructField(c, T.LongType()) for c in ("n_small", "fatal_small")])


def history_locations(history: DataFrame, severity_col: str = "severity_class") -> DataFrame:
    """Distinct history locations with crash, fatal, injury and score sums.

    Rows need lat, lon and a mapped severity class; others are dropped.
    """
    sev = F.col(severity_col)
    return (history
            .where(F.col("lat").isNotNull() & F.col("lon").isNotNull() & sev.isNotNull())
            .groupBy("lat", "lon")
            .agg(F.count(F.lit(1)).alias("h_n"),
                 F.sum((sev == "High").cast("long")).alias("h_fatal"),
                 F.sum((sev == "Medium").cast("long")).alias("h_injury"),
                 F.sum(severity_score(sev)).alias("h_score")))


def auto_cells_per_radius(hist_locs: DataFrame, radius_m: float = K.RADIUS_1KM) -> int:
    """Bands per radius for an average history location, by one small aggregate."""
    return _bands(_neighbours(hist_locs, radius_m))


def _bands(k: float) -> int:
    """Bands per radius for circles of about ``k`` locations: a query costs some
    microseconds for each band, and about 1.3 k / bands locations are tested."""
    return max(2, round(math.sqrt(0.1 * k)))


def _neighbours(hist_locs: DataFrame, radius_m: float) -> float:
    """Neighbours seen by an average history location: pi * sum(n^2) / sum(n)
    over cells one radius wide."""
    rho_deg = math.degrees(radius_m / K.EARTH_RADIUS_M)
    per_cell = (hist_locs.groupBy(F.floor(F.col("lat") / F.lit(rho_deg)).alias("b"),
                                  F.floor(F.col("lon") * F.cos(F.radians("lat")) / F.lit(rho_deg)).alias("c"))
                .agg(F.count(F.lit(1)).alias("n")))
    row = per_cell.agg(F.sum(F.col("n") * F.col("n")).alias("s2"), F.sum("n").alias("s1")).first()
    return math.pi * row["s2"] / row["s1"] if row and row["s1"] else 0.0


class _Tile:
    """History of a tile, sorted by (band, longitude) with running sums."""

    STEP = 1024.0  # degrees between the keys of two bands

    def __init__(self, hist: pd.DataFrame, qlat: np.ndarray, qlon: np.ndarray, band_deg: float):
        self.band_deg, self.lon0 = band_deg, qlon[0]
        lat, lon = hist["hlat"].to_numpy(), hist["hlng"].to_numpy()
        self.lat0 = min(lat.min(), qlat.min()) - band_deg
        key = self.band(lat) * self.STEP + self.east(lon)
        order = np.argsort(key, kind="stable")
        self.key, self.lat, self.lon = key[order], lat[order], lon[order]
        self.xyz = _unit(self.lat, self.lon)
        self.points = np.column_stack(self.xyz)
        self.values = hist[SUMMED].to_numpy(np.float64)[order]
        self.running = np.vstack([np.zeros(len(SUMMED)), np.cumsum(self.values, axis=0)])
        self.weights = self.values.astype(np.float32)
        #: whether sums in 32 bits are exact
        self.exact = self.running[-1].max() < 1 << 24 and (self.values >= 0).all() and (self.values % 1 == 0).all()

    def band(self, lat: np.ndarray) -> np.ndarray:
        return np.floor((lat - self.lat0) / self.band_deg)

    def east(self, lon: np.ndarray) -> np.ndarray:
        """Degrees east of the tile's first query, -180 to 180."""
        return (lon - self.lon0 + 180.0) % 360.0 - 180.0

    def sums(self, qlat: np.ndarray, qlon: np.ndarray, radius_m: float, columns: int,
             side: float | None = None) -> np.ndarray:
        """Sums of the first ``columns`` values within ``radius_m`` of each query, by
        squares of ``side`` degrees if given."""
        if side and self._plain(qlat, qlon, radius_m):
            return self._by_squares(qlat, qlon, radius_m, columns, side)
        span = 2 * math.ceil(math.degrees(radius_m / K.EARTH_RADIUS_M) / self.band_deg) + 2
        out, step = np.zeros((len(qlat), columns)), max(1, 40_000 // span)
        for s in range(0, len(qlat), step):
            lat, lon = qlat[s:s + step], qlon[s:s + step]
            first, last, inner0, inner1 = self._ranges(lat, lon, radius_m / K.EARTH_RADIUS_M, span)
            for c in range(columns):
                run = self.running[:, c]
                out[s:s + step, c] = (run[inner1] - run[inner0]).sum(1)
            start = np.concatenate([first, inner1], axis=1)
            length = np.concatenate([inner0 - first, last - inner1], axis=1)
            ends = np.cumsum(length.sum(1))
            at = 0
            while at < len(lat):  # pieces of bounded size
                done = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, done + 100_000, "right")))
                out[s + at:s + to] += self._tested(lat[at:to], lon[at:to], start[at:to], length[at:to], radius_m, columns)
                at = to
        return out

    def _ranges(self, lat, lon, rho: float, span: int):
        """Per query and band: sorted positions (first, last) that hold every location
        of the circle, and (inner0, inner1) among them that are surely inside.

        A band's widest chord is at its latitude nearest to the circle's widest
        parallel, the narrowest at one of its edges. The bounds are padded, so
        rounding can only turn a sure location into a tested one.
        """
        outer, inner = rho * (1 + 1e-9) + 1e-12, rho * (1 - 1e-9) - 1e-12
        phi, east = np.radians(lat)[:, None], self.east(lon)[:, None]
        bands = self.band(lat - math.degrees(outer))[:, None] + np.arange(span)
        low = np.clip(np.radians(self.lat0 + bands * self.band_deg) - 1e-12, -np.pi / 2, np.pi / 2)
        high = np.clip(np.radians(self.lat0 + (bands + 1) * self.band_deg) + 1e-12, -np.pi / 2, np.pi / 2)

        def half(at, r):  # longitude half-width of the circle on the parallel ``at``
            x = (math.sin(r / 2) ** 2 - np.sin((at - phi) / 2) ** 2) / np.maximum(np.cos(at) * np.cos(phi), 1e-300)
            return np.degrees(2 * np.arcsin(np.sqrt(np.clip(x, 0.0, 1.0))))
        widest = np.arcsin(np.clip(np.sin(phi) / math.cos(outer), -1.0, 1.0))
        out = half(np.clip(widest, low, high), outer) + 2e-9
        sure = np.minimum(half(low, inner), half(high, inner)) - 2e-9
        sure[(low < phi - inner) | (high > phi + inner)] = -1.0
        if np.abs(lat).max() > 90 or np.abs(east).max() + 2 * out.max() > 170:  # around a pole: whole bands are tested
            out[:], sure[:] = 400.0, -1.0
        meets = (high >= phi - outer) & (low <= phi + outer)
        if np.abs(lat).max() > 90:
            meets[:] = True
        mid = bands * self.STEP + east
        first, last = np.searchsorted(self.key, mid - out, "left"), np.searchsorted(self.key, mid + out, "right")
        last = np.where(meets, last, first)
        inner0, inner1 = np.searchsorted(self.key, mid - sure, "left"), np.searchsorted(self.key, mid + sure, "right")
        none = ~meets | (sure <= 0) | (inner1 <= inner0)
        return first, last, np.where(none, first, inner0), np.where(none, first, inner1)

    def _plain(self, qlat, qlon, radius_m: float) -> bool:
        """Whether all circles are far from the poles and within half the globe's longitudes."""
        reach = math.degrees(radius_m / K.EARTH_RADIUS_M) * 1.01
        top = np.abs(qlat).max() + reach
        return top < 85 and np.abs(self.east(qlon)).max() + 2 * reach / math.cos(math.radians(top)) < 170

    def _by_squares(self, qlat, qlon, radius_m: float, columns: int, side: float) -> np.ndarray:
        """As :meth:`sums`: queries of a square share the ranges of their locations."""
        rho, east = radius_m / K.EARTH_RADIUS_M, self.east(qlon)
        row = np.floor((qlat - qlat.min()) / side).astype(np.int64)
        col = np.floor((east - east.min()) * math.cos(math.radians(np.abs(qlat).max())) / side).astype(np.int64)
        order = np.lexsort((col, row))
        lat, lon, east, row, col = (x[order] for x in (qlat, qlon, east, row, col))
        own, sums = np.column_stack(_unit(lat, lon)), np.zeros((len(lat), columns))
        begins = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (col[1:] != col[:-1])])
        rows = np.r_[np.flatnonzero(np.r_[True, np.diff(row[begins]) != 0]), len(begins)]
        ends = np.r_[begins[1:], len(lat)]
        for a, b in zip(rows[:-1], rows[1:]):
            q0, q1 = begins[a], ends[b - 1]
            first, last, inner0, inner1 = self._row_ranges(lat[q0:q1], east[q0:q1], begins[a:b] - q0, rho)
            sure = (self.running[inner1] - self.running[inner0]).sum(0)
            start, length = np.concatenate([first, inner1]).T, np.concatenate([inner0 - first, last - inner1]).T
            for g in range(b - a):
                x, y, used = begins[a + g], ends[a + g], length[g] > 0
                sums[x:y] = sure[g, :columns]
                n = length[g][used]
                if not len(n):
                    continue
                upto = np.cumsum(n)
                rim = np.repeat(start[g][used] - (upto - n), n) + np.arange(upto[-1])
                for s in range(x, y, 2048):
                    e = min(s + 2048, y)
                    sums[s:e] += self._rim_sums(lat[s:e], lon[s:e], own[s:e], rim, radius_m, columns)
        out = np.empty_like(sums)
        out[order] = sums
        return out

    def _row_ranges(self, lat, east, begins, rho: float):
        """As :meth:`_ranges`, (bands, squares), for the squares of a row, whose queries
        begin at ``begins``: the locations that some circle of a square holds, and
        those that all do. Latitudes of bands and queries are taken as intervals."""
        outer, inner = rho * (1 + 1e-9) + 1e-12, rho * (1 - 1e-9) - 1e-12
        p0, p1 = math.radians(lat.min()), math.radians(lat.max())
        bands = np.arange(self.band(math.degrees(p0 - outer)), self.band(math.degrees(p1 + outer)) + 1)
        low = np.radians(self.lat0 + bands * self.band_deg) - 1e-12
        high = np.radians(self.lat0 + (bands + 1) * self.band_deg) + 1e-12

        def cosines(a, b):  # least and largest on the parallels between
            across = (a <= 0) & (b >= 0)
            return np.cos(np.maximum(np.abs(a), np.abs(b))), np.cos(np.where(across, 0.0, np.minimum(np.abs(a), np.abs(b))))
        (band0, band1), (own0, own1) = cosines(low, high), cosines(np.float64(p0), np.float64(p1))
        gap, far = np.maximum(np.maximum(low - p1, p0 - high), 0.0), np.maximum(high - p0, p1 - low)
        most = (math.sin(outer / 2) ** 2 - np.sin(gap / 2) ** 2) / (band0 * own0)
        least = (math.sin(inner / 2) ** 2 - np.sin(far / 2) ** 2) / (band1 * own1)

        def half(x):
            return np.degrees(2 * np.arcsin(np.sqrt(np.clip(x, 0.0, 1.0))))[:, None]
        out, sure = half(most) + 2e-9, half(least) - 2e-9
        e0, e1 = np.minimum.reduceat(east, begins), np.maximum.reduceat(east, begins)
        key = (bands * self.STEP)[:, None]

        def at(x, where: str):
            return np.searchsorted(self.key, x.ravel(), where).reshape(x.shape)
        first, last = at(key + (e0 - out), "left"), at(key + (e1 + out), "right")
        inner0, inner1 = at(key + (e1 - sure), "left"), at(key + (e0 + sure), "right")
        last = np.where((most >= 0)[:, None], last, first)
        none = (least <= 0)[:, None] | (inner1 <= inner0)
        return first, last, np.where(none, first, inner0), np.where(none, first, inner1)

    def _rim_sums(self, lat, lon, own, rim, radius_m: float, columns: int) -> np.ndarray:
        """Sums over the locations ``rim`` within the radius of each query. Squared chords
        less the radius's come from a matrix product of 32 bits around a query in the
        middle; those within its error of 0 are tested one by one."""
        limit = (2 * math.sin(radius_m / K.EARTH_RADIUS_M / 2)) ** 2
        scale, middle = 1 / math.sqrt(limit), own[len(own) // 2]
        h, q = (np.take(self.points, rim, axis=0) - middle) * scale, (own - middle) * scale
        over, square = np.einsum("ij,ij->i", h, h) - 1, (q * q).sum(1)
        left, right = np.ones((len(q), 5), np.float32), np.ones((len(rim), 5), np.float32)
        left[:, :3], left[:, 4] = q, square
        np.multiply(h, -2, out=right[:, :3], casting="same_kind")
        right[:, 3] = over
        most, wide = math.sqrt(square.max()), np.abs(over).max()
        error = np.float32(6e-7 * (2 * most * math.sqrt(1 + wide) + wide + most * most) + 1e-12)
        weights = np.take(self.weights if self.exact else self.values, rim, axis=0)[:, :columns]
        out, step = np.zeros((len(q), columns)), max(256, 131_072 // len(q))
        for s in range(0, len(rim), step):
            above = left @ right[s:s + step].T
            inside, close = above < -error, above <= error
            out += inside.astype(weights.dtype) @ weights[s:s + step]
            if np.count_nonzero(close) != np.count_nonzero(inside):
                i, j = np.divmod(np.flatnonzero(close ^ inside), above.shape[1])
                at = rim[s + j]
                near = self._within(lat[i], lon[i], own[i], at, limit, radius_m)
                np.add.at(out, i[near], self.values[at[near], :columns])
        return out

    def _within(self, lat, lon, own, at, limit: float, radius_m: float) -> np.ndarray:
        """Whether the locations ``at`` are within the radius of their queries: the chord
        decides; where it is too close to call, the haversine distance does."""
        chord2 = np.zeros(len(at))
        for c, other in enumerate(self.xyz):
            chord2 += (other[at] - own[:, c]) ** 2
        near = chord2 <= limit
        close = np.flatnonzero(np.abs(chord2 - limit) <= limit * 1e-8)
        near[close] = _haversine(lat[close], lon[close], self.lat[at[close]], self.lon[at[close]]) <= radius_m
        return near

    def _tested(self, lat, lon, start, length, radius_m: float, columns: int) -> np.ndarray:
        """Sums over the locations of the given ranges that are within the radius. The
        chord decides; where it is too close to call, the haversine distance does."""
        length = length.ravel()
        at = np.repeat(start.ravel() - (np.cumsum(length) - length), length) + np.arange(length.sum())
        query = np.repeat(np.repeat(np.arange(len(lat)), start.shape[1]), length)
        chord2 = np.zeros(len(at))
        for own, other in zip(_unit(lat, lon), self.xyz):
            chord2 += (other[at] - own[query]) ** 2
        limit = (2 * math.sin(radius_m / K.EARTH_RADIUS_M / 2)) ** 2
        near = chord2 <= limit
        close = np.flatnonzero(np.abs(chord2 - limit) <= limit * 1e-8)
        near[close] = _haversine(lat[query[close]], lon[query[close]], self.lat[at[close]], self.lon[at[close]]) <= radius_m
        query, at = query[near], at[near]
        return np.column_stack([np.bincount(query, self.values[at, c], len(lat)) for c in range(columns)])


def _unit(lat, lon):
    phi, lmb = np.radians(lat), np.radians(lon)
    return np.cos(phi) * np.cos(lmb), np.cos(phi) * np.sin(lmb), np.sin(phi)


def _haversine(lat1, lon1, lat2, lon2):
    phi1, phi2 = np.radians(lat1), np.radians(lat2)
    s1, s2 = np.sin((phi2 - phi1) / 2), np.sin((np.radians(lon2) - np.radians(lon1)) / 2)
    a = s1 * s1 + np.cos(phi1) * np.cos(phi2) * (s2 * s2)
    return 2.0 * K.EARTH_RADIUS_M * np.arcsin(np.sqrt(np.minimum(a, 1.0)))


def _crowding(lat: np.ndarray, lon: np.ndarray, size: float) -> float:
    """Locations per square degree around an average one, by cells of ``size`` degrees."""
    cells = np.floor(lat / size) * 4e6 + np.floor(lon * math.cos(math.radians(lat[0])) / size)
    counts = np.unique(cells, return_counts=True)[1].astype(float)
    return (counts ** 2).sum() / counts.sum() / size ** 2


def _square_side(queries: float, locations: float, radius: float) -> float | None:
    """Side in degrees of the squares that queries are taken together by, from the
    numbers a square degree: the larger, the fewer squares and the wider their rims
    (8 radii times the side). None if they would hold too few queries to pay."""
    side = min((2 * SQUARE_S / (PAIR_S * 8 * radius * queries * locations)) ** (1 / 3), radius / 4)
    return side if queries * side * side >= 6 else None


def _tile_sums(r_big: float, r_small: float, bands: int | None, width: float):
    def fn(q: pd.DataFrame, h: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(h):
            return pd.DataFrame({f.name: [] for f in SUMS_SCHEMA.fields})
        q = q.sort_values(["lat", "lng"])
        lat, lon = q["lat"].to_numpy(), q["lng"].to_numpy()
        big_deg, small_deg = (math.degrees(r / K.EARTH_RADIUS_M) for r in (r_big, r_small))
        dense = _crowding(lat, lon, big_deg / 2), _crowding(h["hlat"].to_numpy(), h["hlng"].to_numpy(), big_deg / 2)
        sides = _square_side(*dense, big_deg), _square_side(*dense, small_deg)
        m = bands or (_bands(len(h) * math.pi / (width + 2) ** 2) if None in sides else round(4 * big_deg / sides[0]))
        tile = _Tile(h, lat, lon, big_deg / m)
        big, small = tile.sums(lat, lon, r_big, 4, sides[0]), tile.sums(lat, lon, r_small, 2, sides[1])
        sums = np.column_stack([big, small])
        out = pd.DataFrame({"lat": lat, "lon": lon})
        for c, f in enumerate(SUMS_SCHEMA.fields[2:]):
            out[f.name] = sums[:, c].astype(np.float64 if f.dataType == T.DoubleType() else np.int64)
        return out[out["n_big"] > 0]
    return fn


def location_features(query_locs: DataFrame, hist_locs: DataFrame,
                      radii: tuple[float, float] = (K.RADIUS_1KM, K.RADIUS_500M),
                      cells_per_radius: int | str = "auto", max_cell_locations: int = 1_500_000,
                      partitions: int | None = None, stage: bool = True) -> DataFrame:
    """Raw neighbourhood sums per distinct query location (lat, lon).

    Returns lat, lon, n_big, fatal_big, injury_big, score_big, n_small,
    fatal_small for the big and small radius; locations with no neighbour
    are absent (the caller left-joins).

    ``cells_per_radius`` is the number of lat bands per big radius within a tile;
    ``auto`` follows each tile's density. A task holds at most
    ``max_cell_locations`` history and ``QUERY_BLOCK`` query locations at a time.

    With ``stage`` both sides are written once under the shared checkpoint folder
    and read back (see ``session.stage_table``).

    The sides are hash-partitioned by tile into ``partitions`` (default: four times
    the session's shuffle partitions): the work per row is large while rows are
    narrow, so byte-based coalescing would starve it.
    """
    r_big, r_small = radii
    spark = query_locs.sparkSession
    parts = partitions or 4 * max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                                  spark.sparkContext.defaultParallelism)
    lat, lon = F.col("lat"), F.col("lon")
    located = lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)
    if stage:
        hist_locs = stage_table(hist_locs, "radius-history")
        query_locs = stage_table(query_locs.select("lat", "lon"), "radius-queries")
    k = _neighbours(hist_locs, r_big)
    width = min(max(math.sqrt(TILE_QUERIES * math.pi / max(k, 1.0)), 3.0), 32.0)
    # crowded history: rather narrower tiles with more copies of it than tiles in parts, each met by all queries
    width = min(width, max(math.sqrt(max_cell_locations * math.pi / max(k, 1.0)) - 2, 1.5))
    rho_deg = math.degrees(r_big / K.EARTH_RADIUS_M)
    height = rho_deg * width

    keys = ["band", "cell"]
    # own names: the optimizer drops aliases that keep a name, and a cogroup whose sides share
    # a column (queries taken from the history itself) loses it on one side
    hist = nearest.reached(hist_locs.where(located).select("lat", lon.alias("lng"), *SUMMED), height, rho_deg * (1 + 1e-6)) \
        .withColumnsRenamed({"lat": "hlat", "lng": "hlng"})
    query = nearest.placed(query_locs.where(located).select("lat", lon.alias("lng")), height)

    def crowded(rows: DataFrame, most: int, name: str) -> DataFrame | None:
        """Parts of the tiles that hold more than ``most`` rows: few, as each holds so many."""
        tiles = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(most)).cast("int").alias(name)).where(F.col(name) > 1)
        return None if tiles.isEmpty() else F.broadcast(tiles)
    split = {"hs": crowded(hist, max_cell_locations, "hs"), "qs": crowded(query, QUERY_BLOCK, "qs")}

    def laid(rows: DataFrame, own: str, other: str, place: tuple[str, str]) -> DataFrame:
        """Rows in their part of the tile, once for each part of the other side."""
        for name, tiles in split.items():
            rows = rows.withColumn(name, F.lit(1)) if tiles is None else \
                rows.join(tiles, keys, "left").withColumn(name, F.coalesce(name, F.lit(1)))
        rows = rows.withColumn(own, F.pmod(F.xxhash64(*place), F.col(own)).cast("int"))
        if split[other] is None:
            rows = rows.withColumn(other, F.lit(0))
        else:
            rows = rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        return rows.repartition(parts, *keys, "hs", "qs")
    bands = None if cells_per_radius == "auto" else int(cells_per_radius)
    on = [*keys, "hs", "qs"]
    sums = laid(query, "qs", "hs", ("lat", "lng")).groupBy(*on) \
        .cogroup(laid(hist, "hs", "qs", ("hlat", "hlng")).groupBy(*on)) \
        .applyInPandas(_tile_sums(r_big, r_small, bands, width), SUMS_SCHEMA)
    if split["hs"] is None:
        return sums
    return sums.groupBy("lat", "lon").agg(*[F.sum(f.name).alias(f.name) for f in SUMS_SCHEMA.fields[2:]])


def _finish(df: DataFrame, leave_one_out, severity_col: str) -> DataFrame:
    """Coalesce empty neighbourhoods to 0 and, where ``leave_one_out`` holds
    (a bool, or a boolean column per row), remove the row's own contribution."""
    z = F.lit(0)
    n, fat, inj = (F.coalesce(F.col(c), z) for c in ("n_big", "fatal_big", "injury_big"))
    sc = F.coalesce(F.col("score_big"), F.lit(0.0))
    n5, fat5 = F.coalesce(F.col("n_small"), z), F.coalesce(F.col("fatal_small"), z)
    if leave_one_out is not False:
        own = F.lit(1) if leave_one_out is True else leave_one_out.cast("int")
        sev = F.col(severity_col)
        own_f = (sev == "High").cast("long") * own
        own_i = (sev == "Medium").cast("long") * own
        own_s = F.coalesce(severity_score(sev), F.lit(0.0)) * own
        n, fat, inj, sc = n - own, fat - own_f, inj - own_i, sc - own_s
        n5, fat5 = n5 - own, fat5 - own_f
    avg = F.when(n > 0, sc / n).otherwise(F.lit(0.0))
    return df.withColumns({
        "nearby_crash_count_1km": n.cast("long"),
        "nearby_fatal_count_1km": fat.cast("long"),
        "nearby_injury_count_1km": inj.cast("long"),
        "nearby_crash_count_500m": n5.cast("long"),
        "nearby_fatal_count_500m": fat5.cast("long"),
        "nearby_avg_severity_1km": avg.cast("double"),
    }).drop("n_big", "fatal_big", "injury_big", "score_big", "n_small", "fatal_small")


def neighbourhood_features(query: DataFrame, history: DataFrame, *, leave_one_out: bool = False,
                           severity_col: str = "severity_class", **grid) -> DataFrame:
    """Attach the six neighbourhood features to every ``query`` row.

    ``leave_one_out=True`` (training rows, C2): every query row must also be a
    history row; its own contribution is removed. ``False`` (held-out rows
    C3, or route points C4): all history rows count.
    """
    hist = history_locations(history, severity_col)
    if leave_one_out:
        qlocs = hist.select("lat", "lon")
    else:
        qlocs = query.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()) \
                     .select("lat", "lon").distinct()
    feats = location_features(qlocs, hist, **grid)
    joined = query.join(feats.hint("merge"), ["lat", "lon"], "left")
    return _finish(joined, leave_one_out, severity_col)


def split_features(rows: DataFrame, split_col: str = "is_test",
                   severity_col: str = "severity_class", **grid) -> DataFrame:
    """Training rows: leave-one-out over training rows; test rows: training
    rows only (C1-C3), in one radius join.

    History = training rows; queries = distinct locations of all rows. Every
    row takes its location's sums; training rows then remove their own
    contribution, test rows (not in the history) keep them as they are.
    """
    located = rows.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    hist = history_locations(located.where(~F.col(split_col)), severity_col)
    qlocs = located.select("lat", "lon").distinct()
    feats = location_features(qlocs, hist, **grid)
    joined = rows.join(feats, ["lat", "lon"], "left")
    return _finish(joined, F.col(split_col) == F.lit(False), severity_col)


def feature_summary(enriched: DataFrame, score_col: str = "severity_score") -> DataFrame:
    """Mean, min, max and Pearson correlation with the severity score for
    every spatial feature, in one aggregation pass, in long form (D4)."""
    aggs = []
    for c in FEATURES:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}__mean"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max"), F.corr(x, F.col(score_col)).alias(f"{c}__corr")]
    wide = enriched.agg(*aggs)
    parts = ", ".join(f"'{c}', {c}__mean, {c}__min, {c}__max, {c}__corr" for c in FEATURES)
    return wide.selectExpr(f"stack({len(FEATURES)}, {parts}) AS (feature, mean, min, max, corr)")
