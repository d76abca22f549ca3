"""Neighbourhood sums kept up to date by batches of new crashes.

The stored state is one row per distinct crash location with its own counts, and
one with the sums of its neighbourhood. A batch changes the sums of two kinds of
locations only: those it brings (joined with all history) and known ones near
it (joined with the batch alone), so a refresh joins work in proportion to the
batch and its surroundings instead of all history with itself.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlens import constants as K
from crashlens.operators import spatial
from crashlens.session import stage_table
from crashlens.sources import snapshots

COUNTS = ["h_n", "h_fatal", "h_injury", "h_score"]
SUMS = ["n_big", "fatal_big", "injury_big", "score_big", "n_small", "fatal_small"]
#: Beyond this latitude cells hold whole parallels.
POLAR = 80.0


def _added(parts: list[DataFrame], columns: list[str]) -> DataFrame:
    """Rows of equal locations added up."""
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy("lat", "lon").agg(*[F.sum(c).alias(c) for c in columns])


def near(locations: DataFrame, batch: DataFrame, radius_m: float = K.RADIUS_1KM) -> DataFrame:
    """Locations in the grid cells around those of ``batch``: a superset of the
    ones within the radius, found by a join on cells with their distinct keys."""
    size = math.degrees(radius_m / K.EARTH_RADIUS_M) * (1 + 1e-6) + 1e-9
    around = math.floor(360.0 * math.cos(math.radians(POLAR)) / size) or 1  # cells no narrower than the radius
    band = F.floor(F.col("lat") / F.lit(size))
    polar = F.abs(F.col("lat")) > F.lit(POLAR - 2 * size)
    cell = F.pmod(F.floor(F.col("lon") * F.lit(around / 360.0)), F.lit(around))
    step = F.array(F.lit(-1), F.lit(0), F.lit(1))
    # a location near the pole meets all cells of its bands under the key -1
    keys = batch.select(F.explode(F.transform(step, lambda d: band + d)).alias("_band"), cell.alias("_c"), polar.alias("_p")) \
        .select("_band", F.explode(F.when(F.col("_p"), F.array(F.lit(-1).cast("long"))).otherwise(
            F.transform(step, lambda d: F.pmod(F.col("_c") + d, F.lit(around))))).alias("_cell")).distinct()
    met = locations.withColumn("_band", band).withColumn("_keys", F.array(cell, F.lit(-1).cast("long"))) \
        .withColumn("_cell", F.explode("_keys")).join(keys, ["_band", "_cell"], "left_semi")
    return met.select("lat", "lon").distinct()


def first_state(history: DataFrame, **grid) -> tuple[DataFrame, DataFrame]:
    """(locations, sums) of all ``history`` (lat, lon, severity_class), rebuilt."""
    locations = stage_table(spatial.history_locations(history), "state-locations")
    return locations, spatial.location_features(locations.select("lat", "lon"), locations, stage=False, **grid)


def next_state(locations: DataFrame, sums: DataFrame, batch: DataFrame, **grid) -> tuple[DataFrame, DataFrame]:
    """(locations, sums) after ``batch``: equal to a rebuild over all rows."""
    fresh = stage_table(spatial.history_locations(batch), "batch-locations")
    merged = stage_table(_added([locations, fresh], COUNTS), "state-locations")
    unseen = fresh.select("lat", "lon").join(locations, ["lat", "lon"], "left_anti")
    known = near(locations, fresh)
    return merged, _added([sums, spatial.location_features(unseen, merged, stage=False, **grid),
                           spatial.location_features(known, fresh, stage=False, **grid)], SUMS)


def refresh(spark: SparkSession, path: str, batch: DataFrame, batch_id: str, **grid) -> int:
    """Apply a batch to the state at ``path`` and return the version that holds it.

    A batch id that a stored version already holds changes nothing, so a batch may
    be delivered again. Readers of earlier versions are not disturbed; of two
    concurrent refreshes one raises ``snapshots.CommitConflict``.
    """
    known = snapshots.versions(spark, path)
    if not known:
        locations, sums = first_state(batch, **grid)
        batches = spark.createDataFrame([(batch_id,)], "batch_id string")
    else:
        locations, sums, batches = snapshots.read(spark, path, ["locations", "sums", "batches"], known[-1])
        if not batches.where(F.col("batch_id") == F.lit(batch_id)).isEmpty():
            return known[-1]
        locations, sums = next_state(locations, sums, batch, **grid)
        batches = batches.unionByName(spark.createDataFrame([(batch_id,)], "batch_id string"))
    return snapshots.commit(spark, path, {"locations": locations, "sums": sums, "batches": batches.coalesce(1)},
                            after=known[-1] if known else 0)
