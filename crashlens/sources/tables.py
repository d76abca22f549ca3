"""Table readers and the derived ``crashes`` view.

The driver tables carry no crash table, so ``crashes`` is derived from
``events`` by deterministic integer formulas. The same column expressions are
parsed by Spark (``selectExpr``) and by the DuckDB oracle, so both engines see
identical rows. Real deployments read landed crash files with
:func:`read_crashes` and an explicit schema instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

CRASH_SCHEMA = T.StructType([
    T.StructField("crash_id", T.LongType(), False),
    T.StructField("crash_datetime_clean", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("severity_3class", T.StringType()),
    T.StructField("crash_severity_descr", T.StringType()),
    T.StructField("numb_fatal_injr", T.IntegerType()),
    T.StructField("numb_nonfatal_injr", T.IntegerType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("speed_limit", T.DoubleType()),
    T.StructField("numb_vehc", T.IntegerType()),
    T.StructField("district_num", T.IntegerType()),
    T.StructField("ems_hotspot_flag", T.IntegerType()),
    T.StructField("ems_ped_hotspot_flag", T.IntegerType()),
    T.StructField("ems_peak_hour", T.IntegerType()),
    T.StructField("weath_cond_descr", T.StringType()),
    T.StructField("road_surf_cond_descr", T.StringType()),
    T.StructField("ambnt_light_descr", T.StringType()),
    T.StructField("manr_coll_descr", T.StringType()),
    T.StructField("rdwy_jnct_type_descr", T.StringType()),
    T.StructField("city_town_name", T.StringType()),
])

# Column expressions deriving one crash row per event. Plain SQL that Spark
# and DuckDB evaluate identically (integer modular arithmetic, CASE, CAST).
CRASH_EXPRS = [
    "event_id AS crash_id",
    "CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(ts AS STRING) END AS crash_datetime_clean",
    "CAST(2015 + event_id % 10 AS INT) AS year",
    "CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 100 = 7 THEN 'Fatal' "
    "WHEN event_id % 10 IN (1, 3, 5) THEN 'Injury' ELSE 'No Injury' END AS severity_3class",
    "CASE WHEN event_id % 11 = 0 THEN 'Unknown' WHEN event_id % 100 = 7 THEN 'Fatal injury' "
    "WHEN event_id % 10 IN (1, 3, 5) THEN 'Non-fatal injury' "
    "ELSE 'Property damage only (none injured)' END AS crash_severity_descr",
    "CAST(CASE WHEN event_id % 100 = 7 THEN 1 ELSE 0 END AS INT) AS numb_fatal_injr",
    "CAST(CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 10 IN (1, 3, 5) THEN 1 ELSE 0 END"
    " AS INT) AS numb_nonfatal_injr",
    "CASE WHEN event_id % 53 = 0 THEN NULL ELSE CAST(42.23 AS DOUBLE) + "
    "CAST((event_id * 7919) % 10000 AS DOUBLE) * CAST(0.000017 AS DOUBLE) END AS lat",
    "CASE WHEN event_id % 53 = 0 THEN NULL ELSE CAST(-71.19 AS DOUBLE) + "
    "CAST((event_id * 6131) % 10007 AS DOUBLE) * CAST(0.00002 AS DOUBLE) END AS lon",
    "CASE WHEN event_id % 9 IN (0, 4) THEN NULL ELSE CAST(25 + 5 * (event_id % 7) AS DOUBLE) END"
    " AS speed_limit",
    "CAST(CASE WHEN event_id % 19 = 0 THEN NULL ELSE 1 + event_id % 3 END AS INT) AS numb_vehc",
    "CAST(1 + user_id % 6 AS INT) AS district_num",
    "CAST(CASE WHEN user_id % 8 = 0 THEN 1 ELSE 0 END AS INT) AS ems_hotspot_flag",
    "CAST(CASE WHEN user_id % 16 = 0 THEN 1 ELSE 0 END AS INT) AS ems_ped_hotspot_flag",
    "CAST(CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END AS INT) AS ems_peak_hour",
    "CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 'Rain' "
    "WHEN event_id % 7 = 0 THEN 'Cloudy/Rain' WHEN event_id % 211 = 0 THEN 'Fog, smog, smoke' "
    "ELSE 'Clear' END AS weath_cond_descr",
    "CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 'Wet' "
    "WHEN event_id % 31 = 0 THEN 'Snow' ELSE 'Dry' END AS road_surf_cond_descr",
    "CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 4 = 1 THEN 'Dark - lighted roadway' "
    "WHEN event_id % 4 = 2 THEN 'Dusk' ELSE 'Daylight' END AS ambnt_light_descr",
    "CASE WHEN event_id % 6 = 0 THEN 'Rear-end' WHEN event_id % 6 = 1 THEN 'Angle' "
    "WHEN event_id % 6 = 2 THEN 'Single vehicle crash' "
    "WHEN event_id % 6 = 3 THEN 'Sideswipe, same direction' "
    "WHEN event_id % 6 = 4 THEN 'Head-on' ELSE 'Head on' END AS manr_coll_descr",
    "CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 'Four-way intersection' "
    "WHEN event_id % 3 = 1 THEN 'Not at junction' ELSE 'T-intersection' END AS rdwy_jnct_type_descr",
    "CASE WHEN user_id % 3 = 0 THEN 'CAMBRIDGE' ELSE 'BOSTON' END AS city_town_name",
]


def crashes_sql(source: str = "events") -> str:
    """The derivation as one SELECT, for the DuckDB oracle (used as a CTE)."""
    return "SELECT " + ",\n  ".join(CRASH_EXPRS) + f"\nFROM {source}"


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived crash table (one row per event) read from ``events``."""
    return load_table(spark, sf_dir, "events").selectExpr(*CRASH_EXPRS)


def read_crashes(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read landed crash files with the explicit crash schema (no inference).

    ``fmt`` is ``parquet``, ``csv`` (with header) or ``json`` (one object per line).
    """
    r = spark.read.schema(CRASH_SCHEMA)
    if fmt == "csv":
        return r.option("header", "true").option("mode", "PERMISSIVE").csv(path)
    if fmt == "json":
        return r.json(path)
    return r.parquet(path)
