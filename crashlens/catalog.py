"""Registry of the checkable queries: Spark callables and their oracle SQL.

Each Spark callable takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole driver tables (or data Spark derives from them). Each oracle is plain
SQL for DuckDB over the same tables, written independently of the Spark code.
Column names match one to one; doubles are rounded where summation order
could change the last digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window

from crashlens.operators import reads
from crashlens.session import ensure_checkpoint_dir
from crashlens.sources.tables import crashes, crashes_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # timestamps are parsed and read in UTC; staging needs the shared folder
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            ensure_checkpoint_dir(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


CRASHES_CTE = f"crashes AS (\n{crashes_sql('events')}\n)"


def with_crashes(body: str, *more_ctes: str) -> str:
    ctes = ",\n".join((CRASHES_CTE,) + more_ctes)
    return f"WITH {ctes}\n{body}"


# ---------------------------------------------------------------- reads (B, D1, E1, E2)

@register("stats_by_year", with_crashes(
    "SELECT year, COUNT(*) AS crashes, "
    "CAST(SUM(COALESCE(numb_fatal_injr, 0)) AS BIGINT) AS fatalities, "
    "CAST(SUM(COALESCE(numb_nonfatal_injr, 0)) AS BIGINT) AS injuries "
    "FROM crashes GROUP BY year ORDER BY year"))
def q_stats_by_year(spark, sf):
    return reads.stats_by_year(crashes(spark, sf))


@register("crashes_page", with_crashes(
    "SELECT * FROM crashes ORDER BY crash_id LIMIT 100 OFFSET 200"))
def q_crashes_page(spark, sf):
    return reads.page(crashes(spark, sf), limit=100, offset=200)


@register("crashes_by_year", with_crashes(
    "SELECT * FROM crashes WHERE year = 2020 ORDER BY crash_id LIMIT 100"))
def q_crashes_by_year(spark, sf):
    return reads.by_year(crashes(spark, sf), 2020, limit=100)


@register("crashes_by_severity", with_crashes(
    "SELECT * FROM crashes WHERE severity_3class ILIKE '%injury%' ORDER BY crash_id LIMIT 250"))
def q_crashes_by_severity(spark, sf):
    return reads.by_severity(crashes(spark, sf), "injury", limit=250)


@register("crashes_by_city", with_crashes(
    "SELECT * FROM crashes WHERE city_town_name ILIKE '%bridge%' ORDER BY crash_id LIMIT 100"))
def q_crashes_by_city(spark, sf):
    return reads.by_city(crashes(spark, sf), "bridge", limit=100)


@register("crashes_hotspots", with_crashes(
    "SELECT * FROM crashes WHERE ems_hotspot_flag = 1 ORDER BY crash_id LIMIT 100"))
def q_crashes_hotspots(spark, sf):
    return reads.hotspots(crashes(spark, sf), limit=100)


@register("crashes_fatal", with_crashes(
    "SELECT * FROM crashes WHERE numb_fatal_injr > 0 ORDER BY crash_id LIMIT 100"))
def q_crashes_fatal(spark, sf):
    return reads.fatal(crashes(spark, sf), limit=100)


@register("crashes_filter", with_crashes(
    "SELECT * FROM crashes WHERE year = 2020 AND weath_cond_descr ILIKE '%Rain%' "
    "ORDER BY crash_id LIMIT 100"))
def q_crashes_filter(spark, sf):
    return reads.filter_crashes(crashes(spark, sf), year=2020, weather="Rain", limit=100)


@register("crashes_filter_all_fields", with_crashes(
    "SELECT crash_id, year, city_town_name, crash_severity_descr, weath_cond_descr "
    "FROM crashes WHERE year = 2022 AND city_town_name ILIKE '%BOS%' "
    "AND severity_3class ILIKE '%Fatal%' AND weath_cond_descr ILIKE '%clear%'"))
def q_crashes_filter_all_fields(spark, sf):
    df = reads.filter_crashes(crashes(spark, sf), year=2022, city="BOS", severity="Fatal",
                              weather="clear", limit=None)
    return reads.project(df, ["crash_id", "year", "city_town_name", "crash_severity_descr",
                              "weath_cond_descr"])


@register("crashes_filter_envelope", with_crashes(
    "SELECT COUNT(*) AS total_returned, CAST(2020 AS BIGINT) AS filter_year, "
    "CAST(NULL AS VARCHAR) AS filter_city, CAST(NULL AS VARCHAR) AS filter_severity, "
    "'Rain' AS filter_weather FROM (SELECT * FROM crashes WHERE year = 2020 "
    "AND weath_cond_descr ILIKE '%Rain%' ORDER BY crash_id LIMIT 100) t"))
def q_crashes_filter_envelope(spark, sf):
    res = reads.filter_crashes(crashes(spark, sf), year=2020, weather="Rain", limit=100)
    return reads.envelope(res, year=2020, city=None, severity=None, weather="Rain")


# ---------------------------------------------------------------- cleaning, features

from pyspark.sql import functions as F  # noqa: E402

from crashlens.functions import features as FX  # noqa: E402
from crashlens.operators import cleaning, spatial, split  # noqa: E402
from crashlens.plans import features as PF  # noqa: E402

SEV_SQL = ("CASE severity_3class WHEN 'No Injury' THEN 'Low' WHEN 'Injury' THEN 'Medium' "
           "WHEN 'Fatal' THEN 'High' END")
LABELLED_CTE = f"labelled AS (SELECT *, {SEV_SQL} AS severity_class FROM crashes WHERE {SEV_SQL} IS NOT NULL)"
TIME_CTE = ("timed AS (SELECT *, hour(ts) AS hour_of_day, isodow(ts) - 1 AS day_of_week, "
            "month(ts) AS month FROM (SELECT *, TRY_CAST(crash_datetime_clean AS TIMESTAMP) AS ts "
            "FROM {src}) t)")
RUSH_V2 = "CASE WHEN hour_of_day BETWEEN 7 AND 9 OR hour_of_day BETWEEN 16 AND 19 THEN 1 ELSE 0 END"
RUSH_V1 = "CASE WHEN hour_of_day BETWEEN 7 AND 9 OR hour_of_day BETWEEN 16 AND 18 THEN 1 ELSE 0 END"
LIGHT_TRAIN = ("CASE WHEN hour_of_day < 6 OR hour_of_day >= 20 THEN 'Dark' "
               "WHEN hour_of_day IN (6, 19) THEN 'Dawn_Dusk' ELSE 'Daylight' END")
LIGHT_SERVE = ("CASE WHEN hour_of_day BETWEEN 7 AND 18 THEN 'Daylight' "
               "WHEN hour_of_day IN (5, 6, 19, 20) THEN 'Dawn_Dusk' ELSE 'Dark' END")
SPLIT_CTES = (
    "located AS (SELECT * FROM labelled WHERE lat IS NOT NULL AND lon IS NOT NULL)",
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY severity_class ORDER BY "
    "CAST('0x' || substr(md5(crash_id || ':42'), 1, 8) AS BIGINT), crash_id) AS rk, "
    "count(*) OVER (PARTITION BY severity_class) AS ncls FROM located)",
    "splitted AS (SELECT * EXCLUDE (rk, ncls), rk <= (ncls * 20 + 99) // 100 AS is_test FROM ranked)",
)
HAV = ("12742018.0 * asin(sqrt(least(sin((radians(h.lat) - radians(q.lat)) / 2) * "
       "sin((radians(h.lat) - radians(q.lat)) / 2) + cos(radians(q.lat)) * cos(radians(h.lat)) * "
       "(sin((radians(h.lon) - radians(q.lon)) / 2) * sin((radians(h.lon) - radians(q.lon)) / 2)), 1.0)))")
SPATIAL_CTES = SPLIT_CTES + (
    "train AS (SELECT crash_id, lat, lon, severity_class FROM splitted WHERE NOT is_test)",
    f"pairs AS (SELECT q.crash_id, h.severity_class AS hs, {HAV} AS d FROM splitted q JOIN train h "
    "ON h.lat BETWEEN q.lat - 0.0091 AND q.lat + 0.0091 AND (q.is_test OR q.crash_id <> h.crash_id))",
    "agg AS (SELECT crash_id, "
    "count(*) FILTER (WHERE d <= 1000) AS n1, "
    "count(*) FILTER (WHERE d <= 1000 AND hs = 'High') AS f1, "
    "count(*) FILTER (WHERE d <= 1000 AND hs = 'Medium') AS i1, "
    "sum(CASE hs WHEN 'Medium' THEN 1.0 WHEN 'High' THEN 2.0 ELSE 0.0 END) FILTER (WHERE d <= 1000) AS s1, "
    "count(*) FILTER (WHERE d <= 500) AS n5, "
    "count(*) FILTER (WHERE d <= 500 AND hs = 'High') AS f5 FROM pairs GROUP BY crash_id)",
    "enriched AS (SELECT s.*, "
    "CAST(COALESCE(n1, 0) AS BIGINT) AS nearby_crash_count_1km, "
    "CAST(COALESCE(f1, 0) AS BIGINT) AS nearby_fatal_count_1km, "
    "CAST(COALESCE(i1, 0) AS BIGINT) AS nearby_injury_count_1km, "
    "CAST(COALESCE(n5, 0) AS BIGINT) AS nearby_crash_count_500m, "
    "CAST(COALESCE(f5, 0) AS BIGINT) AS nearby_fatal_count_500m, "
    "CASE WHEN COALESCE(n1, 0) > 0 THEN s1 / n1 ELSE 0.0 END AS nearby_avg_severity_1km, "
    "CASE s.severity_class WHEN 'Low' THEN 0.0 WHEN 'Medium' THEN 1.0 ELSE 2.0 END AS severity_score "
    "FROM splitted s LEFT JOIN agg a ON s.crash_id = a.crash_id)",
)
SPATIAL_OUT = ["crash_id", "is_test"] + list(spatial.FEATURES)


@register("severity_value_counts", with_crashes(
    "SELECT severity_3class, COUNT(*) AS n, "
    "ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 4) AS pct FROM crashes GROUP BY severity_3class"))
def q_severity_value_counts(spark, sf):
    return cleaning.value_counts(crashes(spark, sf), "severity_3class")


@register("severity_class_counts", with_crashes(
    f"SELECT {SEV_SQL} AS severity_class, COUNT(*) AS n, "
    "ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 4) AS pct FROM crashes GROUP BY 1"))
def q_severity_class_counts(spark, sf):
    df = crashes(spark, sf).withColumn("severity_class", FX.severity_class("severity_3class"))
    return cleaning.value_counts(df, "severity_class")


@register("cleaning_audit", with_crashes(
    "SELECT * FROM (VALUES (0, 'input', (SELECT COUNT(*) FROM crashes)), "
    f"(1, 'target', (SELECT COUNT(*) FROM crashes WHERE {SEV_SQL} IS NOT NULL)), "
    f"(2, 'lat_lon_time', (SELECT COUNT(*) FROM crashes WHERE {SEV_SQL} IS NOT NULL AND lat IS NOT NULL "
    "AND lon IS NOT NULL AND TRY_CAST(crash_datetime_clean AS TIMESTAMP) IS NOT NULL))) "
    "AS t(stage_no, stage, rows)"))
def q_cleaning_audit(spark, sf):
    df = crashes(spark, sf)
    return cleaning.stage_audit(df, [
        ("target", FX.severity_class("severity_3class").isNotNull()),
        ("lat_lon_time", F.col("lat").isNotNull() & F.col("lon").isNotNull()
         & FX.parse_timestamp("crash_datetime_clean").isNotNull()),
    ])


@register("speed_limit_median_by_year", with_crashes(
    "SELECT year, median(speed_limit) AS median_speed_limit, "
    "CAST(SUM(CASE WHEN speed_limit IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing "
    "FROM crashes GROUP BY year"))
def q_speed_limit_median_by_year(spark, sf):
    rows = crashes(spark, sf)
    found = cleaning.grouped_medians(rows, ["speed_limit"], by="year")  # a value a year
    median = F.lit(None).cast("double")
    for (year, _), value in found.items():
        median = F.when(F.col("year").eqNullSafe(F.lit(year)), F.lit(value)).otherwise(median)
    return (rows.groupBy("year").agg(F.sum(F.col("speed_limit").isNull().cast("long")).alias("missing"))
            .select("year", median.alias("median_speed_limit"), "missing"))


@register("time_features", with_crashes(
    f"SELECT crash_id, hour_of_day, day_of_week, month, "
    "CASE WHEN day_of_week >= 5 THEN 1 ELSE 0 END AS is_weekend, "
    f"{RUSH_V1} AS is_rush_hour_v1, {RUSH_V2} AS is_rush_hour_v2, "
    f"{LIGHT_TRAIN} AS light_phase_train, {LIGHT_SERVE} AS light_phase_serve, "
    f"CAST(CASE WHEN ({RUSH_V2}) = 1 AND COALESCE(day_of_week, 0) < 5 THEN 1 ELSE 0 END AS INT) "
    "AS is_rush_hour_serve FROM timed", TIME_CTE.format(src="crashes")))
def q_time_features(spark, sf):
    df = PF.with_time_features(crashes(spark, sf), "v2")
    return df.select(
        "crash_id", "hour_of_day", "day_of_week", "month", "is_weekend",
        FX.is_rush_hour("hour_of_day", "v1").alias("is_rush_hour_v1"),
        F.col("is_rush_hour").alias("is_rush_hour_v2"),
        F.col("light_phase").alias("light_phase_train"),
        FX.light_phase("hour_of_day", "serve").alias("light_phase_serve"),
        FX.is_rush_hour("hour_of_day", "serve", weekend="is_weekend").alias("is_rush_hour_serve"))


@register("split_summary", with_crashes(
    "SELECT severity_class, CAST(SUM(CASE WHEN NOT is_test THEN 1 ELSE 0 END) AS BIGINT) AS train_rows, "
    "CAST(SUM(CASE WHEN is_test THEN 1 ELSE 0 END) AS BIGINT) AS test_rows FROM splitted "
    "GROUP BY severity_class", LABELLED_CTE, *SPLIT_CTES))
def q_split_summary(spark, sf):
    base = PF.labelled(crashes(spark, sf)).where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return split.split_summary(split.stratified_split(base))


@register("split_assignment", with_crashes(
    "SELECT crash_id, severity_class, is_test FROM splitted", LABELLED_CTE, *SPLIT_CTES))
def q_split_assignment(spark, sf):
    base = PF.labelled(crashes(spark, sf)).where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return split.stratified_split(base).select("crash_id", "severity_class", "is_test")


@register("class_weights", with_crashes(
    "SELECT severity_class, SUM(COUNT(*)) OVER () / (COUNT(*) OVER () * COUNT(*)) AS class_weight "
    "FROM splitted WHERE NOT is_test GROUP BY severity_class", LABELLED_CTE, *SPLIT_CTES))
def q_class_weights(spark, sf):
    base = PF.labelled(crashes(spark, sf)).where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    train = split.stratified_split(base).where(~F.col("is_test"))
    return split.balanced_weights(train)


@register("spatial_features", with_crashes(
    f"SELECT {', '.join(SPATIAL_OUT)} FROM enriched", LABELLED_CTE, *SPATIAL_CTES))
def q_spatial_features(spark, sf):
    return PF.spatial_enriched(crashes(spark, sf)).select(*SPATIAL_OUT)


@register("spatial_feature_summary", with_crashes(
    "SELECT feature, ROUND(mean, 6) AS mean, min, max, ROUND(corr, 6) AS corr FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, avg(CAST({c} AS DOUBLE)) AS mean, min(CAST({c} AS DOUBLE)) AS min, "
        f"max(CAST({c} AS DOUBLE)) AS max, corr(CAST({c} AS DOUBLE), severity_score) AS corr FROM enriched"
        for c in spatial.FEATURES) + ") t", LABELLED_CTE, *SPATIAL_CTES))
def q_spatial_feature_summary(spark, sf):
    s = spatial.feature_summary(PF.spatial_enriched(crashes(spark, sf)))
    return s.select("feature", F.round("mean", 6).alias("mean"), "min", "max",
                    F.round("corr", 6).alias("corr"))


# ---------------------------------------------------------------- feature matrices in long form

def _long_sql(src: str, keys: list[str], numeric: list[tuple[str, str]],
              cats: list[tuple[str, str, str]]) -> str:
    """Long-form feature SQL: numeric (name, expr) parts and categorical
    (prefix, value-expr, allowed-values-CTE) parts with sanitize + dedupe."""
    k = ", ".join(keys)
    parts = [f"SELECT {k}, '{n}' AS feature, CAST({e} AS DOUBLE) AS value FROM {src}"
             for n, e in numeric]
    for prefix, vexpr, allowed in cats:
        parts.append(
            f"SELECT {k}, f.feature, CASE WHEN {vexpr} = f.v THEN 1.0 ELSE 0.0 END AS value "
            f"FROM {src} CROSS JOIN (SELECT v, san || CASE WHEN dup > 0 THEN '_' || CAST(dup AS VARCHAR) "
            f"ELSE '' END AS feature FROM (SELECT v, san, row_number() OVER (PARTITION BY san ORDER BY v) - 1 "
            f"AS dup FROM (SELECT v, regexp_replace('{prefix}_' || v, '[^A-Za-z0-9_]', '_', 'g') AS san "
            f"FROM {allowed}) a) b) f")
    return " UNION ALL ".join(parts)


def _med(col: str, src: str) -> str:
    return f"COALESCE({col}, (SELECT COALESCE(median({col}), 0) FROM {src}))"


_V4_CTES = (LABELLED_CTE,) + SPATIAL_CTES + (
    TIME_CTE.format(src="enriched"),
    "v4rows AS (SELECT *, " + RUSH_V2 + " AS is_rush_hour, " + LIGHT_TRAIN + " AS light_phase, "
    "CASE WHEN day_of_week >= 5 THEN 1 ELSE 0 END AS is_weekend, "
    "COALESCE(weath_cond_descr, 'Unknown') AS wv FROM timed WHERE ts IS NOT NULL)",
    "v4weather AS (SELECT wv AS v FROM v4rows GROUP BY wv HAVING COUNT(*) >= 50)",
    "v4light AS (SELECT DISTINCT light_phase AS v FROM v4rows)",
)
_V4_NUM = ([("lat", "lat"), ("lon", "lon"), ("speed_limit", _med("speed_limit", "v4rows"))]
           + [(c, c) for c in ["hour_of_day", "day_of_week", "month", "is_weekend", "is_rush_hour"]]
           + [(c, c) for c in spatial.FEATURES])


@register("features_v4_long", with_crashes(
    _long_sql("v4rows", ["crash_id", "severity_class", "is_test"], _V4_NUM,
              [("weath_cond_descr", "wv", "v4weather"), ("light_phase", "light_phase", "v4light")]),
    *_V4_CTES))
def q_features_v4_long(spark, sf):
    return PF.build_v4(PF.spatial_enriched(crashes(spark, sf))).long()


@register("weather_keep_columns", with_crashes(
    "SELECT regexp_replace('weath_cond_descr_' || wv, '[^A-Za-z0-9_]', '_', 'g') AS feature, "
    "COUNT(*) AS rows FROM v4rows GROUP BY wv HAVING COUNT(*) >= 50", *_V4_CTES))
def q_weather_keep_columns(spark, sf):
    from crashlens.functions.names import sanitize_col
    from crashlens.operators import onehot
    # the spatial columns are never null, so the counts need no radius join
    rows = PF._v2_rows(PF.labelled(crashes(spark, sf)))
    return (rows.groupBy(onehot.filled("weath_cond_descr").alias("wv"))
            .agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= 50)
            .select(sanitize_col(F.concat(F.lit("weath_cond_descr_"), F.col("wv"))).alias("feature"),
                    "rows"))


_V2_CTES = (LABELLED_CTE, TIME_CTE.format(src="labelled"),
            "v2rows AS (SELECT *, " + RUSH_V2 + " AS is_rush_hour, " + LIGHT_TRAIN + " AS light_phase, "
            "CASE WHEN day_of_week >= 5 THEN 1 ELSE 0 END AS is_weekend, "
            "COALESCE(weath_cond_descr, 'Unknown') AS wv FROM timed "
            "WHERE ts IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL)",
            "v2weather AS (SELECT DISTINCT wv AS v FROM v2rows)",
            "v2light AS (SELECT DISTINCT light_phase AS v FROM v2rows)")


@register("features_v2_long", with_crashes(
    _long_sql("v2rows", ["crash_id", "severity_class"],
              [("lat", "lat"), ("lon", "lon"), ("speed_limit", _med("speed_limit", "v2rows"))]
              + [(c, c) for c in ["hour_of_day", "day_of_week", "month", "is_weekend", "is_rush_hour"]],
              [("weath_cond_descr", "wv", "v2weather"), ("light_phase", "light_phase", "v2light")]),
    *_V2_CTES))
def q_features_v2_long(spark, sf):
    return PF.build_v2(crashes(spark, sf)).long()


_V1_CATS = ["weath_cond_descr", "road_surf_cond_descr", "ambnt_light_descr", "manr_coll_descr",
            "rdwy_jnct_type_descr", "city_town_name"]
_V1_CTES = (LABELLED_CTE, TIME_CTE.format(src="labelled"),
            "v1rows AS (SELECT *, " + RUSH_V1 + " AS is_rush_hour, "
            "CASE WHEN day_of_week >= 5 THEN 1 ELSE 0 END AS is_weekend FROM timed)") + tuple(
    f"v1_{c} AS (SELECT DISTINCT COALESCE({c}, 'Unknown') AS v FROM v1rows)" for c in _V1_CATS)
_V1_NUM = [(c, _med(c, "v1rows")) for c in ["speed_limit", "numb_vehc", "ems_hotspot_flag",
                                              "ems_ped_hotspot_flag", "ems_peak_hour", "district_num",
                                              "lat", "lon", "hour_of_day", "day_of_week", "month"]]
_V1_NUM += [("is_weekend", "is_weekend"), ("is_rush_hour", "is_rush_hour")]


@register("features_v1_long", with_crashes(
    _long_sql("v1rows", ["crash_id", "severity_class"], _V1_NUM,
              [(c, f"COALESCE({c}, 'Unknown')", f"v1_{c}") for c in _V1_CATS]),
    *_V1_CTES))
def q_features_v1_long(spark, sf):
    return PF.build_v1(crashes(spark, sf)).long()


# ---------------------------------------------------------------- metrics and thresholds

from crashlens import constants as K  # noqa: E402
from crashlens.operators import metrics as M  # noqa: E402


def scored_fixture(spark, sf) -> DataFrame:
    """Held-out rows with formula probabilities (High, Low, Medium) summing to 1."""
    base = PF.labelled(crashes(spark, sf)).where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    rows = split.stratified_split(base).where(F.col("is_test"))
    cid, cls = F.col("crash_id"), F.col("severity_class")

    def raw(mult, div, c, bump):
        return (F.pmod(cid * mult, F.lit(100)).cast("double") / F.lit(float(div))
                + F.when(cls == c, F.lit(bump)).otherwise(F.lit(0.0)))
    ph, pm, pl = raw(37, 400, "High", 0.3), raw(53, 250, "Medium", 0.2), raw(71, 100, "Low", 0.3)
    s = ph + pm + pl
    return rows.select("crash_id", cls.alias("label"), (ph / s).alias("p_high"),
                       (pl / s).alias("p_low"), (pm / s).alias("p_medium"))


PROB_COLS = ["p_high", "p_low", "p_medium"]


def _raw_sql(mult, div, c, bump):
    return (f"(CAST((crash_id * {mult}) % 100 AS DOUBLE) / CAST({div} AS DOUBLE) + CASE WHEN "
            f"severity_class = '{c}' THEN CAST({bump} AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)")


SCORED_CTES = (LABELLED_CTE,) + SPLIT_CTES + (
    "raws AS (SELECT crash_id, severity_class AS label, " + _raw_sql(37, 400, "High", 0.3) + " AS ph, "
    + _raw_sql(53, 250, "Medium", 0.2) + " AS pm, " + _raw_sql(71, 100, "Low", 0.3)
    + " AS pl FROM splitted WHERE is_test)",
    "scored AS (SELECT crash_id, label, ph / (ph + pm + pl) AS p_high, pl / (ph + pm + pl) AS p_low, "
    "pm / (ph + pm + pl) AS p_medium FROM raws)",
    "argmaxed AS (SELECT *, CASE WHEN p_high >= p_low AND p_high >= p_medium THEN 'High' "
    "WHEN p_low >= p_medium THEN 'Low' ELSE 'Medium' END AS am FROM scored)",
    "predicted AS (SELECT *, am AS pred_default, CASE "
    "WHEN NOT (p_high >= 0.15 OR p_low >= 0.25 OR p_medium >= CAST(0.4 AS DOUBLE)) THEN am "
    "WHEN p_high >= 0.15 AND (NOT p_low >= 0.25 OR p_high >= p_low) "
    "AND (NOT p_medium >= CAST(0.4 AS DOUBLE) OR p_high >= p_medium) THEN 'High' "
    "WHEN p_low >= 0.25 AND (NOT p_medium >= CAST(0.4 AS DOUBLE) OR p_low >= p_medium) THEN 'Low' "
    "ELSE 'Medium' END AS pred_tuned FROM argmaxed)",
)


def _report_sql(pred: str) -> str:
    return (
        f"per AS (SELECT c.cls AS class, "
        f"SUM(CASE WHEN label = c.cls AND {pred} = c.cls THEN 1 ELSE 0 END) AS tp, "
        f"SUM(CASE WHEN label <> c.cls AND {pred} = c.cls THEN 1 ELSE 0 END) AS fp, "
        f"SUM(CASE WHEN label = c.cls AND {pred} <> c.cls THEN 1 ELSE 0 END) AS fn, "
        f"COUNT(*) AS total FROM predicted CROSS JOIN (VALUES ('High'), ('Low'), ('Medium')) c(cls) "
        f"GROUP BY c.cls)",
        "m AS (SELECT class, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision, "
        "CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall, "
        "CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1, "
        "tp + fn AS support, tp, total FROM per)",
        "rep AS (SELECT class, precision, recall, f1, support FROM m UNION ALL "
        "SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM m UNION ALL "
        "SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), "
        "sum(f1 * support) / sum(support), sum(support) FROM m UNION ALL "
        "SELECT 'accuracy', sum(tp) / max(total), sum(tp) / max(total), sum(tp) / max(total), max(total) FROM m)")


def _report_spark(df: DataFrame) -> DataFrame:
    return df.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")],
                     F.col("support").cast("long").alias("support"))


_REPORT_BODY = ("SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, "
                "round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM rep")


@register("classification_report_default",
          with_crashes(_REPORT_BODY, *SCORED_CTES, *_report_sql("pred_default")))
def q_classification_report_default(spark, sf):
    sc = scored_fixture(spark, sf).withColumn("prediction", M.argmax_class(PROB_COLS))
    return _report_spark(M.class_report(sc))


@register("classification_report_thresholded",
          with_crashes(_REPORT_BODY, *SCORED_CTES, *_report_sql("pred_tuned")))
def q_classification_report_thresholded(spark, sf):
    sc = M.apply_thresholds(scored_fixture(spark, sf), PROB_COLS, K.DEFAULT_THRESHOLDS)
    return _report_spark(M.class_report(sc))


@register("confusion_matrix", with_crashes(
    "SELECT label, CAST(SUM(CASE WHEN pred_tuned = 'High' THEN 1 ELSE 0 END) AS BIGINT) AS High, "
    "CAST(SUM(CASE WHEN pred_tuned = 'Low' THEN 1 ELSE 0 END) AS BIGINT) AS Low, "
    "CAST(SUM(CASE WHEN pred_tuned = 'Medium' THEN 1 ELSE 0 END) AS BIGINT) AS Medium "
    "FROM predicted GROUP BY label", *SCORED_CTES))
def q_confusion_matrix(spark, sf):
    sc = M.apply_thresholds(scored_fixture(spark, sf), PROB_COLS, K.DEFAULT_THRESHOLDS)
    return M.confusion_matrix(sc)


@register("threshold_search", with_crashes(
    "SELECT class, COALESCE(round(CAST(0.1 AS DOUBLE) + CAST(k AS DOUBLE) * CAST(0.05 AS DOUBLE), 2), 0.5) "
    "AS threshold, round(COALESCE(f1, 0.0), 6) AS binary_f1 FROM (VALUES ('High'), ('Low'), ('Medium')) c(class) "
    "LEFT JOIN (SELECT cls, k, f1 FROM (SELECT *, row_number() OVER (PARTITION BY cls ORDER BY f1 DESC, k) AS r "
    "FROM (SELECT cls, k, tp, fp, 2.0 * tp / (2 * tp + fp + fn) AS f1 FROM (SELECT cls, k, "
    "SUM(CASE WHEN pos AND p >= t THEN 1 ELSE 0 END) AS tp, SUM(CASE WHEN NOT pos AND p >= t THEN 1 ELSE 0 END) AS fp, "
    "SUM(CASE WHEN pos AND NOT p >= t THEN 1 ELSE 0 END) AS fn FROM (SELECT 'High' AS cls, label = 'High' AS pos, "
    "p_high AS p FROM scored UNION ALL SELECT 'Low', label = 'Low', p_low FROM scored UNION ALL SELECT 'Medium', "
    "label = 'Medium', p_medium FROM scored) s CROSS JOIN (SELECT range AS k, CAST(0.1 AS DOUBLE) + "
    "CAST(range AS DOUBLE) * CAST(0.05 AS DOUBLE) AS t FROM range(17)) g GROUP BY cls, k) a "
    "WHERE tp + fp > 0) b WHERE f1 > 0) x WHERE r = 1) best ON best.cls = c.class", *SCORED_CTES))
def q_threshold_search(spark, sf):
    t = M.tune_thresholds(scored_fixture(spark, sf), PROB_COLS)
    return t.select("class", "threshold", F.round("binary_f1", 6).alias("binary_f1"))


@register("binary_metrics", with_crashes(
    "SELECT round(acc, 6) AS accuracy, round(bf1, 6) AS binary_f1, round(mf1, 6) AS macro_f1, "
    "round(auc, 6) AS roc_auc FROM (SELECT (tp + tn) / (tp + tn + fp + fn) AS acc, "
    "CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0 END AS bf1, "
    "((CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0 END) + "
    "(CASE WHEN 2 * tn + fn + fp > 0 THEN 2.0 * tn / (2 * tn + fn + fp) ELSE 0 END)) / 2 AS mf1 FROM "
    "(SELECT SUM(CASE WHEN y = 1 AND yh = 1 THEN 1 ELSE 0 END) AS tp, SUM(CASE WHEN y = 0 AND yh = 1 THEN 1 ELSE 0 END) AS fp, "
    "SUM(CASE WHEN y = 1 AND yh = 0 THEN 1 ELSE 0 END) AS fn, SUM(CASE WHEN y = 0 AND yh = 0 THEN 1 ELSE 0 END) AS tn "
    "FROM bin) c) m, (SELECT SUM(pos * (nb + 0.5 * neg)) / (SUM(pos) * SUM(neg)) AS auc FROM (SELECT s, pos, neg, "
    "COALESCE(SUM(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM "
    "(SELECT s, SUM(y) AS pos, SUM(1 - y) AS neg FROM bin GROUP BY s) g) h) a",
    *SCORED_CTES, "bin AS (SELECT CASE WHEN label <> 'Low' THEN 1 ELSE 0 END AS y, p_high + p_medium AS s, "
    "CASE WHEN p_high + p_medium >= 0.5 THEN 1 ELSE 0 END AS yh FROM scored)"))
def q_binary_metrics(spark, sf):
    sc = scored_fixture(spark, sf)
    b = sc.select(FX.binary_target("label").alias("label"),
                  (F.col("p_high") + F.col("p_medium")).alias("p_elevated"))
    b = b.withColumn("prediction", (F.col("p_elevated") >= 0.5).cast("int"))
    m = M.binary_metrics(b, "label", "prediction", "p_elevated")
    return m.select(*[F.round(c, 6).alias(c) for c in ("accuracy", "binary_f1", "macro_f1", "roc_auc")])


@register("model_choice", with_crashes(
    "SELECT name, round(macro_f1, 6) AS macro_f1, row_number() OVER (ORDER BY macro_f1 DESC, name) AS rank, "
    "max(macro_f1) OVER () > 0.3894 AS deploy FROM (SELECT 'argmax' AS name, f1 AS macro_f1 FROM "
    "(SELECT * FROM (WITH " + ", ".join(_report_sql("pred_default")) + " SELECT * FROM rep) r1) x1 "
    "WHERE class = 'macro avg' UNION ALL SELECT 'thresholds_v4', f1 FROM (SELECT * FROM (WITH "
    + ", ".join(_report_sql("pred_tuned")) + " SELECT * FROM rep) r2) x2 WHERE class = 'macro avg') t",
    *SCORED_CTES))
def q_model_choice(spark, sf):
    sc = scored_fixture(spark, sf)
    a = M.summary_metrics(M.class_report(sc.withColumn("prediction", M.argmax_class(PROB_COLS))))
    b = M.summary_metrics(M.class_report(M.apply_thresholds(sc, PROB_COLS, K.DEFAULT_THRESHOLDS)))
    res = (a.select(F.lit("argmax").alias("name"), "macro_f1")
           .unionByName(b.select(F.lit("thresholds_v4").alias("name"), "macro_f1")))
    ranked = M.rank_models(res)
    best = F.max("macro_f1").over(Window.partitionBy())
    return ranked.select("name", F.round("macro_f1", 6).alias("macro_f1"), "rank",
                         M.deploy_decision(best, best).alias("deploy"))


# ---------------------------------------------------------------- routes

from crashlens.operators import routes as RT  # noqa: E402
from crashlens.plans import route_risk as RR  # noqa: E402
from crashlens.sources import fixtures as FXT  # noqa: E402
from crashlens.sources import payloads as PL  # noqa: E402


def _route_tbl(spark, sf):
    return RR.parsed_routes(FXT.route_payloads(spark, sf))


def serving_feature_names(spark, sf) -> list[str]:
    """v4 feature names as training would produce them on this data: the
    numeric and spatial columns, weather values with >= 50 rows among the
    usable training rows, and the light phases present."""
    rows = PF._v2_rows(PF.labelled(crashes(spark, sf)))
    wc, lights, _ = PF._profile(rows, [])
    from crashlens.functions.names import clean_names, sanitize
    weather = []
    for v, n in wc:
        nm = sanitize(f"weath_cond_descr_{v}")
        if n >= K.WEATHER_MIN_SUM and nm not in weather:
            weather.append(nm)
    return clean_names(list(K.V2_NUMERIC_COLS) + list(K.SPATIAL_COLS) + weather
                       + [f"light_phase_{v}" for v in lights])


def _serving(spark, sf):
    from crashlens.session import stage_table
    rp = stage_table(FXT.route_payloads(spark, sf), "route_payloads")
    _, segs = RR.prepare_segments(rp)
    req_time = RR.request_time_features(rp)
    weather, _ = PL.parse_weather(FXT.weather_payloads(spark, sf))
    names = serving_feature_names(spark, sf)
    feats = RR.segment_features(segs, req_time, weather, RR.serving_history(crashes(spark, sf)), names)
    return feats, names


@register("route_geometry")
def q_route_geometry(spark, sf):
    r = _route_tbl(spark, sf)
    return r.select("request_id", "route_idx", "duration_seconds", "duration_minutes", "distance_meters",
                    "distance_km", "distance_miles", "num_points", "base_speed_mph",
                    F.col("start_coords.lat").alias("start_lat"), F.col("start_coords.lng").alias("start_lng"),
                    F.col("midpoint_coords.lat").alias("mid_lat"), F.col("midpoint_coords.lng").alias("mid_lng"),
                    F.col("end_coords.lat").alias("end_lat"), F.col("end_coords.lng").alias("end_lng"))


@register("route_requests")
def q_route_requests(spark, sf):
    return RT.request_summary(_route_tbl(spark, sf))


@register("route_segments")
def q_route_segments(spark, sf):
    s = RT.segments(_route_tbl(spark, sf))
    return s.select("request_id", "route_idx", "segment_idx", "polyline_index", "lat", "lng",
                    "speed_limit", "distance_from_start_miles")


@register("weather_parsed")
def q_weather_parsed(spark, sf):
    return PL.parse_weather(FXT.weather_payloads(spark, sf))[0]


@register("weather_rejected")
def q_weather_rejected(spark, sf):
    return PL.parse_weather(FXT.weather_payloads(spark, sf))[1].select("request_id", "reason")


@register("reverse_geocode_parsed")
def q_reverse_geocode_parsed(spark, sf):
    return PL.parse_reverse_geocode(FXT.geocode_payloads(spark, sf))


@register("routes_rejected", (
    "SELECT DISTINCT user_id AS request_id, CASE WHEN user_id % 5 = 4 THEN NULL ELSE CAST(1 AS INT) END AS route_idx, "
    "CASE user_id % 5 WHEN 4 THEN 'no route list' WHEN 2 THEN 'malformed polyline' ELSE 'malformed duration' END "
    "AS reason FROM events WHERE user_id % 5 <> 3"))
def q_routes_rejected(spark, sf):
    return PL.rejected_routes(FXT.malformed_route_payloads(spark, sf))


@register("geocode_parsed", with_crashes(
    "SELECT 'Crash site ' || crash_id AS address, CASE WHEN ok THEN 'OK' ELSE 'ZERO_RESULTS' END AS status, "
    "CASE WHEN ok THEN round(lat, 6) END AS lat, CASE WHEN ok THEN round(lon, 6) END AS lng, "
    "CASE WHEN ok THEN crash_id || ' Harbor Rd, Boston, MA' END AS formatted_address, "
    "CASE WHEN ok THEN 'place-' || crash_id END AS place_id, CASE WHEN ok THEN 'ROOFTOP' END AS location_type "
    "FROM (SELECT *, crash_id % 19 <> 0 AS ok FROM crashes WHERE lat IS NOT NULL) t"))
def q_geocode_parsed(spark, sf):
    g = PL.parse_geocode(FXT.forward_geocode_payloads(spark, sf))
    return g.withColumns({c: F.round(c, 6) for c in ("lat", "lng")})


@register("request_time_features")
def q_request_time_features(spark, sf):
    t = RR.request_time_features(FXT.route_payloads(spark, sf))
    return t.select("request_id", F.col("local_time").cast("string").alias("local_time"), "hour_of_day",
                    "day_of_week", "month", "is_weekend", "is_rush_hour", "light_phase")


@register("serving_features_long")
def q_serving_features_long(spark, sf):
    feats, names = _serving(spark, sf)
    return PF.to_long(feats, RR.SEG_KEYS, names)


def _scored_segments(spark, sf):
    feats, _ = _serving(spark, sf)
    return RR.formula_scores(feats)


@register("segment_risk")
def q_segment_risk(spark, sf):
    from crashlens.operators import rollup
    seg = rollup.segment_risk(_scored_segments(spark, sf), RR.PROB_COLS, K.DEFAULT_THRESHOLDS)
    return seg.select(*RR.SEG_KEYS, "risk_class", "confidence", "p_high_r", "p_low_r", "p_medium_r",
                      "is_hotspot", "estimated_minutes_from_start")


@register("route_rollup")
def q_route_rollup(spark, sf):
    per_route, _ = RR.route_risk(_scored_segments(spark, sf), nested=False)
    return per_route.select("request_id", "route_idx", "overall_risk_class", "overall_confidence",
                            "avg_high", "avg_low", "avg_medium", "num_hotspots", "num_high_hotspots",
                            "num_medium_hotspots", "safety_score", "is_default", "label")


@register("route_recommendation")
def q_route_recommendation(spark, sf):
    _, rec = RR.route_risk(_scored_segments(spark, sf), nested=False)
    return rec


# ----- oracle SQL for the route chain (relational re-derivation, no JSON)

def _dbl(x) -> str:
    return f"CAST({x} AS DOUBLE)"


def _xr(x: str, d: int) -> str:
    """Round as Python does (exact binary value) via DuckDB's exact printf."""
    return f"CAST(printf('%.{d}f', {x}) AS DOUBLE)"


_LAT = next(e for e in __import__("crashlens.sources.tables", fromlist=["x"]).CRASH_EXPRS if e.endswith(" AS lat"))
_LON = next(e for e in __import__("crashlens.sources.tables", fromlist=["x"]).CRASH_EXPRS if e.endswith(" AS lon"))
_Q = "CAST(sign({c} * CAST(100000 AS DOUBLE)) * floor(abs({c} * CAST(100000 AS DOUBLE)) + 0.5) AS DOUBLE) / CAST(100000 AS DOUBLE)"
ROUTE_CTES = (
    f"pts AS (SELECT user_id AS request_id, CAST(event_id % 3 AS INT) AS route_key, event_id, ts, lat, lon "
    f"FROM (SELECT event_id, user_id, ts, {_LAT}, {_LON} FROM events) e WHERE lat IS NOT NULL)",
    "qp AS (SELECT request_id, route_key, event_id, ts, " + _Q.format(c="lat") + " AS plat, "
    + _Q.format(c="lon") + " AS plng, row_number() OVER (PARTITION BY request_id, route_key "
    "ORDER BY ts, event_id) - 1 AS pidx, count(*) OVER (PARTITION BY request_id, route_key) AS n FROM pts)",
    "ro AS (SELECT request_id, route_key, n, dense_rank() OVER (PARTITION BY request_id ORDER BY route_key) - 1 "
    "AS route_idx, 60 + (request_id * 37 + route_key * 101) % 3000 AS duration_seconds, "
    "400 + (request_id * 131 + route_key * 977) % 20000 AS distance_meters, "
    "CASE request_id % 6 WHEN 1 THEN 2 WHEN 2 THEN 23 ELSE 12 END AS num_segments "
    "FROM (SELECT DISTINCT request_id, route_key, n FROM qp) t)",
    "rt AS (SELECT *, " + _xr("duration_seconds / CAST(60 AS DOUBLE)", 2) + " AS duration_minutes, "
    + _xr("distance_meters / CAST(1000 AS DOUBLE)", 3) + " AS distance_km, "
    + _xr("distance_meters / CAST(1609.344 AS DOUBLE)", 3) + " AS distance_miles FROM ro)",
    "rt2 AS (SELECT *, CASE WHEN distance_miles < 2 THEN CAST(25 AS DOUBLE) WHEN distance_miles < 10 "
    "THEN CAST(35 AS DOUBLE) ELSE CAST(55 AS DOUBLE) END AS base_speed_mph FROM rt)",
    "samp AS (SELECT r.*, k AS segment_idx, CASE WHEN k = least(num_segments, n) - 1 THEN n - 1 "
    "ELSE k * greatest(1, n // least(num_segments, n)) END AS polyline_index FROM rt2 r "
    "CROSS JOIN range(0, 23) g(k) WHERE n >= 2 AND k < least(num_segments, n))",
    "seg AS (SELECT s.*, q.plat AS lat, q.plng AS lng, "
    "CASE WHEN s.request_id % 4 = 1 AND s.polyline_index BETWEEN 0 AND 1 THEN 'TRAFFIC_JAM' "
    "WHEN s.request_id % 4 <> 0 AND s.polyline_index BETWEEN (s.n * 2) // 3 - 1 AND s.n + 1 THEN "
    "CASE WHEN s.route_key % 3 = 2 THEN 'TRAFFIC_JAM' ELSE 'SLOW' END "
    "WHEN s.request_id % 4 <> 0 AND s.polyline_index BETWEEN s.n // 3 AND (s.n * 2) // 3 THEN 'SLOW' "
    "ELSE 'NORMAL' END AS cat, "
    + _xr("CAST(s.polyline_index AS DOUBLE) / CAST(s.n - 1 AS DOUBLE) * s.distance_miles", 3) + " AS distance_from_start_miles "
    "FROM samp s JOIN qp q ON q.request_id = s.request_id AND q.route_key = s.route_key "
    "AND q.pidx = s.polyline_index)",
    "seg2 AS (SELECT *, CASE cat WHEN 'SLOW' THEN greatest(CAST(15 AS DOUBLE), base_speed_mph - 10) "
    "WHEN 'TRAFFIC_JAM' THEN greatest(CAST(10 AS DOUBLE), base_speed_mph - 20) ELSE base_speed_mph END "
    "AS speed_limit FROM seg)",
)
ORACLE["route_geometry"] = with_crashes(
    "SELECT r.request_id, r.route_idx, duration_seconds, duration_minutes, distance_meters, distance_km, "
    "distance_miles, r.n AS num_points, base_speed_mph, s.plat AS start_lat, s.plng AS start_lng, "
    "m.plat AS mid_lat, m.plng AS mid_lng, e.plat AS end_lat, e.plng AS end_lng FROM rt2 r "
    "JOIN qp s ON s.request_id = r.request_id AND s.route_key = r.route_key AND s.pidx = 0 "
    "JOIN qp m ON m.request_id = r.request_id AND m.route_key = r.route_key AND m.pidx = r.n // 2 "
    "JOIN qp e ON e.request_id = r.request_id AND e.route_key = r.route_key AND e.pidx = r.n - 1",
    *ROUTE_CTES)
ORACLE["route_requests"] = with_crashes(
    "SELECT request_id, default_duration_seconds, default_duration_minutes, default_distance_miles, "
    "num_alternatives, CASE WHEN num_alternatives > 0 THEN " + _xr("greatest(default_duration_seconds - fastest, 0) "
    "/ CAST(60 AS DOUBLE)", 2) + " ELSE CAST(0 AS DOUBLE) END AS best_alternative_savings_minutes, "
    "NOT (default_distance_miles < 0.3 OR default_duration_minutes < 2.0) AS accepted, "
    "CASE WHEN default_distance_miles < 0.3 OR default_duration_minutes < 2.0 THEN "
    "'Route too short for meaningful prediction' END AS reject_reason FROM (SELECT request_id, "
    "max(CASE WHEN route_idx = 0 THEN duration_seconds END) AS default_duration_seconds, "
    "max(CASE WHEN route_idx = 0 THEN duration_minutes END) AS default_duration_minutes, "
    "max(CASE WHEN route_idx = 0 THEN distance_miles END) AS default_distance_miles, "
    "min(CASE WHEN route_idx > 0 THEN duration_seconds END) AS fastest, "
    "CAST(sum(CASE WHEN route_idx > 0 THEN 1 ELSE 0 END) AS BIGINT) AS num_alternatives FROM rt2 "
    "GROUP BY request_id) t", *ROUTE_CTES)
ORACLE["route_segments"] = with_crashes(
    "SELECT request_id, route_idx, segment_idx, polyline_index, lat, lng, speed_limit, "
    "distance_from_start_miles FROM seg2", *ROUTE_CTES)

_W_CONDS = ", ".join(f"'{c}'" for c in FXT.WEATHER_CONDITIONS)
WEATHER_CTES = ROUTE_CTES[:1] + (
    "reqs AS (SELECT DISTINCT request_id AS r FROM pts)",
    f"wx AS (SELECT r AS request_id, r, [{_W_CONDS}][r % 10 + 1] AS cond FROM reqs)",
    "wp AS (SELECT request_id, CASE WHEN r % 13 = 5 THEN 'Unknown' ELSE cond END AS condition, "
    "CASE WHEN r % 13 = 5 THEN 'unknown' ELSE lower(cond) END AS description, "
    "CAST(20 + r % 60 AS DOUBLE) AS temperature_f, CAST(20 + r % 60 AS DOUBLE) - 3 AS feels_like_f, "
    "CAST(30 + r % 70 AS BIGINT) AS humidity_pct, CAST(1000 + r % 30 AS BIGINT) AS pressure_hpa, "
    "CAST(CASE WHEN r % 4 = 0 THEN 0 ELSE 1000 * (r % 11) END AS BIGINT) AS visibility_meters, "
    "CAST(r % 20 AS DOUBLE) * 1.5 AS wind_speed_mph, CAST((r * 7) % 360 AS BIGINT) AS wind_direction_deg, "
    "CASE WHEN r % 3 = 0 THEN CAST(0 AS DOUBLE) ELSE 2.5 END AS wind_gust_mph, "
    "CAST(r % 100 AS BIGINT) AS clouds_pct, "
    "CASE WHEN cond IN ('Rain', 'Drizzle') AND r % 13 <> 5 THEN 0.5 ELSE CAST(0 AS DOUBLE) END AS rain_1h_mm, "
    "CASE WHEN cond = 'Snow' AND r % 13 <> 5 THEN 1.2 ELSE CAST(0 AS DOUBLE) END AS snow_1h_mm "
    "FROM wx WHERE r % 17 <> 3)",
)
ORACLE["weather_parsed"] = with_crashes(
    "SELECT *, rain_1h_mm > 0 OR snow_1h_mm > 0 AS is_precipitation, visibility_meters < 5000 AS "
    "is_low_visibility FROM wp", *WEATHER_CTES)
ORACLE["weather_rejected"] = with_crashes(
    "SELECT r AS request_id, 'missing weather or main fields' AS reason FROM reqs WHERE r % 17 = 3",
    *WEATHER_CTES)
ORACLE["reverse_geocode_parsed"] = with_crashes(
    "SELECT lat, lng, street_name, neighborhood, CASE WHEN k % 19 = 0 THEN NULL "
    "WHEN street_name IS NOT NULL AND neighborhood IS NOT NULL THEN street_name || ', ' || neighborhood "
    "WHEN street_name IS NOT NULL THEN street_name WHEN neighborhood IS NOT NULL THEN neighborhood "
    "WHEN k % 11 <> 0 THEN CAST(k AS VARCHAR) || ' Harbor Rd, Boston, MA' "
    "ELSE printf('%.4f, %.4f', lat, lng) END AS short_label, "
    "CASE WHEN k % 19 = 0 THEN NULL WHEN k % 11 <> 0 THEN CAST(k AS VARCHAR) || ' Harbor Rd, Boston, MA' "
    "ELSE '' END AS formatted_address FROM (SELECT lat, lng, k, "
    "CASE WHEN k % 19 = 0 OR k % 5 = 0 THEN NULL ELSE 'Street ' || CAST(k % 40 AS VARCHAR) END AS street_name, "
    "CASE WHEN k % 19 = 0 THEN NULL WHEN k % 3 = 0 THEN 'Back Bay' WHEN k % 3 = 1 THEN 'Allston' END "
    "AS neighborhood FROM (SELECT " + _Q.format(c="lat") + " AS lat, " + _Q.format(c="lon")
    + " AS lng, min(event_id) AS k FROM pts GROUP BY 1, 2) a) b", *ROUTE_CTES[:1])

RUSH_SERVE = ("CASE WHEN (hour_of_day BETWEEN 7 AND 9 OR hour_of_day BETWEEN 16 AND 19) AND day_of_week < 5 "
              "THEN 1 ELSE 0 END")
TIME_REQ_CTES = (
    "rq AS (SELECT request_id, min(ts) AS dep, max(ts) AS last_ts FROM pts GROUP BY request_id)",
    "rl AS (SELECT request_id, CASE WHEN request_id % 7 = 3 THEN timezone('America/New_York', "
    "last_ts AT TIME ZONE 'UTC') WHEN request_id % 2 = 0 THEN timezone('America/New_York', "
    "date_trunc('second', dep) AT TIME ZONE 'UTC') ELSE date_trunc('second', dep) END AS lt FROM rq)",
    "rtime AS (SELECT request_id, lt, hour(lt) AS hour_of_day, isodow(lt) - 1 AS day_of_week, "
    "month(lt) AS month FROM rl)",
    "rtf AS (SELECT *, CASE WHEN day_of_week >= 5 THEN 1 ELSE 0 END AS is_weekend, "
    f"{RUSH_SERVE} AS is_rush_hour, {LIGHT_SERVE} AS light_phase FROM rtime)",
)
ORACLE["request_time_features"] = with_crashes(
    "SELECT request_id, CAST(lt AS VARCHAR) AS local_time, hour_of_day, day_of_week, month, is_weekend, "
    "is_rush_hour, light_phase FROM rtf", *ROUTE_CTES[:1], *TIME_REQ_CTES)

_WMAP = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.WEATHER_CONDITION_MAP.items())
SERVE_CTES = ROUTE_CTES + WEATHER_CTES[1:] + TIME_REQ_CTES + (
    LABELLED_CTE, TIME_CTE.format(src="labelled"),
    "trows AS (SELECT *, COALESCE(weath_cond_descr, 'Unknown') AS wv, " + LIGHT_TRAIN + " AS lp FROM timed "
    "WHERE ts IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL)",
    "wkeep AS (SELECT DISTINCT regexp_replace('weath_cond_descr_' || wv, '[^A-Za-z0-9_]', '_', 'g') AS f "
    "FROM trows GROUP BY wv HAVING COUNT(*) >= 50)",
    "lkeep AS (SELECT DISTINCT lp FROM trows)",
    "hist AS (SELECT lat, lon, severity_class FROM labelled WHERE lat IS NOT NULL AND lon IS NOT NULL)",
    "sp AS (SELECT s.request_id, s.route_idx, s.segment_idx, "
    "count(*) FILTER (WHERE d <= 1000) AS n1, count(*) FILTER (WHERE d <= 1000 AND hs = 'High') AS f1, "
    "count(*) FILTER (WHERE d <= 1000 AND hs = 'Medium') AS i1, "
    "sum(CASE hs WHEN 'Medium' THEN 1.0 WHEN 'High' THEN 2.0 ELSE 0.0 END) FILTER (WHERE d <= 1000) AS s1, "
    "count(*) FILTER (WHERE d <= 500) AS n5, count(*) FILTER (WHERE d <= 500 AND hs = 'High') AS f5 "
    "FROM (SELECT q.request_id, q.route_idx, q.segment_idx, h.severity_class AS hs, "
    + HAV.replace("q.lon", "q.lng") + " AS d FROM seg2 q JOIN hist h ON h.lat BETWEEN q.lat - 0.0091 AND "
    "q.lat + 0.0091) s GROUP BY 1, 2, 3)",
    "sfeat AS (SELECT g.*, t.hour_of_day, t.day_of_week, t.month, t.is_weekend, t.is_rush_hour, "
    "t.light_phase, w.condition, "
    "COALESCE(p.n1, 0) AS nearby_crash_count_1km, COALESCE(p.f1, 0) AS nearby_fatal_count_1km, "
    "COALESCE(p.i1, 0) AS nearby_injury_count_1km, COALESCE(p.n5, 0) AS nearby_crash_count_500m, "
    "COALESCE(p.f5, 0) AS nearby_fatal_count_500m, "
    "CASE WHEN COALESCE(p.n1, 0) > 0 THEN p.s1 / p.n1 ELSE 0.0 END AS nearby_avg_severity_1km, "
    f"CASE w.condition {_WMAP} ELSE 'weath_cond_descr_Not_Reported' END AS wmapped "
    "FROM seg2 g JOIN rtf t ON t.request_id = g.request_id JOIN wp w ON w.request_id = g.request_id "
    "LEFT JOIN sp p ON p.request_id = g.request_id AND p.route_idx = g.route_idx "
    "AND p.segment_idx = g.segment_idx)",
    "sfeat2 AS (SELECT *, CASE WHEN wmapped IN (SELECT f FROM wkeep) THEN wmapped "
    "ELSE 'weath_cond_descr_Not_Reported' END AS wcol FROM sfeat)",
)
_SK = "request_id, route_idx, segment_idx"
ORACLE["serving_features_long"] = with_crashes(
    " UNION ALL ".join(
        [f"SELECT {_SK}, '{n}' AS feature, CAST({e} AS DOUBLE) AS value FROM sfeat2"
         for n, e in [("lat", "lat"), ("lon", "lng"), ("speed_limit", "speed_limit")]
         + [(c, c) for c in ["hour_of_day", "day_of_week", "month", "is_weekend", "is_rush_hour"]]
         + [(c, c) for c in spatial.FEATURES]]
        + [f"SELECT {_SK}, f AS feature, CASE WHEN wcol = f THEN 1.0 ELSE 0.0 END AS value "
           "FROM sfeat2 CROSS JOIN wkeep",
           f"SELECT {_SK}, 'light_phase_' || lp AS feature, CASE WHEN light_phase = lp THEN 1.0 ELSE 0.0 END "
           "AS value FROM sfeat2 CROSS JOIN lkeep"]), *SERVE_CTES)

RISK_CTES = SERVE_CTES + (
    "raw AS (SELECT *, " + _dbl(0.02) + " + nearby_fatal_count_1km * " + _dbl(0.05) + " + is_rush_hour * "
    + _dbl(0.05) + " AS ph, " + _dbl(0.2) + " + CAST(nearby_injury_count_1km % 7 AS DOUBLE) * " + _dbl(0.06)
    + " AS pm, " + _dbl(0.5) + " + CAST(segment_idx % 4 AS DOUBLE) * " + _dbl(0.1) + " AS pl FROM sfeat2)",
    "sc AS (SELECT *, ph / (ph + pm + pl) AS p_high, pl / (ph + pm + pl) AS p_low, "
    "pm / (ph + pm + pl) AS p_medium FROM raw)",
    "am AS (SELECT *, CASE WHEN p_high >= p_low AND p_high >= p_medium THEN 'High' "
    "WHEN p_low >= p_medium THEN 'Low' ELSE 'Medium' END AS amx FROM sc)",
    "rk AS (SELECT *, CASE WHEN NOT (p_high >= 0.15 OR p_low >= 0.25 OR p_medium >= CAST(0.4 AS DOUBLE)) "
    "THEN amx WHEN p_high >= 0.15 AND (NOT p_low >= 0.25 OR p_high >= p_low) "
    "AND (NOT p_medium >= CAST(0.4 AS DOUBLE) OR p_high >= p_medium) THEN 'High' "
    "WHEN p_low >= 0.25 AND (NOT p_medium >= CAST(0.4 AS DOUBLE) OR p_low >= p_medium) THEN 'Low' "
    "ELSE 'Medium' END AS risk_class FROM am)",
    "sr AS (SELECT *, " + _xr("greatest(p_high, p_low, p_medium)", 4) + " AS confidence, " + _xr("p_high", 4)
    + " AS p_high_r, " + _xr("p_low", 4) + " AS p_low_r, " + _xr("p_medium", 4) + " AS p_medium_r, "
    "risk_class IN ('Medium', 'High') AS "
    "is_hotspot, CASE risk_class WHEN 'High' THEN 2 WHEN 'Medium' THEN 1 ELSE 0 END AS risk_rank, "
    "CASE WHEN distance_miles > 0 THEN " + _xr("distance_from_start_miles / distance_miles * duration_minutes", 1) + " "
    "ELSE CAST(0 AS DOUBLE) END AS estimated_minutes_from_start FROM rk)",
    "rr AS (SELECT request_id, route_idx, arg_max(risk_class, risk_rank * 100000 - segment_idx) AS "
    "overall_risk_class, " + ", ".join(
        _xr(f"sum(CAST(round(p_{c}_r * 10000) AS BIGINT)) / (count(*) * CAST(10000 AS DOUBLE))", 4)
        + f" AS avg_{c}" for c in ("high", "low", "medium")) + ", CAST(sum(CASE WHEN is_hotspot THEN 1 ELSE 0 END) AS INT) AS "
    "num_hotspots, CAST(sum(CASE WHEN risk_class = 'High' THEN 1 ELSE 0 END) AS INT) AS num_high_hotspots, "
    "CAST(sum(CASE WHEN risk_class = 'Medium' THEN 1 ELSE 0 END) AS INT) AS num_medium_hotspots, "
    "max(duration_minutes) AS duration_minutes FROM sr GROUP BY request_id, route_idx)",
    "rr2 AS (SELECT *, " + _xr("CASE overall_risk_class WHEN 'High' THEN avg_high WHEN 'Low' THEN avg_low "
    "ELSE avg_medium END", 4) + " AS overall_confidence, " + _xr("CAST(num_high_hotspots AS DOUBLE) * "
    + _dbl(10) + " + CAST(num_medium_hotspots AS DOUBLE) * " + _dbl(3) + " + duration_minutes * "
    + _dbl(0.1), 3) + " AS safety_score, route_idx = 0 AS is_default, CASE WHEN route_idx = 0 THEN "
    "'Default route' ELSE 'Alternative ' || CAST(route_idx AS VARCHAR) END AS label FROM rr)",
)
ORACLE["segment_risk"] = with_crashes(
    f"SELECT {_SK}, risk_class, confidence, p_high_r, p_low_r, p_medium_r, is_hotspot, "
    "estimated_minutes_from_start FROM sr", *RISK_CTES)
ORACLE["route_rollup"] = with_crashes(
    "SELECT request_id, route_idx, overall_risk_class, overall_confidence, avg_high, avg_low, avg_medium, "
    "num_hotspots, num_high_hotspots, num_medium_hotspots, safety_score, is_default, label FROM rr2",
    *RISK_CTES)


def _fmt1_sql(x: str) -> str:
    return f"printf('%.1f', {x})"


_TD = "CAST(round(CAST(printf('%.1f', rec_dur - def_dur) AS DOUBLE) * 10) AS BIGINT)"
ORACLE["route_recommendation"] = with_crashes(
    "SELECT request_id, num_routes_analyzed, rec_idx AS recommended_route_index, 0 AS default_route_index, "
    "rec_safety AS recommended_safety_score, CASE WHEN num_routes_analyzed = 1 THEN "
    "'Only one route available — no comparison possible.' "
    "WHEN rec_idx = 0 AND rec_hot = 0 THEN 'Default route is already the safest: no elevated-risk hotspots detected.' "
    "WHEN rec_idx = 0 THEN 'Default route is the safest available with ' || CAST(rec_hot AS VARCHAR) || "
    "' hotspot(s) (' || CAST(rec_high AS VARCHAR) || ' high-risk).' "
    "ELSE rec_label || ' is safest: ' || CASE WHEN rec_high < def_high THEN CAST(def_high - rec_high AS VARCHAR) "
    "|| ' fewer high-risk hotspot(s) vs default route' WHEN rec_hot < def_hot THEN CAST(def_hot - rec_hot AS VARCHAR) "
    "|| ' fewer total hotspot(s) vs default route' ELSE 'lower safety score (' || " + _fmt1_sql("rec_safety")
    + " || ' vs ' || " + _fmt1_sql("def_safety") + " || ')' END || ', ' || CASE WHEN abs(" + _TD + ") < 5 THEN "
    "'at the same travel time' WHEN " + _TD + " > 0 THEN 'at cost of ' || " + _fmt1_sql(f"abs({_TD}) / 10.0")
    + " || ' extra min' ELSE 'saving ' || " + _fmt1_sql(f"abs({_TD}) / 10.0") + " || ' min' END || '.' END "
    "AS recommendation_reason FROM (SELECT r.request_id, c.n AS num_routes_analyzed, r.route_idx AS rec_idx, "
    "r.safety_score AS rec_safety, r.num_hotspots AS rec_hot, r.num_high_hotspots AS rec_high, r.label AS rec_label, "
    "r.duration_minutes AS rec_dur, d.safety_score AS def_safety, d.num_hotspots AS def_hot, "
    "d.num_high_hotspots AS def_high, d.duration_minutes AS def_dur FROM "
    "(SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY safety_score, route_idx) AS o FROM rr2) r "
    "JOIN (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY route_idx) AS o FROM rr2) d "
    "ON d.request_id = r.request_id AND d.o = 1 JOIN (SELECT request_id, count(*) AS n FROM rr2 GROUP BY 1) c "
    "ON c.request_id = r.request_id WHERE r.o = 1) x", *RISK_CTES)


# ---------------------------------------------------------------- models (G3, G4, G6, G7, G9, E4, D9) -- rows-only checks

from crashlens.plans import training as TRN  # noqa: E402


def _v4_matrix(spark, sf):
    from crashlens.session import stage_table
    fm = PF.build_v4(PF.spatial_enriched(crashes(spark, sf)))
    fm.df = stage_table(fm.df, "v4matrix")
    return fm


def _fit_eval(spark, sf, kind):
    fm = _v4_matrix(spark, sf)
    train, test = fm.df.where(~F.col("is_test")), fm.df.where(F.col("is_test"))
    m = TRN.fit(train, fm.features, kind)
    return TRN.evaluate(TRN.score(m, test), kind)


@register("model_logistic_v4")
def q_model_logistic_v4(spark, sf):
    return _fit_eval(spark, sf, "logistic")


@register("model_random_forest_v4")
def q_model_random_forest_v4(spark, sf):
    return _fit_eval(spark, sf, "random_forest")


@register("model_gbt_binary_v4")
def q_model_gbt_binary_v4(spark, sf):
    fm = _v4_matrix(spark, sf)
    train, test = fm.df.where(~F.col("is_test")), fm.df.where(F.col("is_test"))
    m = TRN.fit(train, fm.features, "gbt_binary")
    sc = TRN.score(m, test).select(FX.binary_target("severity_class").alias("label"),
                                   F.col("prediction").cast("int").alias("prediction"), "p_elevated")
    return M.binary_metrics(sc, "label", "prediction", "p_elevated")


@register("feature_importance_rf_v4")
def q_feature_importance_rf_v4(spark, sf):
    fm = _v4_matrix(spark, sf)
    m = TRN.fit(fm.df.where(~F.col("is_test")), fm.features, "random_forest")
    return TRN.feature_importance(m, fm.features, top_k=15)


def route_risk_job(spark, sf, kind: str = "random_forest", nested: bool = True):
    """End-to-end (G9): train on the crash history, then score every landed
    request's routes in one batch and roll up."""
    from crashlens.session import stage_table
    fm = _v4_matrix(spark, sf)
    model = TRN.fit(fm.df.where(~F.col("is_test")), fm.features, kind)
    rp = stage_table(FXT.route_payloads(spark, sf), "route_payloads")
    _, segs = RR.prepare_segments(rp)
    weather, _ = PL.parse_weather(FXT.weather_payloads(spark, sf))
    feats = RR.segment_features(segs, RR.request_time_features(rp), weather,
                                RR.serving_history(crashes(spark, sf)), fm.features)
    scored = TRN.score(model, feats)
    geo = PL.parse_reverse_geocode(FXT.geocode_payloads(spark, sf))
    return RR.route_risk(scored, K.DEFAULT_THRESHOLDS, geocoded=geo, nested=nested)


@register("route_risk_end_to_end")
def q_route_risk_end_to_end(spark, sf):
    per_route, rec = route_risk_job(spark, sf)
    return per_route.join(rec, "request_id")


# ---------------------------------------------------------------- streaming (S1) -- rows-only

@register("stream_route_scoring")
def q_stream_route_scoring(spark, sf):
    """Land the request feed as Parquet, stream it through the scoring job,
    read back the recommendations of all micro-batches."""
    import uuid

    from crashlens.session import ensure_checkpoint_dir
    from crashlens.streaming import route_feed
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex[:10]}"
    feed = FXT.route_payloads(spark, sf).join(FXT.weather_payloads(spark, sf), "request_id")
    feed.select(*[f.name for f in route_feed.FEED_SCHEMA.fields]).repartition(4) \
        .write.mode("overwrite").parquet(f"{base}/in")
    fm = _v4_matrix(spark, sf)
    model = TRN.fit(fm.df.where(~F.col("is_test")), fm.features, "random_forest")
    q = route_feed.start(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", model, fm.features,
                         RR.serving_history(crashes(spark, sf)), max_files_per_trigger=2)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out/recommendations")


# ---------------------------------------------------------------- resampling

from crashlens.operators import resample as RS  # noqa: E402
from crashlens.sources.tables import load_table  # noqa: E402

EMB_CLASS = "CASE WHEN label <= 6 THEN 'Low' WHEN label <= 8 THEN 'Medium' ELSE 'High' END"


def _embedding_classes(spark, sf):
    """All embeddings with an imbalanced 3-class target (70 / 20 / 10)."""
    e = load_table(spark, sf, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.expr(EMB_CLASS).alias("label"),
                    F.col("embedding").cast("array<double>").alias("vec"))


@register("knn_within_class_embeddings", (
    f"WITH e AS (SELECT vec_id AS id, {EMB_CLASS} AS cls, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), "
    "p AS (SELECT a.id, b.id AS nid, list_distance(a.v, b.v) AS d FROM e a JOIN e b ON a.cls = b.cls "
    "AND a.id <> b.id), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, nid) AS rk FROM p) "
    "SELECT id, CAST(rk AS INT) AS rank, nid AS neighbour_id, round(d, 6) AS dist FROM r WHERE rk <= 5"))
def q_knn_within_class_embeddings(spark, sf):
    nn = RS.knn_within_class(_embedding_classes(spark, sf), k=5, block=64)
    return nn.select("id", F.posexplode(F.arrays_zip("nn_ids", "nn_dists")).alias("pos", "x")) \
             .select("id", (F.col("pos") + 1).cast("int").alias("rank"),
                     F.col("x.nn_ids").alias("neighbour_id"), F.round(F.col("x.nn_dists"), 6).alias("dist"))


def _smote_counts(df):
    return (df.groupBy("label").agg(F.count(F.lit(1)).alias("rows"),
                                    F.sum(F.col("is_synthetic").cast("long")).alias("synthetic")))


def _md5_32(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


@register("smote_rows_embeddings", (
    f"WITH e AS (SELECT vec_id AS id, {EMB_CLASS} AS cls, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), "
    "sizes AS (SELECT cls, count(*) AS n, max(count(*)) OVER () - count(*) AS m FROM e GROUP BY cls), "
    "p AS (SELECT a.id, b.id AS nid, b.v AS nv, list_distance(a.v, b.v) AS d FROM e a JOIN e b ON a.cls = b.cls AND a.id <> b.id), "
    "nn AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, nid) AS rk, count(*) OVER (PARTITION BY id) AS have FROM p), "
    f"c AS (SELECT e.*, m // n + CAST(row_number() OVER (PARTITION BY e.cls ORDER BY {_md5_32("e.id || ':43'")}, e.id) <= m % n AS INT) AS q "
    "FROM e JOIN sizes ON e.cls = sizes.cls WHERE m > 0), "
    "s AS (SELECT id, cls, v, unnest(range(q)) AS j FROM c WHERE q > 0), "
    f"x AS (SELECT s.*, nn.nv, {_md5_32("s.id || ':' || j || ':49'")} / 4294967296.0::DOUBLE AS u FROM s JOIN nn ON s.id = nn.id "
    f"AND nn.rk = {_md5_32("s.id || ':' || j || ':42'")} % least(5, nn.have) + 1), "
    "y AS (SELECT cls, id, j, list_transform(range(1, len(v) + 1), lambda i: v[i] + u * (nv[i] - v[i])) AS w FROM x) "
    "SELECT cls AS label, id AS source_id, CAST(j AS INT) AS sample_no, round(w[1], 6) AS first, "
    "round(w[len(w)], 6) AS last, round(list_sum(w), 5) AS total FROM y"))
def q_smote_rows_embeddings(spark, sf):
    rows = RS.smote(_embedding_classes(spark, sf), k=5, block=64, probe=None).where("is_synthetic")
    return rows.select("label", "source_id", F.col("sample_no").cast("int").alias("sample_no"),
                       F.round(F.get("vec", 0), 6).alias("first"),
                       F.round(F.element_at("vec", -1), 6).alias("last"),
                       F.round(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x), 5).alias("total"))


@register("smote_counts_embeddings", (
    f"SELECT cls AS label, max(n) OVER () AS rows, max(n) OVER () - n AS synthetic FROM "
    f"(SELECT {EMB_CLASS} AS cls, count(*) AS n FROM embeddings GROUP BY 1) t"))
def q_smote_counts_embeddings(spark, sf):
    return _smote_counts(RS.smote(_embedding_classes(spark, sf), k=5, block=64, probe=None))


@register("smote_counts_v4_train", with_crashes(
    "SELECT severity_class AS label, max(n) OVER () AS rows, max(n) OVER () - n AS synthetic FROM "
    "(SELECT severity_class, count(*) AS n FROM v4rows WHERE NOT is_test GROUP BY 1) t", *_V4_CTES))
def q_smote_counts_v4_train(spark, sf):
    fm = PF.build_v4(PF.spatial_enriched(crashes(spark, sf)))
    train = fm.df.where(~F.col("is_test")).select(
        F.col("crash_id").alias("id"), F.col("severity_class").alias("label"),
        F.array(*[F.col(f) for f in fm.features]).alias("vec"))
    return _smote_counts(RS.smote(train, k=5, probe=None))


# ---------------------------------------------------------------- training jobs (G3-G5, G8): facts that SQL can state

#: Settings of the bundle query, which tells whether a bundle scores as its model does.
JOB = {"logistic": {"max_iter": 100}, "random_forest": {"trees": 50}}


def _sums_to_one(scored: DataFrame, by: str = "severity_class") -> DataFrame:
    p = [F.col(c) for c in PROB_COLS]
    fine = (F.abs(p[0] + p[1] + p[2] - 1) < 1e-9) & (F.least(*p) >= 0) & F.col("predicted_class").isin(*K.CLASSES)
    return scored.groupBy(by).agg(F.count(F.lit(1)).alias("test_rows"), F.sum(fine.cast("long")).alias("sums_to_one"))


@register("softmax_boosting_v4", with_crashes(
    "SELECT severity_class, count(*) AS test_rows, count(*) AS sums_to_one, CAST(20 AS BIGINT) AS rounds, "
    "true AS loss_falls_each_round FROM v4rows WHERE is_test GROUP BY severity_class", *_V4_CTES))
def q_softmax_boosting_v4(spark, sf):
    fm = _v4_matrix(spark, sf)
    model = TRN.fit(fm.df.where(~F.col("is_test")), fm.features, "softmax", rounds=20)
    falls = all(b < a for a, b in zip(model.losses, model.losses[1:]))
    return _sums_to_one(TRN.score(model, fm.df.where(F.col("is_test")))).withColumns(
        {"rounds": F.lit(len(model.rounds)).cast("long"), "loss_falls_each_round": F.lit(falls)})


def _version_sql(rows: str, ctes: tuple, smote: bool = False) -> str:
    train = "max(train) OVER ()" if smote else "train"
    return with_crashes(
        f"SELECT severity_class, {train} AS train_rows, {train} - train AS synthetic_rows, test AS test_rows, "
        "3 * test AS sums_to_one, true AS best_is_largest FROM (SELECT severity_class, "
        "count(*) FILTER (WHERE NOT is_test) AS train, count(*) FILTER (WHERE is_test) AS test FROM ("
        "SELECT severity_class, row_number() OVER (PARTITION BY severity_class ORDER BY "
        f"{_md5_32("crash_id || ':42'")}, crash_id) <= (count(*) OVER (PARTITION BY severity_class) * 20 + 99) // 100 "
        f"AS is_test FROM {rows}) a GROUP BY 1) b", *ctes)


def _version_facts(matrix, smote: bool = False) -> DataFrame:
    from functools import reduce
    job = TRN.train_version(matrix, smote=smote)
    f1 = {r["name"]: r["macro_f1"] for r in job["results"].collect()}  # a row a model
    made = F.sum(F.col("is_synthetic").cast("long")) if smote else F.lit(0).cast("long")
    train = job["train"].groupBy("severity_class").agg(F.count(F.lit(1)).alias("train_rows"), made.alias("synthetic_rows"))
    scored = reduce(DataFrame.unionByName, [_sums_to_one(s) for s in job["scored"].values()])
    scored = scored.groupBy("severity_class").agg(F.max("test_rows").alias("test_rows"),
                                                  F.sum("sums_to_one").alias("sums_to_one"))
    return train.join(scored, "severity_class").withColumn("best_is_largest", F.lit(f1[job["best"]] == max(f1.values())))


@register("training_v1", _version_sql("v1rows", _V1_CTES))
def q_training_v1(spark, sf):
    return _version_facts(PF.build_v1(crashes(spark, sf)))


@register("training_v2", _version_sql("v2rows", _V2_CTES))
def q_training_v2(spark, sf):
    return _version_facts(PF.build_v2(crashes(spark, sf)))


@register("training_v3_smote", _version_sql("v2rows", _V2_CTES, smote=True))
def q_training_v3_smote(spark, sf):
    return _version_facts(PF.build_v2(crashes(spark, sf)), smote=True)


# ---------------------------------------------------------------- nested results, labels, whole routes

_GEO_CTES = (
    "places AS (SELECT lat, lng, k, CASE WHEN k % 5 = 0 THEN NULL ELSE 'Street ' || CAST(k % 40 AS VARCHAR) END "
    "AS street_name, CASE WHEN k % 3 = 0 THEN 'Back Bay' WHEN k % 3 = 1 THEN 'Allston' END AS neighborhood "
    "FROM (SELECT " + _Q.format(c="lat") + " AS lat, " + _Q.format(c="lon")
    + " AS lng, min(event_id) AS k FROM pts GROUP BY 1, 2) a WHERE k % 19 <> 0)",
    "labels AS (SELECT *, CASE WHEN street_name IS NOT NULL AND neighborhood IS NOT NULL THEN street_name || ', ' "
    "|| neighborhood WHEN street_name IS NOT NULL THEN street_name WHEN neighborhood IS NOT NULL THEN neighborhood "
    "WHEN k % 11 <> 0 THEN CAST(k AS VARCHAR) || ' Harbor Rd, Boston, MA' ELSE printf('%.4f, %.4f', lat, lng) END "
    "AS short_label FROM places)",
)
_NESTED_OUT = "segment_idx, lat, lng, distance_from_start_miles, risk_class, confidence"


@register("route_segments_nested", with_crashes(
    f"SELECT request_id, route_idx, 'segment' AS kind, segment_idx AS pos, {_NESTED_OUT}, p_high_r, p_low_r, p_medium_r, "
    "CAST(NULL AS DOUBLE) AS estimated_minutes_from_start, CAST(NULL AS VARCHAR) AS street_name, "
    "CAST(NULL AS VARCHAR) AS neighborhood, CAST(NULL AS VARCHAR) AS short_label FROM sr UNION ALL "
    "SELECT request_id, route_idx, 'hotspot', row_number() OVER (PARTITION BY request_id, route_idx ORDER BY segment_idx) - 1, "
    "segment_idx, sr.lat, sr.lng, distance_from_start_miles, risk_class, confidence, NULL, NULL, NULL, "
    "estimated_minutes_from_start, street_name, neighborhood, short_label "
    "FROM sr LEFT JOIN labels l ON round(l.lat * 1e5) = round(sr.lat * 1e5) AND round(l.lng * 1e5) = round(sr.lng * 1e5) "
    "WHERE is_hotspot", *RISK_CTES, *_GEO_CTES))
def q_route_segments_nested(spark, sf):
    """The nested segment and hotspot lists of every route, a row an element."""
    geo = PL.parse_reverse_geocode(FXT.geocode_payloads(spark, sf))
    per_route, _ = RR.route_risk(_scored_segments(spark, sf), geocoded=geo)
    keys = ["request_id", "route_idx"]

    def elements(column: str, kind: str) -> DataFrame:
        return per_route.select(*keys, F.lit(kind).alias("kind"), F.posexplode(column).alias("pos", "x")) \
            .select(*keys, "kind", "pos", "x.*")
    both = elements("segments", "segment").drop("polyline_index").unionByName(
        elements("hotspots", "hotspot"), allowMissingColumns=True)
    return both.withColumn("pos", F.col("pos").cast("long"))


@register("hotspot_nearest_label", with_crashes(
    f"SELECT {_SK}, place_lat, place_lng, place_m, street_name, short_label FROM (SELECT {_SK}, p.lat AS place_lat, "
    "p.lng AS place_lng, p.m AS place_m, p.street_name, p.short_label FROM sr LEFT JOIN ("
    "SELECT qlat, qlng, arg_min({'lat': lat, 'lng': lng, 'm': m, 'street_name': street_name, 'short_label': short_label}, "
    "(m, lat, lng)) AS p FROM (SELECT q.lat AS qlat, q.lng AS qlng, h.lat, h.lon AS lng, h.street_name, h.short_label, "
    f"round({HAV}, 6) AS m FROM (SELECT DISTINCT lat, lng, lng AS lon FROM sr WHERE is_hotspot) q JOIN "
    "(SELECT *, lng AS lon FROM labels WHERE street_name IS NOT NULL) h ON h.lat BETWEEN q.lat - 0.0091 AND q.lat + 0.0091) d "
    "WHERE m <= 1000 GROUP BY qlat, qlng) n ON n.qlat = sr.lat AND n.qlng = sr.lng WHERE is_hotspot) x",
    *RISK_CTES, *_GEO_CTES))
def q_hotspot_nearest_label(spark, sf):
    """Each hotspot with the nearest landed address that has a street, within 1 km."""
    from crashlens.operators import rollup
    seg = rollup.segment_risk(_scored_segments(spark, sf), RR.PROB_COLS, K.DEFAULT_THRESHOLDS).where("is_hotspot")
    geo = PL.parse_reverse_geocode(FXT.geocode_payloads(spark, sf)).where("street_name is not null")
    return RR.attach_nearest_labels(seg, geo).select(*RR.SEG_KEYS, "place_lat", "place_lng", "place_m", "street_name",
                                                     "short_label")


_WHOLE_CTES = SERVE_CTES + (
    "mid AS (SELECT r.request_id, r.duration_minutes, r.distance_miles, m.plat AS lat, m.plng AS lng FROM rt2 r "
    "JOIN qp m ON m.request_id = r.request_id AND m.route_key = r.route_key AND m.pidx = r.n // 2 WHERE r.route_idx = 0)",
    "msp AS (SELECT request_id, count(*) FILTER (WHERE hs = 'High') AS f1, count(*) FILTER (WHERE hs = 'Medium') AS i1 "
    "FROM (SELECT q.request_id, h.severity_class AS hs, " + HAV.replace("q.lon", "q.lng") + " AS d FROM mid q JOIN hist h "
    "ON h.lat BETWEEN q.lat - 0.0091 AND q.lat + 0.0091) s WHERE d <= 1000 GROUP BY 1)",
    f"mfeat AS (SELECT m.*, t.hour_of_day, w.condition, w.temperature_f, w.rain_1h_mm > 0 OR w.snow_1h_mm > 0 "
    "AS is_precipitation, w.visibility_meters < 5000 AS is_low_visibility, "
    f"CASE w.condition {_WMAP} ELSE 'weath_cond_descr_Not_Reported' END AS wmapped, "
    + _dbl(0.02) + " + COALESCE(p.f1, 0) * " + _dbl(0.05) + " + t.is_rush_hour * " + _dbl(0.05) + " AS ph, "
    + _dbl(0.2) + " + CAST(COALESCE(p.i1, 0) % 7 AS DOUBLE) * " + _dbl(0.06) + " AS pm, " + _dbl(0.5) + " AS pl "
    "FROM mid m JOIN rtf t ON t.request_id = m.request_id JOIN wp w ON w.request_id = m.request_id "
    "LEFT JOIN msp p ON p.request_id = m.request_id)",
    "msc AS (SELECT *, ph / (ph + pm + pl) AS p_high, pl / (ph + pm + pl) AS p_low, pm / (ph + pm + pl) AS p_medium "
    "FROM mfeat)",
    "trips AS (SELECT request_id, CAST(sum(CASE WHEN route_idx > 0 THEN 1 ELSE 0 END) AS BIGINT) AS num_alternatives, "
    "max(CASE WHEN route_idx = 0 THEN duration_seconds END) AS own, "
    "min(CASE WHEN route_idx > 0 THEN duration_seconds END) AS fastest FROM rt2 GROUP BY request_id)",
)


@register("whole_route_risk", with_crashes(
    "SELECT m.request_id, CASE WHEN NOT (p_high >= 0.15 OR p_low >= 0.25 OR p_medium >= CAST(0.4 AS DOUBLE)) THEN "
    "CASE WHEN p_high >= p_low AND p_high >= p_medium THEN 'High' WHEN p_low >= p_medium THEN 'Low' ELSE 'Medium' END "
    "WHEN p_high >= 0.15 AND (NOT p_low >= 0.25 OR p_high >= p_low) "
    "AND (NOT p_medium >= CAST(0.4 AS DOUBLE) OR p_high >= p_medium) THEN 'High' "
    "WHEN p_low >= 0.25 AND (NOT p_medium >= CAST(0.4 AS DOUBLE) OR p_low >= p_medium) THEN 'Low' "
    "ELSE 'Medium' END AS risk_class, " + _xr("greatest(p_high, p_low, p_medium)", 4) + " AS confidence, "
    + ", ".join(_xr(c, 4) + f" AS {c}" for c in PROB_COLS) + ", lat AS midpoint_lat, lng AS midpoint_lng, "
    "duration_minutes, distance_miles, num_alternatives, CASE WHEN num_alternatives > 0 THEN "
    + _xr("greatest(own - fastest, 0) / CAST(60 AS DOUBLE)", 2) + " ELSE CAST(0 AS DOUBLE) END "
    "AS best_alternative_savings_minutes, num_alternatives AS alternative_polylines, condition, temperature_f, "
    "is_precipitation, is_low_visibility, CASE WHEN wmapped IN (SELECT f FROM wkeep) THEN wmapped "
    "ELSE 'weath_cond_descr_Not_Reported' END AS weather_feature, hour_of_day "
    "FROM msc m JOIN trips t ON t.request_id = m.request_id", *_WHOLE_CTES))
def q_whole_route_risk(spark, sf):
    """One prediction a request for its default route, by formula scores at the midpoint."""
    from crashlens.session import stage_table
    requests = stage_table(FXT.route_payloads(spark, sf), "route_payloads")
    table = stage_table(RR.parsed_routes(requests).drop("points", "intervals"), "whole-routes")
    req_time = RR.request_time_features(requests)
    weather, _ = PL.parse_weather(FXT.weather_payloads(spark, sf))
    names = serving_feature_names(spark, sf)
    feats = RR.whole_route_features(table, req_time, weather, RR.serving_history(crashes(spark, sf)), names)
    out = RR.whole_route_risk(RR.formula_scores(feats), table, req_time, weather, names)
    return out.withColumn("alternative_polylines", F.size("alternative_polylines").cast("long")).drop("polyline")


# ---------------------------------------------------------------- ingestion with drift, incremental enrichment (A1-A3)

from pyspark.sql import types as T  # noqa: E402

from crashlens.plans import incremental  # noqa: E402
from crashlens.session import staged_path  # noqa: E402
from crashlens.sources import drift  # noqa: E402
from crashlens.sources import snapshots as SN  # noqa: E402
from crashlens.sources.tables import CRASH_SCHEMA  # noqa: E402

DRIFT_SCHEMA = T.StructType([CRASH_SCHEMA[c] for c in FXT.DRIFT_FIELDS])
_GOOD = "crash_id % 41 <> 0"


@register("crash_json_ingested", with_crashes(
    "SELECT crash_id % 4 AS batch, crash_id AS line_id, "
    + ", ".join(f"CASE WHEN {_GOOD} THEN {c} END AS {c}" for c in FXT.DRIFT_FIELDS
                if c not in ("speed_limit", "numb_vehc"))
    + f", CASE WHEN {_GOOD} AND (crash_id % 4 <> 3 OR crash_id % 8 = 3) THEN speed_limit END AS speed_limit, "
    f"CASE WHEN {_GOOD} AND crash_id % 4 <> 2 THEN numb_vehc END AS numb_vehc, "
    "CASE WHEN crash_id % 41 = 0 THEN '{\"crash_id\":' || crash_id "
    "WHEN crash_id % 4 = 1 THEN '{\"reporter\":\"unit ' || (crash_id % 5) || '\"}' "
    "WHEN crash_id % 8 = 7 AND speed_limit IS NOT NULL "
    "THEN '{\"speed_limit\":\"' || CAST(speed_limit AS INT) || ' mph\"}' END AS rescued, "
    "crash_id % 41 = 0 AS is_bad FROM crashes"))
def q_crash_json_ingested(spark, sf):
    return drift.ingest_json(FXT.drifting_crash_lines(spark, sf), DRIFT_SCHEMA)


@register("crash_json_drift", with_crashes(
    "SELECT batch, 'reporter' AS field, 'added' AS drift, n_rows, n_rows AS n_present, 'text' AS kinds "
    "FROM sizes WHERE batch = 1 UNION ALL "
    "SELECT batch, 'numb_vehc', 'missing', n_rows, 0, '' FROM sizes WHERE batch = 2 UNION ALL "
    "SELECT batch, 'speed_limit', 'retyped', n_rows, n_speed, 'text' FROM sizes WHERE batch = 3",
    "sizes AS (SELECT crash_id % 4 AS batch, COUNT(*) AS n_rows, COUNT(speed_limit) AS n_speed "
    f"FROM crashes WHERE {_GOOD} GROUP BY 1)"))
def q_crash_json_drift(spark, sf):
    return drift.schema_drift(FXT.drifting_crash_lines(spark, sf), DRIFT_SCHEMA, "batch")


@register("incremental_neighbourhoods", with_crashes(
    "SELECT lat, lon, CAST(SUM(n) FILTER (WHERE d <= 1000) AS BIGINT) AS n_big, "
    "CAST(SUM(f) FILTER (WHERE d <= 1000) AS BIGINT) AS fatal_big, "
    "CAST(SUM(i) FILTER (WHERE d <= 1000) AS BIGINT) AS injury_big, "
    "CAST(SUM(i + 2 * f) FILTER (WHERE d <= 1000) AS DOUBLE) AS score_big, "
    "CAST(SUM(n) FILTER (WHERE d <= 500) AS BIGINT) AS n_small, "
    "CAST(SUM(f) FILTER (WHERE d <= 500) AS BIGINT) AS fatal_small "
    f"FROM (SELECT q.lat, q.lon, h.n, h.f, h.i, {HAV} AS d FROM places q JOIN places h "
    "ON h.lat BETWEEN q.lat - 0.0091 AND q.lat + 0.0091) p GROUP BY 1, 2",
    LABELLED_CTE,
    "places AS (SELECT lat, lon, COUNT(*) AS n, COUNT(*) FILTER (WHERE severity_class = 'High') AS f, "
    "COUNT(*) FILTER (WHERE severity_class = 'Medium') AS i FROM labelled "
    "WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY lat, lon)"))
def q_incremental_neighbourhoods(spark, sf):
    """A first state and two batches, the last of them delivered twice."""
    base = PF.labelled(crashes(spark, sf)).select("lat", "lon", "severity_class", "year")
    path = staged_path(spark, "neighbourhoods")
    for name, years in (("to-2021", F.col("year") <= 2021), ("2022", F.col("year").between(2022, 2023)),
                        ("2024", F.col("year") >= 2024), ("2024", F.col("year") >= 2024)):
        incremental.refresh(spark, path, base.where(years), name)
    return SN.read(spark, path, ["sums"])[0].select("lat", "lon", *incremental.SUMS)


# ---------------------------------------------------------------- written and read again (A1-A6); facts of binary models

from crashlens.sources import sinks, tables  # noqa: E402


@register("crashes_round_trip", with_crashes(
    "SELECT f.fmt, c.* FROM crashes c CROSS JOIN (VALUES ('csv'), ('json'), ('parquet')) f(fmt)"))
def q_crashes_round_trip(spark, sf):
    """All crash rows landed in each format and read with the explicit schema."""
    rows, found = crashes(spark, sf), None
    for fmt in ("csv", "json", "parquet"):
        path = staged_path(spark, f"landed-{fmt}")
        w = rows.write.mode("overwrite")
        (w.option("header", "true") if fmt == "csv" else w).format(fmt).save(path)
        back = tables.read_crashes(spark, path, fmt).select(F.lit(fmt).alias("fmt"), *rows.columns)
        found = back if found is None else found.unionByName(back)
    return found


@register("crash_stats_cached", with_crashes(
    "SELECT year, COUNT(*) AS crashes, CAST(SUM(COALESCE(numb_fatal_injr, 0)) AS BIGINT) AS fatalities, "
    "CAST(SUM(COALESCE(numb_nonfatal_injr, 0)) AS BIGINT) AS injuries, read_as FROM crashes "
    "CROSS JOIN (VALUES ('built'), ('cached'), ('refreshed')) r(read_as) "
    "WHERE read_as = 'refreshed' OR year < 2020 GROUP BY year, read_as"))
def q_crash_stats_cached(spark, sf):
    """The cache is built from the rows before 2020, read again although all rows
    are there by then, and refreshed; the three readers each keep their version."""
    path, every = staged_path(spark, "stats-cache"), crashes(spark, sf)
    built = sinks.cached_table(spark, path, lambda: reads.stats_by_year(every.where("year < 2020")), partition_by=["year"])
    cached = sinks.cached_table(spark, path, lambda: reads.stats_by_year(every), partition_by=["year"])
    fresh = sinks.cached_table(spark, path, lambda: reads.stats_by_year(every), force_refresh=True, partition_by=["year"])
    parts = [d.withColumn("read_as", F.lit(n)) for n, d in (("built", built), ("cached", cached), ("refreshed", fresh))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("enriched_round_trip", with_crashes(
    f"SELECT year, {', '.join(SPATIAL_OUT)} FROM enriched", LABELLED_CTE, *SPATIAL_CTES))
def q_enriched_round_trip(spark, sf):
    path = staged_path(spark, "enriched")
    sinks.write_enriched(PF.spatial_enriched(crashes(spark, sf)).select("year", *SPATIAL_OUT), path)
    return spark.read.parquet(path).select("year", *SPATIAL_OUT)


def _reports(spark, sf) -> tuple[DataFrame, DataFrame, str]:
    path = staged_path(spark, "reports")
    results, thresholds = q_model_choice(spark, sf), q_threshold_search(spark, sf)
    TRN.write_reports(results, thresholds, K.V2_NUMERIC_COLS, path)
    return results, thresholds, path


@register("comparison_report_read", ORACLE["model_choice"])
def q_comparison_report_read(spark, sf):
    results, _, path = _reports(spark, sf)
    return spark.read.schema(results.schema).option("header", "true").csv(f"{path}/model_comparison")


@register("thresholds_report_read", ORACLE["threshold_search"])
def q_thresholds_report_read(spark, sf):
    _, thresholds, path = _reports(spark, sf)
    return spark.read.schema(thresholds.schema).json(f"{path}/thresholds")


@register("bundle_scores", with_crashes(
    "SELECT severity_class, count(*) AS test_rows, count(*) AS equal_rows, 'v4' AS version "
    "FROM v4rows WHERE is_test GROUP BY severity_class", *_V4_CTES))
def q_bundle_scores(spark, sf):
    """Bundles of versions 2 and 4 are saved; the newest is found, loaded, and
    scores every test row as the model in memory does."""
    fm, root = _v4_matrix(spark, sf), staged_path(spark, "bundles")
    train, test = fm.df.where(~F.col("is_test")), fm.df.where(F.col("is_test"))
    older = K.V2_NUMERIC_COLS
    TRN.save_bundle(TRN.fit(train, older, "logistic", **JOB["logistic"]), f"{root}/v2", older, K.DEFAULT_THRESHOLDS)
    model = TRN.fit(train, fm.features, "random_forest", **JOB["random_forest"])
    TRN.save_bundle(model, f"{root}/v4", fm.features, K.DEFAULT_THRESHOLDS, fm.weather_keep)
    path = TRN.resolve_bundle(root)
    loaded, meta = TRN.load_bundle(path)
    same = meta["features"] == fm.features and meta["thresholds"] == K.DEFAULT_THRESHOLDS \
        and meta["weather_keep"] == fm.weather_keep
    a, b = (TRN.score(m, test).select("crash_id", "severity_class", F.struct(*PROB_COLS, "predicted_class").alias(n))
            for m, n in ((model, "kept"), (loaded, "read")))
    return a.join(b.drop("severity_class"), "crash_id").groupBy("severity_class").agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.sum(((F.col("kept") == F.col("read")) & F.lit(same)).cast("long")).alias("equal_rows")) \
        .withColumn("version", F.lit(path.rsplit("/", 1)[-1]))


@register("binary_boosting_facts", with_crashes(
    "SELECT CASE severity_class WHEN 'Low' THEN 0 ELSE 1 END AS label, count(*) AS test_rows, count(*) AS probabilities, "
    "count(*) AS decided_at_half, CAST(1 AS DOUBLE) AS importance_total, true AS importance_falls "
    "FROM v4rows WHERE is_test GROUP BY 1", *_V4_CTES))
def q_binary_boosting_facts(spark, sf):
    """Each scored row has a probability and the class it means; the importances of
    all features add up to 1 and the list falls."""
    fm = _v4_matrix(spark, sf)
    model = TRN.fit(fm.df.where(~F.col("is_test")), fm.features, "gbt_binary", trees=10)
    scored = TRN.score(model, fm.df.where(F.col("is_test")))
    p = F.col("p_elevated")
    ranked = [r["importance"] for r in TRN.feature_importance(model, fm.features, top_k=len(fm.features)).collect()]
    return scored.groupBy(FX.binary_target("severity_class").cast("int").alias("label")).agg(
        F.count(F.lit(1)).alias("test_rows"), F.sum(p.between(0, 1).cast("long")).alias("probabilities"),
        F.sum(((p > 0.5) == (F.col("prediction") == 1)).cast("long")).alias("decided_at_half")) \
        .withColumns({"importance_total": F.lit(round(sum(ranked), 6)),
                      "importance_falls": F.lit(all(x >= y for x, y in zip(ranked, ranked[1:])))})
