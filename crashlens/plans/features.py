"""Feature-matrix builders v1, v2 and v4 (G10) and the spatial enrichment stage.

One builder, a version setting:

* ``v1``: numeric crash columns + time features (rush 7-9/16-18) with median
  fill, one-hot of six categoricals (post-crash columns included).
* ``v2``: forward-knowable only: lat, lon, speed limit, time features (rush
  7-9/16-19), one-hot weather and light phase; rows need lat, lon, time.
* ``v4``: v2 plus six neighbourhood features, and weather one-hot columns
  with fewer than 50 rows pruned (or aligned to a given keep list).

Category sets come from one grouped count per builder (a few dozen rows to
the driver); medians only for columns that actually have nulls. The matrix
is one projection, keyed by ``crash_id`` and carrying the label and split.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crashlens import constants as K
from crashlens.functions import features as FX
from crashlens.functions.names import clean_names, sanitize, sanitize_col
from crashlens.operators import cleaning, onehot, spatial, split
from crashlens.session import stage_table


@dataclass
class FeatureMatrix:
    df: DataFrame                      # key cols + feature cols (clean names)
    features: list[str]                # feature names in order
    keys: list[str] = field(default_factory=list)
    weather_keep: list[str] | None = None

    def long(self) -> DataFrame:
        """(keys..., feature, value) long form: one row per cell."""
        return to_long(self.df, self.keys, self.features)


def to_long(df: DataFrame, keys: list[str], feats: list[str]) -> DataFrame:
    pairs = ", ".join(f"'{f}', CAST(`{f}` AS DOUBLE)" for f in feats)
    return df.selectExpr(*[f"`{k}`" for k in keys],
                         f"stack({len(feats)}, {pairs}) AS (feature, value)")


def labelled(crashes: DataFrame) -> DataFrame:
    """Add ``severity_class`` and drop rows without one."""
    return (crashes.withColumn("severity_class", FX.severity_class("severity_3class"))
            .where(F.col("severity_class").isNotNull()))


def with_time_features(df: DataFrame, rush_variant: str = "v2") -> DataFrame:
    """Parse ``crash_datetime_clean`` (UTC) and add hour, weekday, month,
    weekend, rush-hour and light-phase columns (E8-E12)."""
    ts = FX.parse_timestamp("crash_datetime_clean")
    df = df.withColumn("crash_ts", ts)
    df = df.withColumns({
        "hour_of_day": FX.hour_of_day("crash_ts"),
        "day_of_week": FX.day_of_week("crash_ts"),
        "month": FX.month("crash_ts"),
    })
    return df.withColumns({
        "is_weekend": FX.is_weekend("day_of_week"),
        "is_rush_hour": FX.is_rush_hour("hour_of_day", rush_variant),
        "light_phase": FX.light_phase("hour_of_day", "train"),
    })


def spatial_enriched(crashes: DataFrame, test_pct: int = 20, seed: int = 42, stage: bool = True,
                     **grid) -> DataFrame:
    """Crash rows with a class and a location, the split flag, and the six
    neighbourhood features computed without leakage (the v4 spatial stage).

    ``stage=True`` writes the result once under the shared checkpoint folder
    and reads it back: later passes (profiles, medians, training) scan
    Parquet instead of re-running the radius join, and lineage is cut.
    """
    base = labelled(crashes).where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    s = split.stratified_split(base, "severity_class", "crash_id", test_pct, seed)
    if stage:
        # the split feeds three sides of the joins: compute it once
        s = stage_table(s, "split")
    out = (spatial.split_features(s, "is_test", **grid)
           .withColumn("severity_score", FX.severity_score("severity_class")))
    return stage_table(out, "spatial") if stage else out


def _onehot_named(src, prefix: str, values: list[str]) -> list:
    """0/1 columns for raw ``values`` of ``src`` named ``prefix_value`` (raw)."""
    return [F.when(src == F.lit(v), 1).otherwise(0).alias(f"{prefix}_{v}") for v in values]


def _finish(df: DataFrame, keys: list[str], raw_feats: list[str]) -> tuple[DataFrame, list[str]]:
    names = clean_names(raw_feats)
    sel = [F.col(k) for k in keys]
    sel += [F.coalesce(F.col(f"`{r}`").cast("double"), F.lit(0.0)).alias(n)
            for r, n in zip(raw_feats, names)]
    return df.select(*sel), names


def build_v1(crashes: DataFrame, keys=("crash_id", "severity_class")) -> FeatureMatrix:
    df = with_time_features(labelled(crashes), "v1")
    numeric = [c for c in K.V1_NUMERIC_COLS if c in df.columns] + K.TIME_COLS
    cats = [c for c in K.V1_CATEGORICAL_COLS if c in df.columns]
    values, with_nulls = onehot.profile(df, cats, numeric)
    df = _fill_medians(df, with_nulls)
    onehots, raw = [], list(numeric)
    for c in cats:
        onehots += _onehot_named(onehot.filled(c), c, values[c])
        raw += [f"{c}_{v}" for v in values[c]]
    wide = df.select(*[F.col(k) for k in keys], *[F.col(c) for c in numeric], *onehots)
    out, names = _finish(wide, list(keys), raw)
    return FeatureMatrix(out, names, list(keys))


def _v2_rows(df: DataFrame) -> DataFrame:
    df = with_time_features(df, "v2")
    return cleaning.drop_null(df, ["lat", "lon", "crash_ts"])


def _profile(df: DataFrame, numeric: list[str]):
    """One grouped pass: weather value counts, present light phases, and the
    numeric columns that contain nulls (a few dozen rows reach the driver)."""
    rows = (df.groupBy(onehot.filled("weath_cond_descr").alias("w"), "light_phase")
            .agg(F.count(F.lit(1)).alias("n"),
                 *[F.sum(F.col(c).isNull().cast("long")).alias(f"null_{i}")
                   for i, c in enumerate(numeric)])
            .collect())
    wc: dict[str, int] = {}
    lights = set()
    nulls = [0] * len(numeric)
    for r in rows:
        wc[r["w"]] = wc.get(r["w"], 0) + r["n"]
        lights.add(r["light_phase"])
        for i in range(len(numeric)):
            nulls[i] += r[f"null_{i}"] or 0
    with_nulls = [c for c, k in zip(numeric, nulls) if k > 0]
    return sorted(wc.items()), sorted(lights), with_nulls


def _fill_medians(df: DataFrame, cols: list[str]) -> DataFrame:
    meds = cleaning.medians(df, cols)
    if not meds:
        return df
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(meds[c] if meds[c] is not None else 0))
                           for c in cols})


def build_v2(crashes: DataFrame, keys=("crash_id", "severity_class")) -> FeatureMatrix:
    df = _v2_rows(labelled(crashes))
    numeric = list(K.V2_NUMERIC_COLS)
    wcounts, lights, with_nulls = _profile(df, numeric)
    df = _fill_medians(df, with_nulls)
    wvals = [v for v, _ in wcounts]
    cols = (_onehot_named(onehot.filled("weath_cond_descr"), "weath_cond_descr", wvals)
            + _onehot_named(F.col("light_phase"), "light_phase", lights))
    raw = numeric + [f"weath_cond_descr_{v}" for v in wvals] + [f"light_phase_{v}" for v in lights]
    wide = df.select(*[F.col(k) for k in keys], *[F.col(c) for c in numeric], *cols)
    out, names = _finish(wide, list(keys), raw)
    return FeatureMatrix(out, names, list(keys))


def build_v4(enriched: DataFrame, weather_keep: list[str] | None = None,
             keys=("crash_id", "severity_class", "is_test")) -> FeatureMatrix:
    """v4 matrix from the spatial stage output.

    ``weather_keep`` (sanitized one-hot names) aligns a later batch to the
    training columns: kept names absent from the data become 0 columns.
    """
    df = _v2_rows(enriched)
    df = cleaning.drop_null(df, K.SPATIAL_COLS)
    numeric = list(K.V2_NUMERIC_COLS) + list(K.SPATIAL_COLS)
    wcounts, lights, with_nulls = _profile(df, numeric)
    df = _fill_medians(df, with_nulls)
    if weather_keep is None:
        seen = []
        for v, n in wcounts:
            name = sanitize(f"weath_cond_descr_{v}")
            if n >= K.WEATHER_MIN_SUM and name not in seen:
                seen.append(name)
        weather_keep = seen
    wsan = F.concat(F.lit("weath_cond_descr_"), sanitize_col(onehot.filled("weath_cond_descr")))
    wcols = [F.when(wsan == F.lit(n), 1).otherwise(0).alias(n) for n in weather_keep]
    lcols = _onehot_named(F.col("light_phase"), "light_phase", lights)
    raw = numeric + list(weather_keep) + [f"light_phase_{v}" for v in lights]
    wide = df.select(*[F.col(k) for k in keys], *[F.col(c) for c in numeric], *wcols, *lcols)
    out, names = _finish(wide, list(keys), raw)
    return FeatureMatrix(out, names, list(keys), list(weather_keep))
