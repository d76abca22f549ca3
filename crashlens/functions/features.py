"""Scalar feature functions as Spark column expressions (no Python UDFs).

All functions return ``Column`` objects so they stay inside whole-stage
codegen. Null rules follow pandas where the reference relies on them: a
comparison with a missing value is false, so flags default to 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from crashlens import constants as K


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ------------------------------------------------------------------ severity

def severity_class(raw) -> Column:
    """Raw ``severity_3class`` -> Low / Medium / High; unmapped -> null."""
    raw = _c(raw)
    expr = None
    for k, v in K.SEVERITY_MAP.items():
        expr = (F.when(raw == k, F.lit(v)) if expr is None else expr.when(raw == k, F.lit(v)))
    return expr


def severity_score(cls) -> Column:
    """Model class -> 0 / 1 / 2 score; null stays null."""
    cls = _c(cls)
    expr = None
    for k, v in K.SEVERITY_SCORE.items():
        expr = (F.when(cls == k, F.lit(v)) if expr is None else expr.when(cls == k, F.lit(v)))
    return expr


def binary_target(cls) -> Column:
    """Safe (Low) -> 0, Elevated (Medium or High) -> 1."""
    return (_c(cls) != F.lit("Low")).cast("int")


# ------------------------------------------------------------------ time

def parse_timestamp(text) -> Column:
    """Text -> timestamp, read in the session zone (UTC); bad values -> null."""
    return F.try_to_timestamp(_c(text))


def hour_of_day(ts) -> Column:
    return F.hour(_c(ts))


def day_of_week(ts) -> Column:
    """0 = Monday .. 6 = Sunday."""
    return F.weekday(_c(ts))


def month(ts) -> Column:
    return F.month(_c(ts))


def is_weekend(dow) -> Column:
    return F.coalesce((_c(dow) >= 5).cast("int"), F.lit(0))


def is_rush_hour(hour, variant: str = "v2", weekend=None) -> Column:
    """Rush-hour flag. ``v1``: 7-9, 16-18; ``v2``: 7-9, 16-19 any day;
    ``serve``: 7-9, 16-19 and not a weekend. A null hour gives 0."""
    h = _c(hour)
    cond = None
    for lo, hi in K.RUSH_HOURS[variant]:
        c = h.between(lo, hi)
        cond = c if cond is None else (cond | c)
    if variant == "serve":
        if weekend is None:
            raise ValueError("serve variant needs the weekend flag")
        cond = cond & (_c(weekend) == 0)
    return F.coalesce(cond.cast("int"), F.lit(0))


def light_phase(hour, variant: str = "train") -> Column:
    """Light phase from the hour.

    ``train``: Dark if hour < 6 or >= 20, Dawn_Dusk at 6 and 19, else Daylight
    (a null hour falls through to Daylight). ``serve``: Daylight 7-18,
    Dawn_Dusk at 5, 6, 19, 20, else Dark.
    """
    h = _c(hour)
    if variant == "train":
        return (F.when((h < 6) | (h >= 20), F.lit("Dark"))
                .when(h.isin(*K.DAWN_DUSK_HOURS["train"]), F.lit("Dawn_Dusk"))
                .otherwise(F.lit("Daylight")))
    return (F.when(h.between(7, 18), F.lit("Daylight"))
            .when(h.isin(*K.DAWN_DUSK_HOURS["serve"]), F.lit("Dawn_Dusk"))
            .otherwise(F.lit("Dark")))


_ZONE_SUFFIX = r"(Z|z|[+-][0-9]{2}(:?[0-9]{2})?)$"


def local_departure_time(text, as_of=None, zone: str = K.LOCAL_TIMEZONE) -> Column:
    """Departure text -> wall-clock time in ``zone`` (as a timestamp_ntz).

    Text with a zone suffix is converted to ``zone``; naive text is taken as
    already local. Null text uses ``as_of`` (a UTC timestamp column; the
    reference uses "now", which a batch job supplies explicitly).
    """
    t = _c(text)
    has_zone = t.rlike(_ZONE_SUFFIX)
    zoned = F.from_utc_timestamp(F.try_to_timestamp(t), zone)
    naive = F.try_to_timestamp(t)
    parsed = F.when(has_zone, zoned).otherwise(naive)
    if as_of is not None:
        parsed = F.when(t.isNull(), F.from_utc_timestamp(_c(as_of), zone)).otherwise(parsed)
    return F.to_timestamp_ntz(F.date_format(parsed, "yyyy-MM-dd HH:mm:ss.SSSSSS"))


# ------------------------------------------------------------------ exact decimal rounding

_SPLIT = 134217729.0  # 2**27 + 1, Veltkamp splitting constant


def _split(a: Column) -> tuple[Column, Column]:
    t = a * F.lit(_SPLIT)
    hi = t - (t - a)
    return hi, a - hi


def round_scaled(x, decimals: int) -> Column:
    """Nearest integer to the exact value of ``x * 10**decimals`` (ties to
    even), as a long.

    Python's ``round`` and ``format`` work on the exact binary value of a
    double, while ``F.round`` rounds its shortest decimal text half up
    (2.675 -> 2.68, Python -> 2.67). The product ``x * c`` is split into the
    rounded double ``p`` and its exact error ``e`` (Dekker's error-free
    product, plain double arithmetic), and the fraction is compared with 1/2
    exactly.
    """
    x = _c(x)
    c = float(10 ** decimals)
    tc = c * _SPLIT
    chi = tc - (tc - c)
    clo = c - chi
    p = x * F.lit(c)
    xhi, xlo = _split(x)
    e = ((xhi * F.lit(chi) - p) + xhi * F.lit(clo) + xlo * F.lit(chi)) + xlo * F.lit(clo)
    f = F.floor(p)
    d = ((p - f) - F.lit(0.5)) + e
    up = F.when(d > 0, 1).when(d < 0, 0).otherwise(F.pmod(f, F.lit(2)))
    return (f + up).cast("long")


def round_exact(x, decimals: int) -> Column:
    """``round(x, decimals)`` with Python semantics (exact value, ties even)."""
    return round_scaled(x, decimals).cast("double") / F.lit(float(10 ** decimals))


def format_scaled(t, decimals: int, negative=None) -> Column:
    """Text of a non-negative integer ``t`` read as ``t / 10**decimals``."""
    t = _c(t)
    c = 10 ** decimals
    sign = F.lit("") if negative is None else F.when(negative, F.lit("-")).otherwise(F.lit(""))
    if decimals == 0:
        return F.concat(sign, t.cast("string"))
    return F.concat(sign, (t / F.lit(c)).cast("long").cast("string"), F.lit("."),
                    F.lpad(F.pmod(t, F.lit(c)).cast("string"), decimals, "0"))


def format_fixed(x, decimals: int) -> Column:
    """Text of ``x`` with ``decimals`` places, as Python's ``f"{x:.Nf}"``.

    ``x`` should be a column reference (it is used several times)."""
    x = _c(x)
    return format_scaled(F.abs(round_scaled(x, decimals)), decimals, x < 0)


# ------------------------------------------------------------------ spatial


def distance_speed_default(miles) -> Column:
    """Base speed by route distance: < 2 mi 25, < 10 mi 35, else 55."""
    m = _c(miles)
    expr = None
    for lim, spd in K.SPEED_TIERS:
        expr = F.when(m < lim, F.lit(spd)) if expr is None else expr.when(m < lim, F.lit(spd))
    return expr.otherwise(F.lit(K.SPEED_FAR))


def traffic_speed(category, base) -> Column:
    """NORMAL keeps base; SLOW max(15, base-10); TRAFFIC_JAM max(10, base-20);
    anything else keeps base."""
    cat, b = _c(category), _c(base)
    expr = None
    for name, (off, floor) in K.TRAFFIC_SPEED.items():
        val = F.greatest(F.lit(floor), b - F.lit(off))
        expr = F.when(cat == name, val) if expr is None else expr.when(cat == name, val)
    return expr.otherwise(b)


def meters_to_miles(m) -> Column:
    return round_exact(_c(m) / F.lit(K.METERS_PER_MILE), 3)


def meters_to_km(m) -> Column:
    return round_exact(_c(m) / F.lit(1000.0), 3)


def seconds_to_minutes(s) -> Column:
    return round_exact(_c(s) / F.lit(60.0), 2)


def duration_seconds(text) -> Column:
    """Duration text such as ``"717s"`` -> 717 (missing -> 0, malformed -> null)."""
    t = F.coalesce(_c(text), F.lit("0s"))
    return F.regexp_extract(t, r"^(-?[0-9]+)s?$", 1).try_cast("long")


def is_precipitation(rain_1h, snow_1h) -> Column:
    return (_c(rain_1h) > 0) | (_c(snow_1h) > 0)


def is_low_visibility(visibility_m) -> Column:
    return _c(visibility_m) < F.lit(K.LOW_VISIBILITY_M)


def distance_from_start(poly_idx, total_pts, miles) -> Column:
    """``idx / (n - 1) * miles`` rounded to 3 places."""
    return round_exact(_c(poly_idx).cast("double") / (_c(total_pts) - 1).cast("double") * _c(miles), 3)


def minutes_from_start(dist_from_start, miles, minutes) -> Column:
    """``d / miles * minutes`` rounded to 1 place; 0 when the route has no length."""
    m = _c(miles)
    return F.when(m > 0, round_exact(_c(dist_from_start) / m * _c(minutes), 1)).otherwise(F.lit(0.0))


# ------------------------------------------------------------------ classification

def classify_with_thresholds(probs, thresholds: dict, classes: list[str] = K.CLASSES) -> Column:
    """Class with the largest probability among those at or above their
    threshold; if none qualifies, the argmax. Ties go to the earlier class.

    ``probs`` is an ``array<double>`` in ``classes`` order.
    """
    p = _c(probs)
    items = F.array(*[
        F.struct(p.getItem(i).alias("p"), F.lit(-i).alias("neg_idx"), F.lit(c).alias("cls"),
                 F.lit(float(thresholds.get(c, K.DEFAULT_THRESHOLD))).alias("t"))
        for i, c in enumerate(classes)])
    above = F.filter(items, lambda s: s["p"] >= s["t"])
    best_above = F.array_max(F.transform(above, lambda s: F.struct(s["p"], s["neg_idx"],
                                                                   s["cls"])))
    best_all = F.array_max(F.transform(items, lambda s: F.struct(s["p"], s["neg_idx"], s["cls"])))
    return F.when(F.size(above) > 0, best_above["cls"]).otherwise(best_all["cls"])


def confidence(probs) -> Column:
    """Largest probability, rounded to 4, even when thresholds chose another class."""
    return round_exact(F.array_max(_c(probs)), 4)


def risk_rank(cls) -> Column:
    c = _c(cls)
    expr = None
    for k, v in K.RISK_ORDER.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr.otherwise(F.lit(0))
