"""Read API over the crash table: paging, filters, limit, yearly statistics.

Every limited read orders by ``crash_id`` first, so results are
deterministic; Spark plans ``orderBy + limit`` as a per-partition top-k with a
final merge (TakeOrderedAndProject), never a full sort. Filters are plain
column predicates, so equality and null tests reach the Parquet scan as
pushed filters and partition pruning applies when the table is partitioned by
``year``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER_KEY = "crash_id"


def _contains_ci(col: str, text: str) -> Column:
    """Case-insensitive substring match, as SQL ``ILIKE '%text%'``.

    ``%`` and ``_`` inside ``text`` stay wildcards, like the reference.
    """
    return F.col(col).ilike(f"%{text}%")


def _limited(df: DataFrame, limit: int | None, offset: int = 0) -> DataFrame:
    df = df.orderBy(ORDER_KEY)
    if limit is None:
        return df.offset(offset) if offset else df
    if offset:
        return df.limit(offset + limit).offset(offset)
    return df.limit(limit)


def page(crashes: DataFrame, limit: int = 100, offset: int = 0) -> DataFrame:
    """Rows ``offset .. offset+limit-1`` in ``crash_id`` order."""
    return _limited(crashes, limit, offset)


def by_year(crashes: DataFrame, year: int, limit: int = 100) -> DataFrame:
    return _limited(crashes.filter(F.col("year") == F.lit(year)), limit)


def by_severity(crashes: DataFrame, severity: str, limit: int = 100) -> DataFrame:
    """Substring match on ``severity_3class``; 'Injury' also matches 'No Injury'."""
    return _limited(crashes.filter(_contains_ci("severity_3class", severity)), limit)


def by_city(crashes: DataFrame, city: str, limit: int = 100) -> DataFrame:
    return _limited(crashes.filter(_contains_ci("city_town_name", city)), limit)


def hotspots(crashes: DataFrame, limit: int = 100) -> DataFrame:
    return _limited(crashes.filter(F.col("ems_hotspot_flag") == 1), limit)


def fatal(crashes: DataFrame, limit: int = 100) -> DataFrame:
    """At least one fatality by count (not by severity label)."""
    return _limited(crashes.filter(F.col("numb_fatal_injr") > 0), limit)


def filter_conditions(year: int | None = None, city: str | None = None,
                      severity: str | None = None, weather: str | None = None) -> list[Column]:
    """AND-ed conditions for the given fields; 0 and '' count as not given."""
    conds = []
    if year:
        conds.append(F.col("year") == F.lit(year))
    if city:
        conds.append(_contains_ci("city_town_name", city))
    if severity:
        conds.append(_contains_ci("severity_3class", severity))
    if weather:
        conds.append(_contains_ci("weath_cond_descr", weather))
    return conds


def filter_crashes(crashes: DataFrame, year: int | None = None, city: str | None = None,
                   severity: str | None = None, weather: str | None = None,
                   limit: int | None = 100) -> DataFrame:
    conds = filter_conditions(year, city, severity, weather)
    df = crashes.filter(reduce(lambda a, b: a & b, conds)) if conds else crashes
    return _limited(df, limit)


def envelope(result: DataFrame, **filters) -> DataFrame:
    """Result envelope as one row: returned count plus the echoed filters.

    The data itself is ``result``; this is a global ``count(*)`` over it
    (partial counts per partition, one final row), with each filter value as
    a literal column ``filter_<name>`` (null when not given).
    """
    cols = [F.count(F.lit(1)).alias("total_returned")]
    for k, v in filters.items():
        cols.append(F.lit(v).alias(f"filter_{k}"))
    return result.agg(*cols)


def project(crashes: DataFrame, columns: list[str]) -> DataFrame:
    return crashes.select(*columns)


def stats_by_year(crashes: DataFrame) -> DataFrame:
    """Per year: crashes, fatalities, injuries (null counts as 0), by year.

    Only three columns are read; partial aggregation runs before the shuffle,
    so the shuffle carries one row per (partition, year).
    """
    return (crashes
            .groupBy("year")
            .agg(F.count(F.lit(1)).alias("crashes"),
                 F.sum(F.coalesce(F.col("numb_fatal_injr"), F.lit(0))).cast("bigint")
                 .alias("fatalities"),
                 F.sum(F.coalesce(F.col("numb_nonfatal_injr"), F.lit(0))).cast("bigint")
                 .alias("injuries"))
            .orderBy("year"))
