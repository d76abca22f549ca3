"""One-hot encoding with sparse-column pruning.

The set of categories is small (tens of values) and must be known to fix
the output schema, so it is computed by one distributed ``groupBy(value)``
count and only the per-value counts come back to the driver. The encoding
itself is one projection of ``CASE WHEN value = v THEN 1 ELSE 0`` columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crashlens import constants as K


def filled(col: str, fill: str = K.UNKNOWN_CATEGORY):
    return F.coalesce(F.col(col), F.lit(fill))


def category_counts(df: DataFrame, col: str, fill: str = K.UNKNOWN_CATEGORY) -> list[tuple[str, int]]:
    """(value, rows) per category, nulls as ``fill``, in value order."""
    rows = (df.groupBy(filled(col, fill).alias("v")).agg(F.count(F.lit(1)).alias("n"))
            .collect())
    return sorted(((r["v"], r["n"]) for r in rows), key=lambda t: t[0])


def one_hot_columns(col: str, values: list[str], prefix: str | None = None,
                    fill: str = K.UNKNOWN_CATEGORY) -> list:
    """0/1 columns named ``<prefix>_<value>`` (raw names; sanitize later)."""
    prefix = prefix or col
    src = filled(col, fill)
    return [F.when(src == F.lit(v), 1).otherwise(0).alias(f"{prefix}_{v}") for v in values]


def profile(df: DataFrame, cats: list[str], numeric: list[str] | None = None,
            fill: str = K.UNKNOWN_CATEGORY) -> tuple[dict[str, list[str]], list[str]]:
    """One pass: the distinct values of every categorical column (sorted) and
    the numeric columns holding nulls.

    ``collect_set`` merges per-partition sets of category values, so each
    buffer is bounded by the number of categories, not by the rows.
    """
    numeric = numeric or []
    row = df.agg(*[F.collect_set(filled(c, fill)).alias(f"v{i}") for i, c in enumerate(cats)],
                 *[F.sum(F.col(c).isNull().cast("long")).alias(f"n{i}")
                   for i, c in enumerate(numeric)]).first()
    values = {c: sorted(row[f"v{i}"]) for i, c in enumerate(cats)}
    with_nulls = [c for i, c in enumerate(numeric) if (row[f"n{i}"] or 0) > 0]
    return values, with_nulls
