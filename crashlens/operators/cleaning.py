"""Cleaning, audits, column alignment, value counts and median imputation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlens.session import stage_table


def drop_null(df: DataFrame, subset: list[str]) -> DataFrame:
    """Drop rows with a null in any of ``subset``."""
    return df.na.drop(subset=subset)


def stage_audit(df: DataFrame, stages: list[tuple[str, Column]]) -> DataFrame:
    """Row count surviving each cleaning stage, in one pass.

    ``stages`` is an ordered list of (name, keep-condition); each stage's
    condition is AND-ed with the earlier ones. Returns (stage_no, stage, rows).
    """
    aggs = [F.count(F.lit(1)).alias("s0")]
    cond = None
    for i, (_, c) in enumerate(stages, start=1):
        cond = c if cond is None else (cond & c)
        aggs.append(F.sum(F.when(cond, 1).otherwise(0)).cast("bigint").alias(f"s{i}"))
    names = ["input"] + [n for n, _ in stages]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"{i}, '{n}', s{i}" for i, n in enumerate(names))
    return wide.selectExpr(f"stack({len(names)}, {pairs}) AS (stage_no, stage, rows)")


def align_columns(df: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """Select ``columns`` in order, adding absent ones as 0."""
    present = set(df.columns)
    sel = [F.col(k) for k in (keep or [])]
    sel += [F.col(c) if c in present else F.lit(0).alias(c) for c in columns]
    return df.select(*sel)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts per value including nulls, with percent of all rows (D3).

    The percent divides by the total over the aggregated table, which has one
    row per distinct value (categorical, so small).
    """
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.select(col, "n", F.round(F.col("n") * 100.0 / total, 4).alias("pct"))


#: Buckets that an interval of values is cut into, each round.
MEDIAN_BUCKETS = 1024


def _binade(x: Column) -> Column:
    """Grows with ``x``: its sign and power of two, about 4,200 values in all."""
    power = F.floor(F.log2(F.abs(x))).cast("long")
    power = F.least(F.greatest(power, F.lit(-1080)), F.lit(1080)) + 1100
    return F.when(x == 0, F.lit(0)).when(x > 0, power).otherwise(-power).cast("long")


def grouped_medians(df: DataFrame, cols: list[str], by: str | None = None) -> dict[tuple, float | None]:
    """Exact interpolating medians of ``cols``, all at once, as {(group, column): median}.

    Ranks are selected, not sorted: a histogram by powers of two finds the
    interval that holds the middle rank, further ones cut that interval into
    MEDIAN_BUCKETS parts until it holds one value or the two middle ranks fall
    apart. Every round is one aggregate with map-side combining; a few thousand
    counts a group and column reach the driver, and no reducer sees the rows. An
    interval within one power of two has 52 bits, so six more rounds always do.

    Nulls and NaN are left out; a column with nothing else has no entry, so
    ``get`` gives None. ``by`` is one column with few values (null is one).
    Only the needed columns are kept, written once.
    """
    if not cols:
        return {}
    group = F.col(by) if by else F.lit(None).cast("int")
    narrow = stage_table(df.select(group.alias("g"), *[F.col(c).cast("double").alias(f"c{i}")
                                                       for i, c in enumerate(cols)]), "median-columns")
    rows = narrow.select("g", F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"c{i}").alias("x"))
                                                  for i in range(len(cols))])).alias("v")).select("g", "v.*") \
        .where(F.col("x").isNotNull() & ~F.isnan("x"))
    found: dict[tuple, float | None] = {}
    open_: dict[tuple, tuple[float, float, int, int]] = {}  # interval, and the middle ranks within it

    def narrowed(bucketed: DataFrame, first: bool) -> None:
        counts: dict[tuple, list] = {}
        for r in bucketed.groupBy("g", "c", "bucket").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("least"),
                                                          F.max("x").alias("most")).collect():
            counts.setdefault((r["g"], r["c"]), []).append((r["bucket"], r["n"], r["least"], r["most"]))
        for key, buckets in counts.items():
            buckets.sort()
            total = sum(b[1] for b in buckets)
            low, high = ((total - 1) // 2, total // 2) if first else open_[key][2:]
            before = 0
            for k, (_, n, least, most) in enumerate(buckets):
                if low < before + n:
                    break
                before += n
            open_.pop(key, None)
            if high >= before + n:  # the last of this bucket and the first of the next
                found[key] = most + (buckets[k + 1][2] - most) * 0.5
            elif least == most:
                found[key] = least
            else:
                open_[key] = (least, most, low - before, high - before)

    narrowed(rows.withColumn("bucket", _binade(F.col("x"))), True)
    while open_:
        spans = df.sparkSession.createDataFrame(
            [(*key, low, high) for key, (low, high, _, _) in open_.items()],
            T.StructType([T.StructField("g", narrow.schema["g"].dataType), T.StructField("c", T.IntegerType()),
                          T.StructField("low", T.DoubleType()), T.StructField("high", T.DoubleType())]))
        spans = spans.select(F.col("g").alias("sg"), F.col("c").alias("sc"), "low", "high")
        share = (F.col("x") - F.col("low")) / (F.col("high") - F.col("low"))
        narrowed(rows.join(F.broadcast(spans), F.col("g").eqNullSafe(F.col("sg")) & (F.col("c") == F.col("sc"))
                           & F.col("x").between(F.col("low"), F.col("high")))  # a row an open median
                 .withColumn("bucket", F.least(F.floor(share * MEDIAN_BUCKETS), F.lit(MEDIAN_BUCKETS - 1))), False)
    return {(g, cols[c]): value for (g, c), value in found.items()}


def medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """Exact medians of several columns; None for one without a value."""
    found = grouped_medians(df, cols)
    return {c: found.get((None, c)) for c in cols}
