"""Stratified train/test split (G1) and class weights.

Split rule (deterministic, exact per class, no global sort):

    h(id)   = first 32 bits of md5(id || ':' || seed)
    rank    = position of the row inside its class ordered by (h, id)
    test    = rank <= ceil(n_class * test_pct / 100)

The digest mixes id and seed, so seeds give independent splits, and any SQL
engine reproduces it.
Spark computes it without a per-class window (a class may hold most rows):
rows are counted per (class, h-bucket) -- a table of at most
``classes x BUCKETS`` rows -- whose running totals decide whole buckets at
once; only the one bucket per class that straddles the quota is ranked row
by row, and it holds about n_class / BUCKETS rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE = 1 << 32
BUCKETS = 65_536


def split_hash(id_col: str = "crash_id", seed: int = 42):
    return hash32(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def hash32(text: Column) -> Column:
    """First 32 bits of a text's md5 as a non-negative long."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def stratified_split(df: DataFrame, label_col: str = "severity_class", id_col: str = "crash_id",
                     test_pct: int = 20, seed: int = 42, out_col: str = "is_test") -> DataFrame:
    """Add boolean ``out_col``: True for the test share of every class."""
    return first_per_class(df, label_col, id_col, F.expr(f"(_ncls * {int(test_pct)} + 99) div 100"),
                           seed, out_col)


def first_per_class(df: DataFrame, label_col: str, id_col: str, quota, seed: int = 42,
                    out_col: str = "is_first") -> DataFrame:
    """Flag exactly ``quota`` rows of every class: the first ones in (h, id)
    order. ``quota`` is a column expression that may use ``_ncls`` (the class
    size) and the label column."""
    rows = (df.withColumn("_h", split_hash(id_col, seed))
              .withColumn("_b", F.floor(F.col("_h") / F.lit(RANGE // BUCKETS)).cast("int")))
    counts = rows.groupBy(label_col, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    w_cls = Window.partitionBy(label_col)
    w_cum = w_cls.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    decide = (counts
              .withColumn("_ncls", F.sum("_cnt").over(w_cls))
              .withColumn("_cum", F.sum("_cnt").over(w_cum))
              .withColumn("_quota", quota)
              .withColumn("_before", F.col("_cum") - F.col("_cnt"))
              .select(label_col, "_b",
                      F.when(F.col("_cum") <= F.col("_quota"), F.lit("test"))
                       .when(F.col("_before") >= F.col("_quota"), F.lit("train"))
                       .otherwise(F.lit("cut")).alias("_kind"),
                      (F.col("_quota") - F.col("_before")).alias("_left")))
    # the decision table is bounded by classes x BUCKETS rows: safe to broadcast
    tagged = rows.join(F.broadcast(decide), [label_col, "_b"], "left")
    whole = tagged.where(F.col("_kind") != "cut").withColumn(out_col, F.col("_kind") == "test")
    cut = tagged.where(F.col("_kind") == "cut")
    w_row = Window.partitionBy(label_col, "_b").orderBy("_h", id_col)
    cut = cut.withColumn(out_col, F.row_number().over(w_row) <= F.col("_left"))
    return whole.unionByName(cut).drop("_h", "_b", "_kind", "_left")


def split_summary(split_df: DataFrame, label_col: str = "severity_class",
                  split_col: str = "is_test") -> DataFrame:
    return (split_df.groupBy(label_col)
            .agg(F.sum((~F.col(split_col)).cast("long")).alias("train_rows"),
                 F.sum(F.col(split_col).cast("long")).alias("test_rows")))


def balanced_weights(df: DataFrame, label_col: str = "severity_class") -> DataFrame:
    """``n / (k * n_class)`` per class, as a (label, weight) table."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy()
    return counts.select(label_col, (F.sum("_n").over(w) / (F.count(F.lit(1)).over(w) * F.col("_n")))
                         .alias("class_weight"))


def with_weights(df: DataFrame, label_col: str = "severity_class",
                 manual: dict[str, float] | None = None, out_col: str = "weight") -> DataFrame:
    """Attach a per-row weight: balanced by default, or a fixed class map.

    The class table has one row per class, so it is broadcast.
    """
    if manual is not None:
        expr = None
        for k, v in manual.items():
            c = F.col(label_col) == k
            expr = F.when(c, F.lit(float(v))) if expr is None else expr.when(c, F.lit(float(v)))
        return df.withColumn(out_col, expr.otherwise(F.lit(1.0)))
    wt = balanced_weights(df, label_col).withColumnRenamed("class_weight", out_col)
    return df.join(F.broadcast(wt), label_col, "left")
