"""Evaluation, threshold search and model choice.

Everything reduces the scored rows to a small table first (one row per
(label, prediction) pair, per (class, threshold bucket), or per distinct
score), so only aggregated rows cross the shuffle and no step ranks the
whole data in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crashlens import constants as K
from crashlens.functions.features import classify_with_thresholds
from crashlens.session import stage_table


def prob_array(cols: list[str]):
    return F.array(*[F.col(c).cast("double") for c in cols])


def pair_counts(scored: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    return scored.groupBy(F.col(label_col).alias("label"), F.col(pred_col).alias("prediction")) \
                 .agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(scored: DataFrame, classes: list[str] = K.CLASSES, label_col: str = "label",
                     pred_col: str = "prediction") -> DataFrame:
    """Rows = true class, one column per predicted class."""
    return (scored.groupBy(F.col(label_col).alias("label"))
            .pivot(pred_col, classes).agg(F.count(F.lit(1)))
            .na.fill(0, subset=classes))


def class_report(scored: DataFrame, classes: list[str] = K.CLASSES, label_col: str = "label",
                 pred_col: str = "prediction") -> DataFrame:
    """Per class precision, recall, F1, support; zero division gives 0.

    Returns one row per class plus ``macro avg`` and ``weighted avg`` rows
    and an ``accuracy`` row (precision = recall = f1 = accuracy).
    """
    pc = pair_counts(scored, label_col, pred_col)
    cls = F.explode(F.array(*[F.lit(c) for c in classes])).alias("cls")
    per = (pc.select("*", cls)
           .groupBy("cls")
           .agg(F.sum(F.when((F.col("label") == F.col("cls")) & (F.col("prediction") == F.col("cls")),
                             F.col("n")).otherwise(0)).alias("tp"),
                F.sum(F.when((F.col("label") != F.col("cls")) & (F.col("prediction") == F.col("cls")),
                             F.col("n")).otherwise(0)).alias("fp"),
                F.sum(F.when((F.col("label") == F.col("cls")) & (F.col("prediction") != F.col("cls")),
                             F.col("n")).otherwise(0)).alias("fn"),
                F.sum(F.when(F.col("label") == F.col("cls"), F.col("n")).otherwise(0)).alias("support"),
                F.sum("n").alias("total")))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    per = per.select(
        F.col("cls").alias("class"),
        F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0).alias("precision"),
        F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0).alias("recall"),
        F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(0.0).alias("f1"),
        F.col("support").cast("long").alias("support"), "tp", "total")
    macro = per.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                    F.sum("support").alias("support"))
    sup = F.col("support")
    weighted = per.agg(F.lit("weighted avg").alias("class"),
                       (F.sum(F.col("precision") * sup) / F.sum(sup)).alias("precision"),
                       (F.sum(F.col("recall") * sup) / F.sum(sup)).alias("recall"),
                       (F.sum(F.col("f1") * sup) / F.sum(sup)).alias("f1"),
                       F.sum(sup).alias("support"))
    acc = per.agg(F.lit("accuracy").alias("class"), *[
        (F.sum("tp") / F.first("total")).alias(c) for c in ("precision", "recall", "f1")],
        F.first("total").alias("support"))
    base = per.select("class", "precision", "recall", "f1", "support")
    return base.unionByName(macro).unionByName(weighted).unionByName(acc)


def summary_metrics(report: DataFrame) -> DataFrame:
    """(accuracy, macro_f1) as one row from a class report."""
    return report.agg(
        F.max(F.when(F.col("class") == "accuracy", F.col("f1"))).alias("accuracy"),
        F.max(F.when(F.col("class") == "macro avg", F.col("f1"))).alias("macro_f1"))


# ------------------------------------------------------------------ thresholds

def threshold_grid() -> list:
    """Grid values exactly as ``start + k * step`` in double arithmetic."""
    return [F.lit(K.THRESHOLD_GRID_START) + F.lit(float(k)) * F.lit(K.THRESHOLD_GRID_STEP)
            for k in range(K.THRESHOLD_GRID_SIZE)]


def tune_thresholds(scored: DataFrame, prob_cols: list[str], classes: list[str] = K.CLASSES,
                    label_col: str = "label") -> DataFrame:
    """Per class, the grid threshold with the best one-vs-rest F1.

    Thresholds with no positive prediction are skipped; among equal F1 the
    smallest threshold wins; a class with no F1 above 0 keeps 0.5.

    Plan: each row and class is reduced to ``nb`` = the number of grid values
    its probability reaches (exact ``p >= t`` tests, no binning error), then
    grouped by (class, positive, nb) -- at most classes x 2 x 18 rows -- and
    the per-threshold tp/fp/fn come from that tiny table.
    """
    grid = F.array(*threshold_grid())
    per_class = F.explode(F.array(*[
        F.struct(F.lit(c).alias("cls"), F.col(p).cast("double").alias("p"))
        for c, p in zip(classes, prob_cols)])).alias("x")
    reduced = (scored.select(F.col(label_col).alias("label"), per_class)
               .select(F.col("x.cls").alias("cls"), (F.col("label") == F.col("x.cls")).alias("pos"),
                       F.size(F.filter(grid, lambda t: F.col("x.p") >= t)).alias("nb"))
               .groupBy("cls", "pos", "nb").agg(F.count(F.lit(1)).alias("n")))
    per_t = (reduced.select("*", F.explode(F.sequence(F.lit(0), F.lit(K.THRESHOLD_GRID_SIZE - 1)))
                            .alias("k"))
             .groupBy("cls", "k")
             .agg(F.sum(F.when(F.col("pos") & (F.col("nb") > F.col("k")), F.col("n")).otherwise(0))
                  .alias("tp"),
                  F.sum(F.when(~F.col("pos") & (F.col("nb") > F.col("k")), F.col("n")).otherwise(0))
                  .alias("fp"),
                  F.sum(F.when(F.col("pos") & (F.col("nb") <= F.col("k")), F.col("n")).otherwise(0))
                  .alias("fn")))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    per_t = per_t.withColumn("f1", F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn))
                             .otherwise(0.0))
    cand = per_t.where((tp + fp > 0) & (F.col("f1") > 0))
    w = Window.partitionBy("cls").orderBy(F.col("f1").desc(), F.col("k").asc())
    best = (cand.withColumn("r", F.row_number().over(w)).where(F.col("r") == 1)
            .select("cls", "k", "f1"))
    all_cls = scored.sparkSession.createDataFrame([(c,) for c in classes], "cls string")
    return (all_cls.join(best, "cls", "left")
            .select(F.col("cls").alias("class"),
                    F.when(F.col("k").isNull(), F.lit(K.DEFAULT_THRESHOLD))
                     .otherwise(F.round(F.lit(K.THRESHOLD_GRID_START)
                                        + F.col("k").cast("double") * F.lit(K.THRESHOLD_GRID_STEP), 2))
                     .alias("threshold"),
                    F.coalesce(F.col("f1"), F.lit(0.0)).alias("binary_f1")))


def apply_thresholds(scored: DataFrame, prob_cols: list[str], thresholds: dict,
                     classes: list[str] = K.CLASSES, out_col: str = "prediction") -> DataFrame:
    """Thresholded class per row."""
    return scored.withColumn(out_col, classify_with_thresholds(prob_array(prob_cols), thresholds,
                                                               classes))


def argmax_class(prob_cols: list[str], classes: list[str] = K.CLASSES):
    """Argmax class, first on ties (plain ``predict``)."""
    return classify_with_thresholds(prob_array(prob_cols), {c: 2.0 for c in classes}, classes)


# ------------------------------------------------------------------ binary

def prefix_sum(df: DataFrame, order_col: str, value_cols: list[str]) -> DataFrame:
    """Running totals of ``value_cols`` in ``order_col`` order, strictly
    before each row (exclusive), computed without a single-task window.

    Rows are dealt in ranges of ``order_col`` and written once, each with the
    number of its range, so rows and totals share the ranges in every run and on
    every retry; a total is that within the range plus those of earlier ranges,
    a table of one row a range. The plan is the same at every size. ``df`` is
    read twice, once to find the ranges: pass a written table.
    """
    placed = stage_table(df.repartitionByRange(order_col).withColumn("_range", F.spark_partition_id()), "prefix-ranges")
    within = Window.partitionBy("_range").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    totals = placed.groupBy("_range").agg(*[F.sum(c).alias(f"_sum_{c}") for c in value_cols]) \
        .select("_range", *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_off_{c}")
                            for c in value_cols])
    out = placed.withColumns({f"_in_{c}": F.coalesce(F.sum(c).over(within), F.lit(0)) for c in value_cols}) \
        .join(F.broadcast(totals), "_range")
    return out.select(*df.columns, *[(F.col(f"_in_{c}") + F.col(f"_off_{c}")).alias(f"before_{c}")
                                     for c in value_cols])


def roc_auc(scored: DataFrame, score_col: str, label_col: str) -> DataFrame:
    """Exact ROC AUC with tied scores counted half (rank formula), one row.

    Grouped by distinct score first, then a distributed prefix sum of the
    negatives below each score. Products of counts are taken in double.
    """
    by_score = stage_table(scored.groupBy(F.col(score_col).cast("double").alias("s"))
                           .agg(F.sum((F.col(label_col) == 1).cast("long")).alias("pos"),
                                F.sum((F.col(label_col) != 1).cast("long")).alias("neg")), "auc-scores")
    ps = prefix_sum(by_score, "s", ["neg"])
    # twice the sum stays an integer: the result does not depend on the order of rows
    twice = F.col("pos").cast("decimal(38,0)") * (2 * F.col("before_neg") + F.col("neg"))
    return ps.agg((F.sum(twice).cast("double") / 2.0
                   / (F.sum("pos").cast("double") * F.sum("neg").cast("double"))).alias("roc_auc"))


def binary_metrics(scored: DataFrame, label_col: str = "label", pred_col: str = "prediction",
                   score_col: str = "p_elevated") -> DataFrame:
    """Accuracy, binary F1 (positive = 1), macro F1 and ROC AUC in one row."""
    pc = scored.groupBy(label_col, pred_col).agg(F.count(F.lit(1)).alias("n"))
    y, p, n = F.col(label_col), F.col(pred_col), F.col("n")
    cnt = pc.agg(F.sum(F.when((y == 1) & (p == 1), n).otherwise(0)).alias("tp"),
                 F.sum(F.when((y == 0) & (p == 1), n).otherwise(0)).alias("fp"),
                 F.sum(F.when((y == 1) & (p == 0), n).otherwise(0)).alias("fn"),
                 F.sum(F.when((y == 0) & (p == 0), n).otherwise(0)).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def f1(a, b, c):
        return F.when(2 * a + b + c > 0, 2 * a / (2 * a + b + c)).otherwise(0.0)
    m = cnt.select(((tp + tn) / (tp + tn + fp + fn)).alias("accuracy"),
                   f1(tp, fp, fn).alias("binary_f1"),
                   ((f1(tp, fp, fn) + f1(tn, fn, fp)) / 2).alias("macro_f1"),
                   F.lit(1).alias("_k"))
    auc = roc_auc(scored, score_col, label_col).withColumn("_k", F.lit(1))
    # both sides are single-row aggregates
    return m.join(F.broadcast(auc), "_k").drop("_k")


# ------------------------------------------------------------------ model choice

def rank_models(results: DataFrame, metric: str = "macro_f1", name_col: str = "name") -> DataFrame:
    """Models ordered by the metric (desc), name as tie-break, with rank."""
    w = Window.orderBy(F.col(metric).desc(), F.col(name_col).asc())
    return results.withColumn("rank", F.row_number().over(w))


def deploy_decision(default_f1, tuned_f1, baseline: float = K.V3_MACRO_F1):
    """``max(default, tuned) > baseline`` as a boolean column."""
    return F.greatest(default_f1, tuned_f1) > F.lit(baseline)
