"""Exact stratified split and metric tables."""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from crashlens.operators import metrics as M
from crashlens.operators import split


def test_split_exact_and_complete(spark):
    rows = [(i, "Low" if i % 10 < 7 else ("Medium" if i % 10 < 9 else "High")) for i in range(5003)]
    df = spark.createDataFrame(rows, "crash_id long, severity_class string")
    got = split.stratified_split(df).toPandas()
    assert len(got) == len(rows) and got.crash_id.is_unique
    pdf = pd.DataFrame(rows, columns=["crash_id", "severity_class"])
    pdf["h"] = [int(hashlib.md5(f"{i}:42".encode()).hexdigest()[:8], 16) for i in pdf.crash_id]
    pdf = pdf.sort_values(["severity_class", "h", "crash_id"])
    pdf["rk"] = pdf.groupby("severity_class").cumcount() + 1
    n = pdf.groupby("severity_class").crash_id.transform("count")
    pdf["is_test"] = pdf.rk <= (n * 20 + 99) // 100
    want = dict(zip(pdf.crash_id, pdf.is_test))
    assert dict(zip(got.crash_id, got.is_test)) == want


def test_threshold_search_default_when_no_positive(spark):
    df = spark.createDataFrame([("Low", 0.05, 0.9, 0.05)] * 5, "label string, p_high double, p_low double, p_medium double")
    t = {r["class"]: r["threshold"] for r in M.tune_thresholds(df, ["p_high", "p_low", "p_medium"]).collect()}
    assert t["High"] == 0.5 and t["Medium"] == 0.5 and t["Low"] == 0.1


def test_report_zero_division(spark):
    df = spark.createDataFrame([("Low", "Low"), ("Low", "Medium"), ("High", "Low")], "label string, prediction string")
    rep = {r["class"]: r for r in M.class_report(df).collect()}
    assert rep["High"]["precision"] == 0.0 and rep["Medium"]["recall"] == 0.0
    assert abs(rep["accuracy"]["f1"] - 1 / 3) < 1e-12


def test_auc_ties(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1)], "y int, s double")
    auc = M.roc_auc(df, "s", "y").first()["roc_auc"]
    assert abs(auc - 0.625) < 1e-12  # pairs: tie 0.5 + 1 + 0 + 1 over 4


def test_seeds_give_independent_splits(spark):
    df = spark.range(20_000).select(F.col("id").alias("crash_id"), F.lit("Low").alias("severity_class"))
    a, b = ({r["crash_id"] for r in split.stratified_split(df, seed=s).where("is_test").collect()} for s in (42, 43))
    assert len(a) == len(b) == 4000 and 0.17 < len(a & b) / 4000 < 0.23


def test_auc_many_distinct_scores(spark):
    n = 600_000
    df = spark.range(n).select(F.md5(F.col("id").cast("string")).alias("m")).select(
        (F.conv(F.substring("m", 1, 10), 16, 10).cast("double") / 1e12).alias("s"),
        (F.conv(F.substring("m", 11, 2), 16, 10).cast("int") < 100).cast("int").alias("y"))
    pdf = df.toPandas()
    rank = pdf.s.rank().to_numpy()
    pos = pdf.y.to_numpy() == 1
    want = (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (n - pos.sum()))
    got = [M.roc_auc(df.repartition(k), "s", "y").first()["roc_auc"] for k in (5, 11)]
    assert got[0] == got[1] and abs(got[0] - want) < 1e-12
    assert np.isfinite(got[0])
