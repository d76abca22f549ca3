"""Softmax boosting and the training jobs of the versions."""

import math
import tempfile

import pytest
from pyspark.sql import functions as F

from crashlens import constants as K
from crashlens.plans import boosting as B
from crashlens.plans import training as T
from crashlens.plans.features import FeatureMatrix


@pytest.fixture(scope="module")
def rows(spark):
    """Three classes in a plane: High is rare, Medium and Low part by x and y."""
    df = spark.range(1500).select(
        F.col("id").alias("crash_id"), (F.pmod(F.col("id") * 37, F.lit(100)) / 100).alias("x"),
        (F.pmod(F.col("id") * 59, F.lit(101)) / 101).alias("y"), F.lit(1.0).alias("flat"))
    cls = F.when((F.col("x") > 0.9) & (F.col("y") > 0.5), "High").when(F.col("x") + F.col("y") > 1, "Medium").otherwise("Low")
    return df.withColumn("severity_class", cls)


FEATS = ["x", "y", "flat"]


@pytest.fixture(scope="module")
def model(rows):
    return T.fit(rows, FEATS, "softmax", rounds=6, rate=0.3)


def test_losses_fall_and_probabilities_sum_to_one(rows, model):
    assert len(model.losses) == 7 and all(b < a for a, b in zip(model.losses, model.losses[1:]))
    assert model.losses[0] == pytest.approx(math.log(3), rel=1e-9)  # balanced weights: equal shares
    scored = T.score(model, rows).collect()
    assert all(abs(r["p_high"] + r["p_low"] + r["p_medium"] - 1) < 1e-12 for r in scored)
    assert sum(r["predicted_class"] == r["severity_class"] for r in scored) > 0.95 * len(scored)
    assert set(rows.columns) < set(scored[0].asDict())


def test_loss_is_that_of_the_scores(rows, model):
    weights = {c: 1500 / (3 * n) for c, n in rows.groupBy("severity_class").count().collect()}
    scored = T.score(model, rows).collect()
    total = sum(weights[r["severity_class"]] * -math.log(r[f"p_{r['severity_class'].lower()}"]) for r in scored)
    assert total / sum(weights[r["severity_class"]] for r in scored) == pytest.approx(model.losses[-1], rel=1e-9)


def test_first_round_is_a_newton_step(rows):
    model = T.fit(rows, ["x"], "softmax", weights=None, rounds=1, rate=1.0, depth=1)
    share = {c: n / 1500 for c, n in rows.groupBy("severity_class").count().collect()}
    tree, steps = model.rounds[0][0]
    tree.setFeaturesCol("v").setLeafCol("leaf")
    from pyspark.ml.feature import VectorAssembler
    leaves = tree.transform(VectorAssembler(inputCols=["x"], outputCol="v").transform(rows)).groupBy("leaf").agg(
        F.sum((F.col("severity_class") == "High").cast("int")).alias("hits"), F.count(F.lit(1)).alias("n")).collect()
    for r in leaves:
        p = share["High"]
        step = (r["hits"] - r["n"] * p) / (r["n"] * p * (1 - p) + B.RIDGE)
        assert steps[int(r["leaf"])] == pytest.approx(max(-B.LARGEST_STEP, min(B.LARGEST_STEP, step)), rel=1e-9)


def test_manual_weights_favour_the_rare_class(rows):
    plain = T.fit(rows, ["x"], "softmax", weights=None, rounds=3)
    heavy = T.fit(rows, ["x"], "softmax", weights={"High": 8, "Low": 1, "Medium": 2}, rounds=3)
    mean = [T.score(m, rows).agg(F.avg("p_high")).first()[0] for m in (plain, heavy)]
    assert mean[1] > 2 * mean[0]


def test_saved_model_scores_alike(spark, rows, model):
    path = tempfile.mkdtemp(prefix="crashlens-boosting-") + "/v4"
    T.save_bundle(model, path, FEATS, K.DEFAULT_THRESHOLDS)
    again, meta = T.load_bundle(path)
    assert meta["features"] == FEATS and again.losses == model.losses
    assert T.score(again, rows).orderBy("crash_id").collect() == T.score(model, rows).orderBy("crash_id").collect()
    names = [r["feature"] for r in T.feature_importance(model, FEATS, 3).collect()]
    assert names[-1] == "flat" and set(names) == set(FEATS)


def test_labels_that_are_no_class(spark, rows):
    odd = rows.withColumn("severity_class", F.when(F.col("crash_id") % 5 == 0, None).otherwise(F.col("severity_class")))
    kept = odd.where("severity_class is not null")
    a, b = (B.fit_softmax(df, FEATS, "severity_class", K.CLASSES, rounds=2) for df in (odd, kept))
    assert a.losses == pytest.approx(b.losses, rel=1e-12)
    with pytest.raises(ValueError):
        B.fit_softmax(rows.limit(0), FEATS, "severity_class", K.CLASSES)


def test_version_job_with_smote(rows):
    variants = {"a": ("logistic", "balanced"), "b": ("softmax", "balanced")}
    job = T.train_version(FeatureMatrix(rows, FEATS, ["crash_id", "severity_class"]), smote=True, variants=variants,
                          settings={"softmax": {"rounds": 2}, "logistic": {"max_iter": 20}})
    counts = {r["severity_class"]: r["n"] for r in job["train"].groupBy("severity_class").agg(F.count("*").alias("n")).collect()}
    assert len(set(counts.values())) == 1
    assert "is_synthetic" not in job["test"].columns  # test rows are never resampled
    assert job["train"].where("not is_synthetic").count() + job["test"].count() == 1500
    ranked = job["results"].orderBy("rank").collect()
    assert ranked[0]["name"] == job["best"] and ranked[0]["macro_f1"] >= ranked[1]["macro_f1"]


def test_version_rows_are_dealt_to_all_cores(rows, monkeypatch):
    seen = {}

    def compare(train, test, feats, variants, **kw):
        seen["tasks"] = train.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        seen["scored"] = {"a": test}
        return {}, train.sparkSession.createDataFrame([("a", 1)], "name string, rank int"), seen["scored"]
    monkeypatch.setattr(T, "compare", compare)
    monkeypatch.setattr(T, "PART_ROWS", 100)
    one_file = rows.coalesce(1)
    job = T.train_version(FeatureMatrix(one_file, FEATS, ["crash_id", "severity_class"]))
    assert len(seen["tasks"]) >= 4 and max(r["count"] for r in seen["tasks"]) < 600  # of 1,200 training rows
    assert job["train"].count() + job["test"].count() == 1500 and job["scored"] == seen["scored"]
    assert T.dealt(one_file).rdd.getNumPartitions() >= 1500 // 100
