"""Model training, evaluation, scoring and persistence.

Spark ML replaces the single-machine estimators:

* logistic regression, 1000 iterations, class-weighted (G3)
* random forest, 200 trees of Spark's default depth 5, class-weighted (G4)
* gradient boosting, multiclass: ``softmax``, trees of all classes boosted
  together (:mod:`crashlens.plans.boosting`), with balanced or manual weights
  (G5). ``gbt_ovr`` is Spark's binary GBT one-vs-rest; each class model's margin
  ``m`` gives ``sigmoid(2m)``, normalised to sum to 1, which is not calibrated.
* binary gradient boosting, Safe vs Elevated (G6)

Every model is a ``PipelineModel`` (assembler + estimator) scored in one
batch (G7); probabilities come back as plain columns in class order.
Training data is the staged feature matrix, so iterations re-read Parquet.
"""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlens import constants as K
from crashlens.operators import metrics as M
from crashlens.operators import split
from crashlens.plans.boosting import SoftmaxBoosting, fit_softmax
from crashlens.session import stage_table
from crashlens.sources.sinks import path_exists

PROB_COLS = ["p_high", "p_low", "p_medium"]


def label_indexer(label_col: str = "severity_class") -> StringIndexer:
    """Alphabetical order gives High=0, Low=1, Medium=2 (the class order)."""
    return StringIndexer(inputCol=label_col, outputCol="label_idx", stringOrderType="alphabetAsc",
                         handleInvalid="error")


def estimator(kind: str, weight_col: str | None = "weight", seed: int = 42,
              trees: int | None = None, max_iter: int | None = None):
    common = {"featuresCol": "features", "labelCol": "label_idx"}
    if kind == "logistic":
        est = LogisticRegression(maxIter=max_iter or 1000, family="multinomial", **common)
    elif kind == "random_forest":
        est = RandomForestClassifier(numTrees=trees or 200, seed=seed, **common)
    elif kind == "gbt_ovr":
        base = GBTClassifier(maxIter=trees or 300, seed=seed, featuresCol="features",
                             labelCol="label_idx")
        est = OneVsRest(classifier=base, **common)
    elif kind == "gbt_binary":
        est = GBTClassifier(maxIter=trees or 300, seed=seed, **common)
    else:
        raise ValueError(kind)
    if weight_col:
        est.setWeightCol(weight_col)
    return est


def fit(train: DataFrame, features: list[str], kind: str, label_col: str = "severity_class",
        weights: str | dict | None = "balanced", **kw) -> PipelineModel | SoftmaxBoosting:
    """Fit assembler + label index + estimator on ``train``; kind ``softmax``
    takes the settings of :func:`fit_softmax`.

    ``weights``: ``"balanced"`` (n / (k n_class)), a fixed class map, or None.
    """
    df = train
    binary = kind == "gbt_binary"
    if binary:  # Safe (Low) = 0, Elevated (Medium, High) = 1 (E25)
        from crashlens.functions.features import binary_target
        df = df.withColumn("label_idx", binary_target(label_col).cast("double"))
        label_col = "label_idx"
    wcol = None
    if weights == "balanced":
        df, wcol = split.with_weights(df, label_col), "weight"
    elif isinstance(weights, dict):
        df, wcol = split.with_weights(df, label_col, manual=weights), "weight"
    if kind == "softmax":
        return fit_softmax(df, features, label_col, list(K.CLASSES), weight_col=wcol, **kw)
    stages = [VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")]
    if not binary:
        stages.append(label_indexer(label_col))
    stages.append(estimator(kind, wcol, **kw))
    return Pipeline(stages=stages).fit(df)


def score(model: PipelineModel | SoftmaxBoosting, df: DataFrame, classes: list[str] = K.CLASSES) -> DataFrame:
    """Batch scoring (G7): class probabilities as ``p_high, p_low, p_medium``
    (or ``p_elevated`` for binary models) plus the argmax ``prediction``."""
    if isinstance(model, SoftmaxBoosting):
        return model.scored(df, PROB_COLS).withColumn("predicted_class", M.argmax_class(PROB_COLS, classes))
    out = model.transform(df)
    est = model.stages[-1]
    if "probability" in out.columns:
        arr = vector_to_array("probability")
    else:  # one-vs-rest: normalised sigmoid of each class margin
        raw = vector_to_array("rawPrediction")
        sig = F.transform(raw, lambda m: F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * m)))
        total = F.aggregate(sig, F.lit(0.0), lambda a, b: a + b)
        arr = F.transform(sig, lambda s: s / total)
    out = out.withColumn("_p", arr)
    n = est.numClasses if hasattr(est, "numClasses") else len(classes)
    if n == 2:
        out = out.withColumn("p_elevated", F.col("_p")[1])
    else:
        out = out.withColumns({c: F.col("_p")[i] for i, c in enumerate(PROB_COLS)})
        out = out.withColumn("predicted_class", M.argmax_class(PROB_COLS, classes))
    return out.drop("_p", "features", "rawPrediction", "probability")


def evaluate(scored: DataFrame, name: str, label_col: str = "severity_class",
             pred_col: str = "predicted_class") -> DataFrame:
    """(name, accuracy, macro_f1) for one scored test set."""
    rep = M.class_report(scored, label_col=label_col, pred_col=pred_col)
    return M.summary_metrics(rep).select(F.lit(name).alias("name"), "accuracy", "macro_f1")


def feature_importance(model: PipelineModel | SoftmaxBoosting, features: list[str], top_k: int = 15) -> DataFrame:
    """Top-k importances of a tree model, with a spatial tag."""
    spark = SparkSession.getActiveSession()
    est = None if isinstance(model, SoftmaxBoosting) else model.stages[-1]
    if est is None:
        imp = model.importances()
    elif hasattr(est, "featureImportances"):
        imp = est.featureImportances.toArray().tolist()
    elif hasattr(est, "models"):
        imp = [0.0] * len(features)
        for m in est.models:
            for i, v in enumerate(m.featureImportances.toArray().tolist()):
                imp[i] += v / len(est.models)
    else:
        raise ValueError("model has no feature importances")
    rows = [(f, float(v), "nearby_" in f) for f, v in zip(features, imp)]
    df = spark.createDataFrame(rows, "feature string, importance double, is_spatial boolean")
    return df.orderBy(F.col("importance").desc(), F.col("feature")).limit(top_k)


# ------------------------------------------------------------------ persistence

def save_bundle(model: PipelineModel | SoftmaxBoosting, path: str, features: list[str], thresholds: dict,
                weather_keep: list[str] | None = None, classes: list[str] = K.CLASSES) -> None:
    """Model plus its metadata (features, classes, thresholds, kept weather
    columns) under one folder (A5)."""
    if isinstance(model, SoftmaxBoosting):
        model.save(f"{path}/model")
    else:
        model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    meta = {"features": features, "classes": classes, "thresholds": thresholds,
            "weather_keep": weather_keep or []}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1) \
        .write.mode("overwrite").text(f"{path}/meta")


def load_bundle(path: str) -> tuple[PipelineModel | SoftmaxBoosting, dict]:
    spark = SparkSession.getActiveSession()
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    boosted = path_exists(spark, f"{path}/model/softmax")
    return (SoftmaxBoosting if boosted else PipelineModel).load(f"{path}/model"), meta


def resolve_bundle(root: str, versions: tuple[str, ...] = ("v4", "v3", "v2")) -> str:
    """First existing version folder under ``root`` (A6), newest first.

    Paths are looked up through the session's Hadoop file system, so local
    folders and shared stores work alike.
    """
    spark = SparkSession.getActiveSession()
    for v in versions:
        if path_exists(spark, f"{root}/{v}/model"):
            return f"{root}/{v}"
    raise FileNotFoundError(f"no model bundle under {root}")


def write_reports(results: DataFrame, thresholds: DataFrame, features: list[str], out: str) -> None:
    """Comparison table as CSV, thresholds as JSON, feature list as text (A4)."""
    spark = results.sparkSession
    results.coalesce(1).write.mode("overwrite").option("header", "true").csv(f"{out}/model_comparison")
    thresholds.coalesce(1).write.mode("overwrite").json(f"{out}/thresholds")
    spark.createDataFrame([(f,) for f in features], "feature string").coalesce(1) \
        .write.mode("overwrite").text(f"{out}/feature_list")


# ------------------------------------------------------------------ training jobs

#: The three estimators that versions 1 to 3 are compared by, class-balanced.
COMPARED = {"LogisticRegression": ("logistic", "balanced"), "RandomForest": ("random_forest", "balanced"),
            "Boosting": ("softmax", "balanced")}


def compare(train: DataFrame, test: DataFrame, feats: list[str], variants: dict, settings: dict | None = None,
            **kw) -> tuple[dict, DataFrame, dict]:
    """Fit each variant (name: (kind, weights)) on ``train`` and rank them by macro F1
    on ``test`` (name breaks ties, E3); returns the models, the written ranking and each
    model's test rows as scored, written without the features.
    ``settings`` holds a kind's own settings, ``kw`` those of all."""
    models, scored, results = {}, {}, None
    for name, (kind, weights) in variants.items():
        models[name] = fit(train, feats, kind, weights=weights, **kw, **(settings or {}).get(kind, {}))
        scored[name] = stage_table(score(models[name], test).drop(*feats), "model-scores")
        r = evaluate(scored[name], name)
        results = r if results is None else results.unionByName(r)
    return models, stage_table(M.rank_models(results), "model-ranking"), scored


#: Most rows of a file that estimators read.
PART_ROWS = 100_000


def dealt(rows: DataFrame) -> DataFrame:
    """``rows`` in even parts of PART_ROWS rows at most, as many for every core, so that
    each pass of an estimator keeps all cores busy whatever files the rows came from: a
    matrix is small on disk, and few files of it would be few tasks."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores * max(1, -(-rows.count() // (PART_ROWS * cores))))


def resampled(train: DataFrame, feats: list[str], label_col: str = "severity_class", key: str = "crash_id",
              **smote_settings) -> DataFrame:
    """Training rows oversampled to equal classes by SMOTE, written once, with
    ``label_col``, the feature columns and ``is_synthetic`` (v3)."""
    from crashlens.operators import resample
    rows = resample.smote(train.select(F.col(key).alias("id"), F.col(label_col).alias("label"),
                                       F.array(*[F.col(f).cast("double") for f in feats]).alias("vec")),
                          **smote_settings)
    return stage_table(rows.select(F.col("label").alias(label_col), "is_synthetic",
                                   *[F.get("vec", i).alias(f) for i, f in enumerate(feats)]), "resampled")


def train_version(matrix, smote: bool = False, variants: dict | None = None, seed: int = 42, **kw) -> dict:
    """Training job of versions 1 to 3: a stratified split of the matrix, SMOTE on
    the training rows alone if asked for (v3), the compared estimators, their
    ranking on the test rows, and the best of them."""
    rows = stage_table(dealt(matrix.df), "version-matrix")
    parts = stage_table(split.stratified_split(rows, seed=seed), "version-split")
    train, test = parts.where(~F.col("is_test")), parts.where(F.col("is_test"))
    if smote:
        train = resampled(train, matrix.features)
    models, ranked, scored = compare(train, test, matrix.features, variants or COMPARED, **kw)
    best = ranked.where(F.col("rank") == 1).first()["name"]
    return {"models": models, "results": ranked, "best": best, "train": train, "test": test, "scored": scored}



def train_v4(matrix, variants: dict | None = None, tune_on: str = "test",
             baseline: float = K.V3_MACRO_F1, **kw) -> dict:
    """Fit the v4 variants on the training rows, evaluate on the test rows,
    pick the best by macro F1 (name breaks ties, E3), tune per-class
    thresholds (D10) and decide deployment (G8).

    ``tune_on="test"`` follows the reference (thresholds tuned on the test
    rows); ``"validation"`` tunes on a split of the training rows instead.
    """
    df, feats = matrix.df, matrix.features
    train = df.where(~F.col("is_test"))
    test = df.where(F.col("is_test"))
    tune_rows = test
    if tune_on == "validation":  # carved out first: no validation row is ever fitted on
        parts = stage_table(split.stratified_split(train.select("crash_id", "severity_class", *feats), seed=7,
                                                   out_col="is_val"), "train-validation")
        train, tune_rows = parts.where(~F.col("is_val")), parts.where(F.col("is_val"))
    variants = variants or {"boosting_balanced": ("softmax", "balanced"),
                            "boosting_manual_weights": ("softmax", dict(K.MANUAL_CLASS_WEIGHTS))}
    models, ranked, _ = compare(train, test, feats, variants, **kw)
    best_row = ranked.where(F.col("rank") == 1).first()
    best = models[best_row["name"]]
    tuned = M.tune_thresholds(score(best, tune_rows).withColumnRenamed("severity_class", "label"),
                              PROB_COLS)
    thr = {r["class"]: r["threshold"] for r in tuned.collect()}
    tuned_scored = M.apply_thresholds(score(best, test), PROB_COLS, thr, out_col="tuned_class")
    tuned_f1 = M.summary_metrics(M.class_report(tuned_scored, label_col="severity_class",
                                                pred_col="tuned_class")).first()["macro_f1"]
    deploy = max(best_row["macro_f1"], tuned_f1) > baseline
    return {"models": models, "results": ranked, "best": best_row["name"], "thresholds": thr,
            "threshold_table": tuned, "tuned_macro_f1": tuned_f1, "deploy": deploy}
