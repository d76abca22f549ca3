"""Models at sf0.001 (small tree counts for speed), bundles, streaming."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from crashlens import constants as K
from crashlens.plans import features as PF
from crashlens.plans import training as TR
from crashlens.sources.tables import crashes


@pytest.fixture(scope="module")
def matrix(spark):
    from crashlens.session import stage_table
    fm = PF.build_v4(PF.spatial_enriched(crashes(spark, SF_SMALL)))
    fm.df = stage_table(fm.df, "test-v4")
    return fm


def test_feature_list_shape(matrix):
    f = matrix.features
    assert f[:8] == K.V2_NUMERIC_COLS and f[8:14] == K.SPATIAL_COLS
    assert f[-3:] == [f"light_phase_{p}" for p in K.LIGHT_PHASES]
    assert all(x.startswith("weath_cond_descr_") for x in f[14:-3])


def test_multiclass_gbt_and_selection(spark, matrix):
    res = TR.train_v4(matrix, variants={"a_gbt": ("gbt_ovr", "balanced"),
                                        "b_gbt": ("gbt_ovr", dict(K.MANUAL_CLASS_WEIGHTS))}, trees=5)
    ranked = res["results"].orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == [1, 2]
    assert ranked[0]["macro_f1"] >= ranked[1]["macro_f1"]
    assert set(res["thresholds"]) == set(K.CLASSES)
    assert isinstance(res["deploy"], bool)
    sc = TR.score(res["models"][res["best"]], matrix.df)
    s = sc.select((F.col("p_high") + F.col("p_low") + F.col("p_medium")).alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-9 for r in s)


def test_bundle_round_trip_and_cascade(spark, matrix):
    train = matrix.df.where(~F.col("is_test"))
    m = TR.fit(train, matrix.features, "random_forest", trees=10)
    root = tempfile.mkdtemp(prefix="crashlens-bundle-")
    TR.save_bundle(m, f"{root}/v2", matrix.features, K.DEFAULT_THRESHOLDS, matrix.weather_keep)
    path = TR.resolve_bundle(root)
    assert path.endswith("v2")
    m2, meta = TR.load_bundle(path)
    assert meta["features"] == matrix.features and meta["thresholds"] == K.DEFAULT_THRESHOLDS
    a = TR.score(m, matrix.df).select("crash_id", "p_high").orderBy("crash_id").collect()
    b = TR.score(m2, matrix.df).select("crash_id", "p_high").orderBy("crash_id").collect()
    assert a == b
    imp = TR.feature_importance(m, matrix.features, top_k=5).collect()
    assert len(imp) == 5 and imp[0]["importance"] >= imp[-1]["importance"]


def test_binary_model(spark, matrix):
    train = matrix.df.where(~F.col("is_test"))
    m = TR.fit(train, matrix.features, "gbt_binary", trees=5)
    sc = TR.score(m, matrix.df.where(F.col("is_test")))
    assert sc.where((F.col("p_elevated") < 0) | (F.col("p_elevated") > 1)).count() == 0


def test_stream_equals_batch(spark):
    from __spark_entry__ import queries
    from crashlens import catalog
    streamed = {r["request_id"]: r for r in queries()["stream_route_scoring"](spark, SF_SMALL)
                .drop("batch_id").collect()}
    _, rec = catalog.route_risk_job(spark, SF_SMALL)
    batch = {r["request_id"]: r for r in rec.collect()}
    assert streamed and set(streamed) == set(batch)
    assert all(streamed[k].asDict() == batch[k].asDict() for k in batch)


def test_redelivered_requests_are_scored_once(spark, matrix, tmp_path):
    from crashlens.plans import route_risk as RR
    from crashlens.session import ensure_checkpoint_dir
    from crashlens.sources import fixtures as FXT
    from crashlens.streaming import route_feed
    feed = FXT.route_payloads(spark, SF_SMALL).join(FXT.weather_payloads(spark, SF_SMALL), "request_id") \
        .select(*[f.name for f in route_feed.FEED_SCHEMA]).where("request_id % 5 = 0")
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    first = feed.coalesce(1)
    first.unionByName(first.where("request_id % 2 = 0")).coalesce(1).write.mode("append").parquet(src)
    first.write.mode("append").parquet(src)  # all of them land again
    model = TR.fit(matrix.df, matrix.features, "random_forest", trees=5)

    def staged():
        root = ensure_checkpoint_dir(spark).removeprefix("file:")
        return {d for d in os.listdir(root) if d.startswith("stage-")}
    before = staged()
    q = route_feed.start(spark, src, out, str(tmp_path / "ck"), model, matrix.features,
                         RR.serving_history(crashes(spark, SF_SMALL)), max_files_per_trigger=1)
    q.awaitTermination()
    assert q.exception() is None
    assert {d.split("-")[1] + "-" + d.split("-")[2] for d in staged() - before} == {"feed-history"}
    rec = spark.read.parquet(f"{out}/recommendations")
    assert rec.count() == rec.select("request_id").distinct().count() > 0
    ids = {r["request_id"] for r in rec.collect()}
    assert ids <= {r["request_id"] for r in feed.collect()}


def test_version_jobs_train_in_full(spark, monkeypatch):
    from crashlens import catalog
    asked = {}

    def job(matrix, **kw):
        asked.update(kw)
        raise InterruptedError
    monkeypatch.setattr(catalog.TRN, "train_version", job)
    with pytest.raises(InterruptedError):
        catalog._version_facts(None)
    assert not asked.get("settings")  # the estimators' own numbers of iterations, trees and rounds
    assert TR.estimator("logistic").getMaxIter() == 1000 and TR.estimator("random_forest").getNumTrees() == 200
