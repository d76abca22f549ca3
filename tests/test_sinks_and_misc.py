"""Sinks (A2-A4), column alignment (B15), whole-route features."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from crashlens import constants as K
from crashlens.operators import cleaning
from crashlens.sources import sinks
from crashlens.sources.tables import crashes, read_crashes


def test_cached_table_and_refresh(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="crashlens-cache-"), "t")
    calls = []

    def build(v):
        def f():
            calls.append(v)
            return spark.range(3).withColumn("v", F.lit(v))
        return f
    assert {r["v"] for r in sinks.cached_table(spark, path, build(1)).collect()} == {1}
    assert {r["v"] for r in sinks.cached_table(spark, path, build(2)).collect()} == {1}
    assert {r["v"] for r in sinks.cached_table(spark, path, build(3), force_refresh=True).collect()} == {3}
    assert calls == [1, 3]


def test_enriched_partitioned_and_schema_reads(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="crashlens-enriched-"), "e")
    c = crashes(spark, SF_SMALL)
    sinks.write_enriched(c, out)
    assert any(d.startswith("year=") for d in os.listdir(out))
    def same(back):  # every value comes back, in both directions
        names = [x for x in c.columns if x in back.columns]
        a, b = c.select(*names), back.select(*names)
        return len(names) > 10 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    assert same(read_crashes(spark, out))
    js = os.path.join(tempfile.mkdtemp(prefix="crashlens-json-"), "j")
    c.write.json(js)
    assert same(read_crashes(spark, js, "json"))
    csv = os.path.join(tempfile.mkdtemp(prefix="crashlens-csv-"), "c")
    c.write.option("header", "true").csv(csv)
    assert same(read_crashes(spark, csv, "csv"))


def test_align_columns(spark):
    df = spark.createDataFrame([(1, 2.0)], "id long, a double")
    r = cleaning.align_columns(df, ["b", "a"], keep=["id"]).first()
    assert r.asDict() == {"id": 1, "b": 0, "a": 2.0}


def test_reports_written(spark):
    from crashlens.plans import training as TR
    out = tempfile.mkdtemp(prefix="crashlens-reports-")
    res = spark.createDataFrame([("a", 0.5, 0.4)], "name string, accuracy double, macro_f1 double")
    thr = spark.createDataFrame(list(K.DEFAULT_THRESHOLDS.items()), "class string, threshold double")
    TR.write_reports(res, thr, ["x", "y"], out)
    assert spark.read.option("header", "true").csv(f"{out}/model_comparison").count() == 1
    assert [r[0] for r in spark.read.text(f"{out}/feature_list").collect()] == ["x", "y"]


def test_whole_route_features(spark):
    from crashlens import catalog as C
    from crashlens.plans import route_risk as RR
    from crashlens.sources import fixtures as FXT
    from crashlens.sources import payloads as PL
    rp = FXT.route_payloads(spark, SF_SMALL)
    rt = RR.parsed_routes(rp)
    weather, _ = PL.parse_weather(FXT.weather_payloads(spark, SF_SMALL))
    names = C.serving_feature_names(spark, SF_SMALL)
    w = RR.whole_route_features(rt, RR.request_time_features(rp), weather,
                                RR.serving_history(crashes(spark, SF_SMALL)), names)
    rows = w.collect()
    n_ok = weather.count()
    assert len(rows) == n_ok                      # one row per served request
    mids = {r["request_id"]: (r["midpoint_coords"]["lat"], r["base_speed_mph"])
            for r in rt.where("route_idx = 0").collect()}
    for r in rows:
        assert (r["lat"], r["speed_limit"]) == mids[r["request_id"]]
        assert sum(r[f] for f in names if f.startswith("light_phase_")) == 1
