"""Versioned tables (A2, A3), incremental neighbourhood sums, JSON with changing fields (A1)."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlens import constants as K
from crashlens.plans import incremental
from crashlens.sources import drift, sinks, snapshots

SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()),
                       T.StructField("c", T.DoubleType()), T.StructField("d", T.BooleanType())])


def folder() -> str:
    return tempfile.mkdtemp(prefix="crashlens-snap-") + "/t"


def test_readers_keep_their_version(spark):
    path = folder()
    assert snapshots.versions(spark, path) == []
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, path, ["t"])
    first = sinks.cached_table(spark, path, lambda: spark.range(5))
    second = sinks.cached_table(spark, path, lambda: spark.range(7), force_refresh=True)
    assert (first.count(), second.count()) == (5, 7)  # the first reader goes on after the refresh
    assert snapshots.versions(spark, path) == [1, 2]
    sinks.cached_table(spark, path, lambda: spark.range(9), force_refresh=True)
    assert snapshots.versions(spark, path) == [2, 3] and second.count() == 7


def test_one_of_two_writers_commits(spark):
    path = folder()
    assert snapshots.commit(spark, path, {"t": spark.range(1)}, after=0) == 1
    assert snapshots.commit(spark, path, {"t": spark.range(2)}, after=1) == 2
    with pytest.raises(snapshots.CommitConflict):
        snapshots.commit(spark, path, {"t": spark.range(3)}, after=1)
    assert snapshots.read(spark, path, ["t"])[0].count() == 2
    assert snapshots.read(spark, path, ["t"], version=1)[0].count() == 1
    fs, data = snapshots._hadoop(spark, f"{path}/data")
    assert len(fs.listStatus(data)) == 2  # the loser's data are gone


def test_a_version_without_commit_is_not_seen(spark):
    path = folder()
    snapshots.commit(spark, path, {"t": spark.range(1)})
    spark.range(9).write.parquet(f"{path}/data/crashed-writer/t")
    assert snapshots.read(spark, path, ["t"])[0].count() == 1


def test_incremental_equals_rebuild(spark):
    rnd = random.Random(3)

    def rows(n, lat, lon, step):
        return [(round(lat + rnd.randrange(60) * step, 6), round(lon + rnd.randrange(60) * step, 6),
                 rnd.choice(["Low", "Medium", "High"]), rnd.randrange(3)) for _ in range(n)]

    # a city, the antimeridian, and places near a pole
    data = rows(900, 42.3, -71.1, 0.0006) + rows(150, -16.5, 179.99, 0.0004) + rows(150, -16.5, -179.995, 0.0002) \
        + rows(200, 89.96, 10.0, 0.0006) + rows(60, 89.97, -160.0, 0.0005)
    data += [(None, 1.0, "Low", 0), (2.0, None, "High", 1), (42.3, -71.1, None, 2)]
    df = spark.createDataFrame(data, "lat double, lon double, severity_class string, part int")
    path = folder()
    for i in (0, 1, 2, 1):  # the second batch is delivered again
        incremental.refresh(spark, path, df.where(F.col("part") == i), f"b{i}")
    assert snapshots.versions(spark, path) == [1, 2, 3]
    _, want = incremental.first_state(df)
    got = snapshots.read(spark, path, ["sums"])[0]
    as_set = lambda d: {tuple(r) for r in d.select("lat", "lon", *incremental.SUMS).collect()}
    assert as_set(got) == as_set(want) and got.count() == want.count() > 500
    empty = df.where("false")
    assert incremental.refresh(spark, path, empty, "nothing") == 4
    assert as_set(snapshots.read(spark, path, ["sums"])[0]) == as_set(want)


def test_first_state_is_counted(spark):
    # a count needs no column, and queries and history are one table
    df = spark.createDataFrame([(42.3, -71.1, "Low"), (42.3005, -71.1, "High"), (43.0, -71.1, "Medium")],
                               "lat double, lon double, severity_class string")
    locations, sums = incremental.first_state(df)
    assert locations.count() == sums.count() == 3
    assert {(r["lat"], r["n_big"]) for r in sums.collect()} == {(42.3, 2), (42.3005, 2), (43.0, 1)}


def test_incremental_with_crowded_tiles(spark):
    # tiles that are split into parts: queries and history still come from one table
    df = spark.createDataFrame([(42.3 + i % 20 * 1e-3, -71.1 + i // 20 * 1e-3, K.CLASSES[i % 3], i % 2) for i in range(300)],
                               "lat double, lon double, severity_class string, part int")
    path = folder()
    for i in (0, 1):
        incremental.refresh(spark, path, df.where(F.col("part") == i), f"b{i}", max_cell_locations=100)
    got, want = snapshots.read(spark, path, ["sums"])[0], incremental.first_state(df)[1]
    assert got.count() == 300 and got.select(want.columns).exceptAll(want).count() == 0


def test_json_fields_that_change(spark):
    lines = ['{"a":1,"b":"x","c":2.5,"d":true}', '{"a":"7","b":5,"c":3,"z":{"q":[1,null]}}', '{"a":2.5,"b":[1],"c":"no"}',
             '{"a":null,"b":null}', "{}", "[1]", "not json", '{"a":1,"a":2}', "", None, '{"a":99999999999,"d":"maybe"}',
             '{"A":1,"rescued":2}']
    df = spark.createDataFrame(list(enumerate(lines)), "i int, value string")
    got = {r["i"]: (r["a"], r["b"], r["c"], r["d"], r["rescued"], r["is_bad"])
           for r in drift.ingest_json(df, SCHEMA).collect()}
    none = (None,) * 4
    assert got[0] == (1, "x", 2.5, True, None, False)
    assert got[1] == (7, "5", 3.0, None, '{"z":{"q":[1,null]}}', False)
    assert got[2] == (*none, '{"a":2.5,"b":[1],"c":"no"}', False)
    assert got[3] == got[4] == (*none, None, False)
    assert [got[i] for i in (5, 6, 7, 8, 9)] == [(*none, lines[i], True) for i in (5, 6, 7, 8, 9)]
    assert got[10] == (*none, '{"a":99999999999,"d":"maybe"}', False)
    assert got[11] == (*none, '{"A":1,"rescued":2}', False)
    with pytest.raises(ValueError):
        drift.ingest_json(df.withColumnRenamed("i", "B"), SCHEMA)
    assert drift.ingest_json(df.where("false"), SCHEMA).count() == 0


def test_drift_report(spark):
    rows = [(1, '{"a":1,"b":"x","c":1.5,"d":false}'), (1, '{"a":null,"b":"y","c":2,"d":true}'),
            (2, '{"a":"1","b":"x","c":1.5,"e":[1]}'), (2, '{"a":1,"b":"x","c":1.5,"e":"t"}'), (2, "broken"),
            (None, '{"a":1,"b":"x","d":true}')]
    df = spark.createDataFrame(rows, "day int, value string")
    got = {tuple(r) for r in drift.schema_drift(df, SCHEMA, "day").collect()}
    assert got == {(2, "a", "retyped", 2, 2, "number,text"), (2, "d", "missing", 2, 0, ""),
                   (2, "e", "added", 2, 2, "array,text"), (None, "c", "missing", 1, 0, "")}
    assert drift.schema_drift(df.where("false"), SCHEMA, "day").count() == 0
