"""Exact kNN vs numpy brute force (duplicates, tiny blocks, many cells) and
SMOTE invariants: classes equalised, originals untouched, samples between
a row and one of its neighbours."""

import numpy as np
from pyspark.sql import functions as F

from crashlens.operators import resample as RS


def _data(seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(300):
        lab = "A" if i % 5 else "B"
        v = rng.normal(size=6) + (3.0 if lab == "B" else 0.0)
        rows.append((i, lab, v.round(3).tolist()))
    rows += [(1000 + j, "A", rows[1][2]) for j in range(6)]   # exact duplicates
    return rows


def test_knn_exact(spark):
    rows = _data()
    df = spark.createDataFrame(rows, "id long, label string, vec array<double>")
    got = {r["id"]: list(r["nn_ids"]) for r in RS.knn_within_class(df, k=5, block=8).collect()}
    for i, lab, v in rows:
        cand = [(float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), j) for j, l2, w in rows
                if l2 == lab and j != i]
        want = [j for _, j in sorted(cand)[:5]]
        assert got[i] == want, i


def test_smote_invariants(spark):
    rows = _data()
    df = spark.createDataFrame(rows, "id long, label string, vec array<double>")
    out = RS.smote(df, k=5, block=16)
    counts = {r["label"]: r["n"] for r in out.groupBy("label").count().withColumnRenamed("count", "n").collect()}
    assert counts["A"] == counts["B"]
    orig = out.where(~F.col("is_synthetic")).select("id", "vec").collect()
    assert sorted((r["id"], tuple(r["vec"])) for r in orig) == sorted((i, tuple(v)) for i, _, v in rows)
    nn = {r["id"]: r["nn_ids"] for r in RS.knn_within_class(df.where("label = 'B'"), k=5, block=16).collect()}
    vecs = {i: np.array(v) for i, _, v in rows}
    for r in out.where(F.col("is_synthetic")).collect():
        x = vecs[r["source_id"]]
        s = np.array(r["vec"])
        ok = False
        for j in nn[r["source_id"]]:
            d = vecs[j] - x
            u = np.dot(s - x, d) / max(np.dot(d, d), 1e-300)
            if -1e-9 <= u <= 1 + 1e-9 and np.allclose(x + u * d, s, atol=1e-9):
                ok = True
        assert ok


def test_smote_default_neighbours_are_exact(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(1700, 16))
    rows = [(i, "B", v.tolist()) for i, v in enumerate(x)] + [(5000 + i, "A", [0.0] * 16) for i in range(2400)]
    out = RS.smote(spark.createDataFrame(rows, "id long, label string, vec array<double>"), k=3)
    made = out.where("is_synthetic").select("source_id", "vec").collect()
    assert len(made) == 700
    for r in made:
        d = np.sqrt(((x - x[r["source_id"]]) ** 2).sum(1))
        d[r["source_id"]] = np.inf
        near, step = x[np.argsort(d)[:3]] - x[r["source_id"]], np.array(r["vec"]) - x[r["source_id"]]
        u = (near @ step) / (near ** 2).sum(1)
        assert np.abs(near * u[:, None] - step).max(1).min() < 1e-9


def test_smote_of_an_empty_table(spark):
    from crashlens.operators.resample import smote
    none = spark.createDataFrame([], "id long, label string, vec array<double>")
    assert smote(none).count() == 0


def test_knn_sends_each_row_to_few_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(900, 24)), np.repeat(rng.normal(size=(3, 24)), 60, axis=0)])
    df = spark.createDataFrame([(i, "A", v.tolist()) for i, v in enumerate(x)], "id long, label string, vec array<double>")

    def neighbours():
        return {r["id"]: (list(r["nn_ids"]), np.round(r["nn_dists"], 9).tolist())
                for r in RS.knn_within_class(df, k=5, block=8).collect()}
    staged = []
    real = RS.stage_table
    monkeypatch.setattr(RS, "stage_table", lambda d, name: staged.append((name, real(d, name))) or staged[-1][1])
    got = neighbours()
    for i in range(0, len(x), 9):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        d[i] = np.inf
        assert got[i][0] == sorted(range(len(x)), key=lambda j: (d[j], j))[:5], i
    assert dict(staged)["knn-visits"].count() == 0  # 200 KB of vectors are one block
    monkeypatch.setattr(RS, "BLOCK_BYTES", 64 * 24 * 8)  # many blocks and cells: equal results
    assert neighbours() == got
    assert max(r["cell"] for r in dict(staged)["knn-visits"].select("cell").distinct().collect()) > 3


def test_tables_of_vectors_are_not_broadcast(spark, tmp_path):
    df = spark.createDataFrame(_data(), "id long, label string, vec array<double>")
    df.write.parquet(str(tmp_path / "rows"))  # read from files, their size is known and small
    out = RS.smote(spark.read.parquet(str(tmp_path / "rows")), k=5, block=16)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("rightHint=(strategy=merge)") == 3
    assert out.where("is_synthetic").count() > 0


def test_boxes_leave_few_visits(spark, monkeypatch):
    # rows spread along two of eight dimensions, copies, and rows that are no numbers
    rng = np.random.default_rng(8)
    x = np.concatenate([np.hstack([rng.uniform(0, 1000, (3000, 2)), rng.integers(0, 2, (3000, 6))]), np.zeros((40, 8))])
    odd = [(9000, "A", [float("nan")] * 8), (9001, "A", [1.0] * 7 + [float("inf")])]
    df = spark.createDataFrame([(i, "A", v.tolist()) for i, v in enumerate(x)] + odd, "id long, label string, vec array<double>")
    monkeypatch.setattr(RS, "BLOCK_BYTES", 200 * 8 * 8)
    staged = {}
    real = RS.stage_table
    monkeypatch.setattr(RS, "stage_table", lambda d, name: staged.setdefault(name, real(d, name)))
    got = {r["id"]: list(r["nn_ids"]) for r in RS.knn_within_class(df, k=5, block=8).collect()}
    assert got[9000] == [] and len(got) == len(x) + 2
    for i in range(0, len(x), 7):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        d[i] = np.inf
        assert got[i] == sorted(range(len(x)), key=lambda j: (d[j], j))[:5], i
    cells = staged["knn-assigned"].select("cell").distinct().count()
    # finite rows meet few of the cells besides their own; a box that is no number is met by all
    assert cells > 50 and staged["knn-visits"].where("id < 9000").count() < 6 * len(x)
