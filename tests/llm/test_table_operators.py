"""Joins, searches, mixing, models and the pipeline against brute force."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from crashlens.llm import catalog, mixing, ngram_join, quality_model, topk
from crashlens.llm.common import table
from crashlens.llm.components import connected_components

SF = "/root/testdata/sf0.01"


def brute_links(texts):
    sets = {i: set(ngram_join.shingles(t or "").tolist()) for i, t in texts.items()}
    near = defaultdict(set)
    ids = sorted(i for i in sets if sets[i])
    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                near[i].add(j)
                near[j].add(i)
    label = {}
    for i in sorted(texts):
        todo = [i] if i not in label else []
        while todo:
            u = todo.pop()
            if u not in label:
                label[u] = i
                todo += near[u]
    return {i: (label[i], len(near[i])) for i in texts}


@pytest.fixture(scope="module")
def copies():
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choices("abcdefg", k=4))
    passage = [word() for _ in range(60)]  # many texts share it
    texts = {}
    for g in range(12):
        base = [word() for _ in range(rnd.choice([3, 30, 80, 150]))]
        for _ in range(rnd.randint(1, 25)):
            t = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                t[rnd.randrange(len(t))] = word()
            texts[len(texts)] = " ".join(t)
    for _ in range(60):
        texts[len(texts)] = " ".join([word() for _ in range(40)] + passage)
    texts |= {len(texts): "", len(texts) + 1: None, len(texts) + 2: "?! ..", len(texts) + 3: "a b", len(texts) + 4: "A, b!"}
    return texts


@pytest.mark.parametrize("block", [512, 16])  # 16: groups of similar texts over several tasks
def test_ngram_join(spark, copies, block, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    docs = spark.createDataFrame(list(copies.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.ngram_join(docs).collect()}
    assert got == brute_links(copies)


def test_ngram_join_keeps_one_of_each_class(spark, copies):
    docs = spark.createDataFrame([(i, t, "x") for i, t in copies.items()], "doc_id long, text string, more string")
    kept = sorted(r["doc_id"] for r in ngram_join.keep_one_per_class(docs.union(docs.limit(50))).collect())
    want = brute_links(copies)
    worded = {i for i, t in copies.items() if len(ngram_join.shingles(t or ""))}
    assert kept == sorted(i for i in copies if i not in worded or want[i][0] == i)


def test_posterior_bound():
    least = ngram_join.least_matches()
    rng = np.random.default_rng(1)
    s = rng.random(2_000_000)
    m = rng.binomial(64, s)
    for tolerance, n in ((0.05, 64),):
        k = ngram_join.least_matches(tolerance=tolerance)[n]
        assert (s[m == k] >= 0.8).mean() >= tolerance - 0.01 and (s[m == k - 1] >= 0.8).mean() < tolerance + 0.01
    assert (np.diff(least[16::16]) >= 0).all() and least[ngram_join.HASHES] < 0.8 * ngram_join.HASHES


def test_components(spark):
    rnd = random.Random(10)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    got = {r["id"]: r["label"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    assert got == label


@pytest.mark.parametrize("sizes", [(4096, 8192), (7, 20)])
def test_top_inner_products(spark, sizes, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", sizes[0])
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", sizes[1])
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(600, 8)) * rng.choice([0.01, 1, 5], size=(600, 1)), 1)
    x[100:200] = x[100]  # ties
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in topk.top_inner_products(df.repartition(3), F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    ints = [[int(np.floor(256 * v)) for v in r] for r in x]
    for q in range(0, 600, 50):
        every = sorted((-sum(a * b for a, b in zip(ints[q], ints[c], strict=True)), c) for c in range(600) if c != q)
        assert got[q] == [(c, -s) for s, c in every[:5]]


def test_scores_beyond_double():
    big = float(1 << 40)
    q, x = np.array([[big, 3.0]]), np.array([[big / 2 ** 20, 1.0], [1.0, -1.0]])
    assert topk.exact_scores(q, x).tolist() == [[2 ** 60 + 3, 2 ** 40 - 3]]
    assert topk.exact_scores(np.array([[big], [1.0]]), np.array([[big], [-big]])).tolist() == [
        [2 ** 63 - 1, -2 ** 63], [2 ** 40, -2 ** 40]]


@pytest.mark.parametrize("sizes", [(4096, 8192), (3, 10)])
def test_top_inner_products_of_huge_components(spark, sizes, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", sizes[0])
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", sizes[1])
    rng = np.random.default_rng(4)
    x = rng.normal(size=(120, 4)) * rng.choice([1.0, 1e7, 1e16, 1e30, 3e38, 1e200], size=(120, 1))
    x[7] = [5e16, 0.3, -0.3, 0.0]  # the floor of its first component passes 64 bits
    x[50] = [1.0, 2.0, 3.0, 4.0]
    x[100] = [3e38, -3e38, 1e30, 0.0]
    lost = {11: [1e307, 1.0, 0.0, 0.0]}  # no double holds its 256-fold
    for i, v in lost.items():
        x[i] = v
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in topk.top_inner_products(df.repartition(3), F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    ints = {i: [math.floor(256.0 * float(v)) for v in r] for i, r in enumerate(x) if i not in lost}
    for q in (0, 50, 100):
        score = {c: max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(ints[q], ints[c], strict=True))))
                 for c in ints if c != q}
        assert got[q] == sorted(score.items(), key=lambda p: (-p[1], p[0]))[:5]


def test_targets_are_reshared(spark):
    data = [("a", 100), ("b", 1000), ("c", 5), (None, 300), ("d", 0), ("e", 40)]
    got = {r["source"]: r["target"] for r in mixing.source_targets(
        spark.createDataFrame(data, "source string, size long")).collect()}
    order = ["a", "b", "c", "d", "e", None]
    size = dict(data)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(size.values()), set()
    while True:  # share, stop those above, share the excess again
        rest = total - sum(2 * size[s] for s in full)
        share = {s: rest * weight[s] / sum(weight[t] for t in order if t not in full) for s in order if s not in full}
        above = {s for s in share if share[s] > 2 * size[s]}
        if not above:
            break
        full |= above
    for s in order:
        assert got[s] == pytest.approx(2 * size[s] if s in full else share[s])


def test_mix_takes_about_the_target(spark):
    docs = table(spark, SF, "documents")
    plan = catalog.QUERIES["op3_mix_sources"](spark, SF)
    rows = plan.join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max(F.col("taken") - 2 * F.col("size")).alias("over"))
    got = rows.collect()
    assert sum(r["taken"] for r in got) == pytest.approx(sum(r["target"] for r in got), rel=0.1)
    assert all(r["over"] <= 0 for r in got)
    mixed = mixing.mix_sources(docs)
    assert mixed.count() == plan.agg(F.sum(F.when(F.col("size") > 0, F.col("taken") / F.col("size")))).first()[0]
    assert mixed.select("doc_id").exceptAll(mixing.mix_sources(docs).select("doc_id")).count() == 0


def test_additive_model_learns_interactions():
    rng = np.random.default_rng(3)
    x = rng.random((6000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_model.AdditiveModel().fit(x[:4000], y[:4000])
    assert ((model.scores(x[4000:]) >= 0.5) == y[4000:]).mean() > 0.9


@pytest.mark.parametrize("name,label,least", [("op9_quality_model", "quality", 0.95), ("op10_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    got = catalog.QUERIES[name](spark, SF).join(table(spark, SF, "labels"), "doc_id").where("held_out").collect()
    right = [r["predicted"] == r[label] for r in got if r[label] is not None]
    assert len(right) > 50 and np.mean(right) >= least


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, SF_SMALL).collect()
    docs = {r["doc_id"]: r["text"] for r in table(spark, SF_SMALL, "documents").collect()}
    assert {r["doc_id"] for r in out} <= set(docs) and len(out) > 50
    links = brute_links(docs)
    heads = [links[r["doc_id"]][0] for r in {x["doc_id"]: x for x in out}.values()]
    assert len(heads) == len(set(heads))  # one document of each class
    assert all(r["n_tokens"] == len(r["ids"]) for r in out)
