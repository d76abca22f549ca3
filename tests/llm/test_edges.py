"""Every operator and stage on awkward tables: nulls in any column, empty and
long texts, repeated rows, clashing names, and no rows at all."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from crashlens.llm import (byte_bpe, labelled, license_scan, mixing, ngram_join, page_text, pii,
                           quality_model, quality_rules, topk, toxicity)

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that the operators use themselves
    T.StructField("size", T.StringType()), T.StructField("kept", T.StringType()),
    T.StructField("group", T.StringType()), T.StructField("n_words", T.StringType()),
    T.StructField("rate", T.StringType()), T.StructField("score", T.StringType()),
    T.StructField("digest", T.StringType()), T.StructField("copies", T.StringType())])
WORDS = " ".join(f"word{i} plain{i % 97}" for i in range(60))


def rows():
    clash = ("a", "b", "c", "d", "e", "f", "g", "h")
    texts = [(1, WORDS, "en", "s1"), (1, WORDS, "en", "s1"), (2, WORDS, "en", None),
             (3, None, None, None), (None, None, None, None), (None, WORDS + " more", "en", "s1"),
             (4, "", "en", "s2"), (5, " \n\t ", "en", "s2"), (6, "!!! ???", "en", "s1"),
             (7, " ".join(f"long{i}" for i in range(40_000)), "en", "s1"),
             (8, "x" * 300_000, "de", "s1"), (9, "mail a.b@c.de now", None, "s1"),
             (10, "你好 wörld 🎉    end", "fr", "s3")]
    return [(i, t, la, s, None if t is None else len(t), *clash) for i, t, la, s in texts]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def column_ops(spark):
    model = quality_model.AdditiveModel().fit(*_sample())
    return {
        "license": lambda c: license_scan.license_scan(c), "bpe": lambda c: byte_bpe.bpe_digests(c, PATH),
        "pii": lambda c: pii.pii_spans(c, {}), "redact": lambda c: pii.redact(c, {}),
        "quality": lambda c: quality_model.quality_score(c, model),
        "toxic": lambda c: toxicity.toxicity_score(c, ([], [0.0] * toxicity.FEATURES, 0.0))}


def _sample():
    import numpy as np
    x = np.random.default_rng(0).random((200, len(quality_model.NAMES)))
    return x, (x[:, 0] + x[:, 1] * x[:, 2] > 0.8).astype(float)


@pytest.mark.parametrize("name", ["license", "bpe", "pii", "redact", "quality", "toxic"])
def test_column_operators(spark, docs, none, name):
    op = column_ops(spark)[name]
    got = docs.select("doc_id", F.length("text").alias("n"), op(F.col("text")).alias("r")).collect()
    assert len(got) == len(rows())
    same = {(r["doc_id"], r["n"]): r["r"] for r in got}
    assert all(same[r["doc_id"], r["n"]] == r["r"] for r in got)  # repeated rows agree
    empty = {str(r["r"]) for r in got if not r["n"]}
    assert len(empty) == 1 or name == "redact"
    assert none.select(op(F.col("text")).alias("r")).count() == 0


def test_table_operators(spark, docs, none):
    assert quality_rules.quality_verdicts(docs).count() == len(rows())
    assert quality_rules.quality_verdicts(none).count() == 0
    assert quality_rules.keep_good(docs).columns == docs.columns
    mixed = mixing.mix_sources(docs)
    assert mixed.columns == docs.columns and mixed.where("doc_id = 1").count() in (0, 2, 4)
    assert mixing.mix_sources(none).count() == 0
    joined = {(r["doc_id"], r["class_id"], r["n_links"]) for r in ngram_join.ngram_join(docs).collect()}
    assert {(1, 1, 3), (2, 1, 3), (None, 1, 3), (3, 3, 0), (4, 4, 0), (6, 6, 0), (7, 7, 0)} <= joined
    assert ngram_join.ngram_join(none).count() == 0
    kept = ngram_join.keep_one_per_class(docs)
    assert kept.columns == docs.columns
    left = sorted(str(r["doc_id"]) for r in kept.collect())
    assert left.count("1") == 1 and "2" not in left and {"3", "4", "5", "6", "7", "8"} <= set(left)
    assert ngram_join.keep_one_per_class(none).count() == 0
    assert pii.fit_pii(none) == {}


def test_pages(spark):
    schema = "page_id long, url string, html string, text string, host string"
    data = [(1, "http://a.org/x", "<p>one</p>", "t", "h"), (1, "http://a.org/x", "<p>one</p>", "t", "h"),
            (2, None, None, "t", "h"), (None, "nonsense", "", "t", "h"), (3, "http://a.org/y", "<p><b>x<", "t", "h")]
    got = page_text.extract_pages(spark.createDataFrame(data, schema)).collect()
    assert len(got) == 5 and {r["page_id"]: r["n_chars"] for r in got}[2] == 0
    assert page_text.extract_pages(spark.createDataFrame([], schema)).count() == 0


def test_vectors(spark):
    schema = "vec_id long, embedding array<float>, v string, norm string"
    data = [(0, [1.0, 2.0], "a", "b"), (50, [1.0, 2.0], "a", "b"), (1, None, "a", "b"), (2, [1.0, None], "a", "b"),
            (3, [float("nan"), 1.0], "a", "b"), (4, [float("inf"), 1.0], "a", "b"), (None, [9.0, 9.0], "a", "b"),
            (5, [], "a", "b"), (6, [3.0], "a", "b"), (7, [1.0, 2.0], "a", "b"), (7, [1.0, 2.0], "a", "b")]
    df = spark.createDataFrame(data, schema)
    got = topk.top_inner_products(df, F.col("vec_id") % 50 == 0).collect()
    first = [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 0]
    s = 256 * 256 * 5
    assert first == [(7, s), (7, s), (50, s), (6, 256 * 256 * 3), (5, 0)]
    none = spark.createDataFrame([], schema)
    assert topk.top_inner_products(none, F.col("vec_id") % 50 == 0).count() == 0


def test_training_rows(spark, docs, none):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, None), (3, None, 1), (None, 1, 1), (9, 7, 0)],
                                   "doc_id long, quality int, toxic int")
    train = labelled.training_rows(docs, labels, "quality", 3, 99)
    assert sorted(r["label"] for r in train.collect()) == [0, 1, 1]  # row 1 is there twice
    model = quality_model.fit_quality(labelled.training_rows(none, labels, "quality", 3, 1))
    assert 0 < model.scores(_sample()[0][:1])[0] < 1
    stems, weights, intercept = toxicity.fit_toxicity(labelled.training_rows(none, labels, "toxic", 5, 0))
    assert stems == [] and not weights.any()


def test_stages(spark, docs, none):
    for start in (docs, none):
        table = start
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, table, "")
            if name != corpus_pipeline.STAGES[-1][0]:
                assert made.columns == docs.columns
                made.write.mode("overwrite").parquet(path := f"{_folder(spark)}/{name}-{start is none}")
                table = spark.read.parquet(path)
            else:
                assert made.count() == table.count()


def _folder(spark):
    from crashlens.session import ensure_checkpoint_dir
    return ensure_checkpoint_dir(spark) + "/stage-edges"
