"""A corpus pipeline: from documents to token ids, in five stages.

Each stage takes the documents that its predecessor kept, written as Parquet
and read again, and returns their columns; the last one returns token ids.

All stages: texts are read whole, however long; a null text counts as empty and
stays null; repeated rows are rows of their own (the near-copy stage keeps one of
them); an empty table gives an empty one; further columns are kept as they are,
whatever their names, up to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlens.llm import byte_bpe, mixing, ngram_join, pii, quality_rules
from crashlens.llm.common import table
from crashlens.session import ensure_checkpoint_dir, stage_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers."""
    ensure_checkpoint_dir(spark)
    return quality_rules.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal or similar texts."""
    ensure_checkpoint_dir(spark)
    return ngram_join.keep_one_per_class(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked; n_chars follows the new text."""
    ensure_checkpoint_dir(spark)
    masked = pii.redacted(docs, pii.fit_pii(docs))
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out towards their sources' target weights."""
    ensure_checkpoint_dir(spark)
    return mixing.mix_sources(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number and ids of tokens, digests of the ids and of the decoded bytes."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return docs.select("doc_id", byte_bpe.bpe_digests(F.col("text"), path, with_ids=True).alias("_r")) \
        .select("doc_id", "_r.*")


STAGES = [("quality_rules", quality), ("ngram_jaccard_join", near_copies), ("pii", personal_data),
          ("mix_sources", mixture), ("byte_bpe", token_ids)]

#: SQL cannot express the robust estimates, the bootstrapping or the encoding;
#: tests/llm holds what can be against brute force, operator by operator.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    ensure_checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
