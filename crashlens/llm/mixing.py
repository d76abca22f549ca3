"""Mixing sources to target weights: repetition rates and seeded copies.

Words are aggregated per source; a source's rate is its target over its size;
each document goes out floor(rate) times plus once more with probability equal
to the fraction, decided by a hash of its id and the seed. DataFrame work only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crashlens.llm.common import join_small, spaced, split_words
from crashlens.session import stage_table

WEIGHTS = (3, 1, 2)
#: Words of the mix for 100 words of input, and the most copies of a source.
TOTAL_PERCENT = 150
MOST_COPIES = 2
SEED = "mix-1"
DRAWS = 1 << 48


def text_size(text: Column) -> Column:
    """Number of words (runs without space, tab, \\n, \\v, \\f, \\r); null has none."""
    return F.size(split_words(spaced(F.coalesce(text, F.lit(""))))).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, percent: int = TOTAL_PERCENT,
                   most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, target, rate from rows with source and size.

    Sources in code-point order, null last, take the weights in turn. Raising
    one level L until the targets min(most * size, L * weight) add up to the
    wanted total gives the same targets as sharing the excess again and again:
    sources are filled in the order of most * size / weight. The windows run
    over one row per source. A source without words has target and rate 0.
    """
    per = stage_table(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (turn % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * most
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), "turn")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    filled = per.withColumn("turn", turn).withColumn("w", w).withColumn("cap", cap) \
        .withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0))) \
        .withColumn("rest", F.sum("w").over(after)) \
        .withColumn("total", F.sum("source_size").over(whole)) \
        .withColumn("level", (percent * F.col("total") - 100 * F.col("full")) / (100.0 * F.col("rest"))) \
        .withColumn("open", F.col("level") * F.col("w") <= F.col("cap"))
    # the first source in filling order that the level does not fill sets it
    filled = filled.withColumn("place", F.row_number().over(by_cap)) \
        .withColumn("water", F.min(F.when(F.col("open"), F.struct("place", "level")))
                    .over(whole)["level"])
    target = F.when(F.col("water").isNull(), F.col("cap").cast("double")).otherwise(
        F.least(F.col("cap").cast("double"), F.col("water") * F.col("w")))
    return filled.select("source", "source_size", target.alias("target")).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
        .otherwise(F.lit(0.0)))


def draw(key: Column, seed: str = SEED) -> Column:
    """A fixed number in [0, 2^48) for a document key; equal keys draw alike."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def mix_plan(sized: DataFrame, key: str = "doc_id", seed: str = SEED) -> DataFrame:
    """Add source_size, target and copies (how often the mix takes the row) to
    rows with ``key``, source and size. Rows with a null key share one draw;
    repeated rows are copied alike. An empty table stays empty."""
    targets = stage_table(source_targets(sized.select("source", "size")), "mix-targets") \
        .withColumnRenamed("source", "_source")
    joined = join_small(sized, targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    whole = F.floor("rate").cast("long")
    more = draw(F.col(key), seed) < (F.col("rate") - whole) * float(DRAWS)
    return joined.withColumn("copies", whole + more.cast("long")).drop("rate")


def mix_sources(docs: DataFrame, key: str = "doc_id", seed: str = SEED) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as its plan says, with its
    own columns only. Names that the plan uses may occur among them."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    sized = docs.select(F.col(key).alias("doc_id"), F.col("source"),
                        text_size(F.col("text")).alias("size"), row.alias("_row"))
    plan = mix_plan(sized, "doc_id", seed).where("copies > 0")
    return plan.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_row.*")
