"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crashlens.session import stage_table


def connected_components(edges: DataFrame) -> DataFrame:
    """id and label (the smallest id of its component) of every node that has
    an edge (columns a, b). Self edges only name a node.

    Labels spread to neighbours and then jump to the label of their label, so
    the rounds grow with the logarithm of a component's width. Each round's
    labels are written to the shared folder; the driver sees one count a round.
    """
    both = stage_table(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "graph-edges")
    labels = stage_table(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label"))
                         .withColumnRenamed("a", "id"), "graph-labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("label").alias("near"))
        spread = stage_table(labels.join(near, F.col("id") == F.col("a")).select(
            "id", F.col("label").alias("before"), F.least("label", "near").alias("label")), "graph-spread")
        jump = spread.select(F.col("id").alias("at"), F.col("label").alias("next"))
        moved = stage_table(spread.join(jump, F.col("label") == F.col("at"))
                            .select("id", "before", F.col("next").alias("label")), "graph-labels")
        labels = moved.select("id", "label")
        if moved.where("label <> before").limit(1).count() == 0:
            return labels
