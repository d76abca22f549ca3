"""Merkle manifest of a dataset: one digest over all documents, and for each of
them the proof that it belongs to it.

Leaves stand in order per source; each source is a tree of its own and their
roots are the leaves of one more. A level is built by a slot pivot: conditional
aggregates spread the children of a parent into FANOUT columns, whose digests
joined are the parent's input; the same columns without a child's own are its
siblings. Proofs go down level by level, so a leaf is moved once and not once a
level.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crashlens.llm.common import in_order
from crashlens.session import stage_table

FANOUT = 3
#: The columns of a document that its leaf is made of.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts joined; null parts are left out."""
    return F.sha2(F.concat(*[F.coalesce(p, F.lit("")) for p in parts]), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    """Digest of a document's fields, some of them replaced."""
    return digest(*[field(changed.get(c, F.col(c))) for c in FIELDS])


def _slots(column: str) -> list[str]:
    return [f"{column}{k}" for k in range(FANOUT)]


def slot_pivot(nodes: DataFrame, columns: list[str]) -> DataFrame:
    """Parents of ``nodes`` (tree, place, size, digest, ...): tree, place, size,
    digest and, for each of ``columns``, one column a child. ``size`` counts the
    tree's nodes on the level."""
    slot = F.pmod(F.col("place"), F.lit(FANOUT))
    spread = [F.max(F.when(slot == k, F.col(c))).alias(f"{c}{k}") for c in columns for k in range(FANOUT)]
    return nodes.groupBy("tree", F.expr(f"place div {FANOUT}").alias("place"),
                         F.expr(f"(size + {FANOUT - 1}) div {FANOUT}").alias("size")).agg(*spread) \
        .withColumn("digest", digest(*[F.col(c) for c in _slots("digest")]))


def build_levels(leaves: DataFrame, carried: list[str], name: str) -> list[DataFrame]:
    """Written pivots of every level from the leaves' parents up to the roots.

    The number of levels grows with the logarithm of the largest tree. Columns
    ``carried`` go along with the leaves into the first pivot.
    """
    largest = leaves.agg(F.max("size")).first()[0] or 0
    levels, nodes = [], leaves
    while largest > 1:
        columns = ["digest"] if levels else ["digest", *carried]
        nodes = stage_table(slot_pivot(nodes.where(F.col("size") > 1), columns), f"{name}-{len(levels)}")
        levels.append(nodes)
        largest = -(-largest // FANOUT)
    return levels


def _children(parents: DataFrame, carried: list[str], known: list[str]) -> DataFrame:
    """One row a child of parents that know their own ``proof``: the child's place,
    digest, carried columns, and proof with the step to its parent put first."""
    slots = _slots("digest")

    def child(k: int) -> Column:
        joined = [F.concat(F.lit(""), *[F.coalesce(F.col(c), F.lit("")) for c in side])
                  for side in (slots[:k], slots[k + 1:])]
        step = F.struct(joined[0].alias("left"), joined[1].alias("right"))
        return F.when(F.col(slots[k]).isNotNull(), F.struct(
            (F.col("place") * FANOUT + k).alias("place"), F.col(slots[k]).alias("digest"),
            F.concat(F.array(step), F.col("proof")).alias("proof"),
            *[F.col(f"{c}{k}").alias(c) for c in carried]))
    return parents.select("tree", *known, F.explode(F.array(*[child(k) for k in range(FANOUT)])).alias("c")) \
        .where("c is not null").select("tree", *known, "c.*")


def proofs(leaves: DataFrame, levels: list[DataFrame], roots: DataFrame, carried: list[str],
           known: list[str], name: str) -> DataFrame:
    """tree, place, digest, proof, ``carried`` and ``known`` of every leaf.

    ``roots`` has a row a tree: its proof within whatever the trees belong to,
    and columns ``known`` that all its leaves get.
    """
    tops = roots.select("tree", F.lit(0).cast("long").alias("place"), "proof", *known)
    above = None
    for k in range(len(levels) - 1, -1, -1):
        level = levels[k]
        ended = level.where(F.col("size") == 1).join(tops, ["tree", "place"])
        below = _children(ended, carried if k == 0 else [], known)
        if above is not None:
            wide = level.where(F.col("size") > 1).join(above.drop("digest"), ["tree", "place"])
            below = below.unionByName(_children(wide, carried if k == 0 else [], known))
        above = below if k == 0 else stage_table(below, f"{name}-proof-{k}")
    alone = leaves.where(F.col("size") == 1).join(tops, ["tree", "place"]) \
        .select("tree", *known, "place", "digest", "proof", *carried)
    return alone if above is None else above.unionByName(alone)


def roots_of(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """tree and digest of every root: the only node of its tree's last level."""
    tops = [rows.where(F.col("size") == 1).select("tree", "digest") for rows in (leaves, *levels)]
    return reduce(DataFrame.unionByName, tops)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(proof, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


NO_STEPS = "cast(array() as array<struct<left: string, right: string>>)"


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of each document.

    ``tampered`` gives the text of a document as it is found later (null: it is
    untouched); ``folded_root`` follows from that text and the original
    siblings. Nulls of any column have a digest of their own. Rows of one source
    are in order of doc_id, nulls first; rows of one id in order of their leaf,
    and equal rows are as many leaves, any of which may stand first. Texts may
    have any length. Other columns are not looked at. An empty table has no root
    and gives no row.
    """
    found = tampered if tampered is not None else F.lit(None).cast("string")
    now = F.struct(found.alias("t"))
    tree = F.coalesce(F.concat(F.lit("v"), F.col("source")), F.lit("n"))  # null first, then bytewise
    leaves = stage_table(docs.select(*FIELDS, now.alias("_now")).select(
        tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf_digest().alias("digest"),
        F.when(F.col("_now.t").isNotNull(), leaf_digest(text=F.col("_now.t"))).alias("found"),
        F.monotonically_increasing_id().alias("row")), "merkle-leaves")
    leaves = in_order(leaves, ["tree", "doc_id", "digest", "row"], "merkle-order", "tree").drop("row")
    # a null id has no column of its own in a pivot of maxima, a null change neither
    carried = ["doc_id", "found"]
    levels = build_levels(leaves, carried, "merkle")
    subroots = stage_table(roots_of(leaves, levels), "merkle-subroots")
    tops = in_order(subroots.withColumnRenamed("tree", "source").withColumn("tree", F.lit("all")),
                    ["tree", "source"], "merkle-sources", "tree")
    upper = build_levels(tops, ["source"], "merkle-top")
    root = stage_table(roots_of(tops, upper), "merkle-root")
    start = root.select("tree", F.col("digest").alias("root"), F.expr(NO_STEPS).alias("proof"))
    sources = stage_table(proofs(tops, upper, start, ["source"], ["root"], "merkle-top"), "merkle-top-proofs")
    begun = sources.select(F.col("source").alias("tree"), "proof", F.col("digest").alias("subroot"), "root")
    rows = proofs(leaves, levels, begun, carried, ["subroot", "root"], "merkle")
    joined = F.concat_ws("", F.transform("proof", lambda s: F.concat(s["left"], s["right"])))
    return rows.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root",
                       F.sha2(joined, 256).alias("proof_sha256"),
                       fold(F.coalesce("found", "digest"), F.col("proof")).alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))
