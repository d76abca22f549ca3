"""SMOTE oversampling on the training rows (G2), on a distributed kNN.

k nearest neighbours within each class (Euclidean, self excluded, ties by
id):

1. Cells: per class a sample of rows (first in hash order) is cut in halves along its
   widest dimension until a part stands for few rows of the class: a k-d tree.
2. Every row is assigned to its leaf of the tree (its cell), a batch at a time.
3. Cells are cut into hash blocks of at most ``block`` rows (or ``BLOCK_BYTES`` of
   vectors, if that is more). Round one is a block-nested-loop join inside each
   cell: queries and targets meet per (cell, target block, query block) in a
   cogrouped ``applyInPandas`` that keeps only each query's k best: a matrix
   product leaves few pairs, whose distances are then computed exactly.
4. Round two: a row only needs another cell if the box around that cell's rows is
   no farther than its current k-th distance; it is sent to those cells alone, and
   the candidates merge. Query blocks are counted from the rows that visit a cell,
   so a small cell that a whole class visits is many tasks.

With ``probe=None`` the result is exact: every row outside the visited cells
is provably farther than the k found. Boxes exclude the more, the fewer dimensions
hold the spread of the rows; where all do alike, work tends to n^2; ``probe=c``
visits at most the c nearest cells of each row, which bounds the work by
n * c * cell (neighbours may then be missed beyond the c-th cell). Exact is the
default everywhere.

Synthetic rows: class c needs ``m = n_max - n_c`` rows. Every row of c
yields ``m div n_c`` samples, and exactly ``m mod n_c`` rows (first in hash
order, chosen without ranking the class in one task) one more. Sample ``j``
of row ``x`` picks neighbour ``hash(x, j) mod k`` and gap ``u`` in [0, 1)
from a second hash (32 bits of md5, which any SQL engine has):
``x + u (nn - x)``, deterministic for a seed. Tables of vectors are joined by
merging: compressed files would pass some for small enough to broadcast, and the
driver would hold them unpacked.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlens.operators.split import first_per_class, hash32, split_hash
from crashlens.session import stage_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Vectors of this size make a block, if ``block`` rows are less: every row is sent
#: once for each block of the other side it meets.
BLOCK_BYTES = 4 << 20
#: Cells that a block's worth of rows is cut into if a class has more rows than a block,
#: cells of a class at most (their boxes are sent to the tasks), and sampled rows a cell.
CELLS_A_BLOCK, MOST_CELLS, SAMPLED = 6, 8192, 16

CAND = T.StructType([T.StructField("qid", T.LongType()), T.StructField("cid", T.LongType()),
                     T.StructField("dist", T.DoubleType())])


def _local_topk(k: int):
    def fn(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(t):
            Q, X = (np.stack(p).astype(np.float64) for p in (q["vec"].to_numpy(), t["tvec"].to_numpy()))
            qid, tid = q["id"].to_numpy(), t["tid"].to_numpy()
            sx = (X * X).sum(1)
            step = max(1, min(256, (1 << 21) // len(X)))
            for s in range(0, len(Q), step):  # bounded memory per chunk
                i, j = _may_be_near(Q[s:s + step], qid[s:s + step], X, sx, tid, k)
                d = np.concatenate([_distances(Q, X, s + i[c:c + 100_000], j[c:c + 100_000])
                                    for c in range(0, len(i), 100_000)] or [np.zeros(0)])
                i, j, d = (x[np.isfinite(d)] for x in (i, j, d))
                order = np.lexsort((tid[j], d, i))
                i, j, d = i[order], j[order], d[order]
                best = np.arange(len(i)) - np.searchsorted(i, i) < k
                out.append(pd.DataFrame({"qid": qid[s + i[best]], "cid": tid[j[best]], "dist": d[best]}))
        return pd.concat(out) if out else pd.DataFrame({"qid": [], "cid": [], "dist": []})
    return fn


def _distances(Q: np.ndarray, X: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    diff = Q[i] - X[j]
    return np.sqrt(np.einsum("ij,ij->i", diff, diff))


def _may_be_near(Q: np.ndarray, qid: np.ndarray, X: np.ndarray, sx: np.ndarray, tid: np.ndarray, k: int):
    """Pairs (query, target) that may be among the query's k nearest: squared distances
    by one matrix product, kept up to the k-th smallest plus their error."""
    sq = (Q * Q).sum(1)
    d2 = sq[:, None] + sx[None, :] - 2 * Q @ X.T
    d2[qid[:, None] == tid[None, :]] = np.inf  # self is not a neighbour
    limit = np.full(len(Q), np.inf)
    if len(X) > k:
        error = (4 * Q.shape[1] + 64) * np.finfo(float).eps * (sq + sx.max())
        limit = np.partition(d2, k - 1, axis=1)[:, k - 1] + 2 * error
    may = ~(d2 > limit[:, None])  # what is not a number is left to the exact distance
    may &= qid[:, None] != tid[None, :]
    return np.nonzero(may)


class _Tree:
    """Cells of a class: a k-d tree over sampled rows, each leaf a cell of ``leaf`` of them at most."""

    def __init__(self, sample: np.ndarray, leaf: int):
        self.dim, self.cut, self.low, self.high, self.cells = [], [], [], [], 0
        self.root = self._grown(sample, leaf)

    def _grown(self, rows: np.ndarray, leaf: int) -> int:
        """Number of the node over ``rows``; a cell c is node -1 - c."""
        cut = None
        if len(rows) > leaf:
            d = int(np.argmax(rows.max(0) - rows.min(0)))
            x = np.sort(rows[:, d])
            below = x[x < x[len(x) // 2]]  # of equal values, none is cut off from the others
            cut = below[-1] if len(below) else x[0]
        if cut is None or not cut < x[-1]:
            self.cells += 1
            return -self.cells
        at = len(self.dim)
        self.dim.append(d)
        self.cut.append(cut)
        self.low.append(0)
        self.high.append(0)
        under = rows[:, d] <= cut
        self.low[at], self.high[at] = self._grown(rows[under], leaf), self._grown(rows[~under], leaf)
        return at

    def cell(self, V: np.ndarray) -> np.ndarray:
        node = np.full(len(V), self.root)
        dim, cut, low, high = (np.array(x) for x in (self.dim, self.cut, self.low, self.high))
        while len(at := np.flatnonzero(node >= 0)):
            n = node[at]
            node[at] = np.where(V[at, dim[n]] <= cut[n], low[n], high[n])
        return -1 - node


def _classes(pdf: pd.DataFrame, size: int):
    """(label, row numbers, vectors) of a batch, in pieces of ``size`` rows."""
    for label, rows in pdf.groupby("label").indices.items():
        for s in range(0, len(rows), size):
            part = rows[s:s + size]
            yield label, part, np.stack(pdf["vec"].to_numpy()[part]).astype(np.float64)


def _assign(trees: dict):
    def fn(it):
        for pdf in it:
            cell = np.zeros(len(pdf), np.int32)
            for label, rows, V in _classes(pdf, 8192):
                cell[rows] = trees[label].cell(V)
            yield pdf.assign(cell=cell)
    return fn


def _near_boxes(V: np.ndarray, reach: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Pairs (row, box) with the squared distance between them, where it may be within the
    row's reach. Dimensions that boxes differ most in come first and leave few pairs;
    a box or a distance that is no number is near."""
    with np.errstate(invalid="ignore", over="ignore"):
        limit = (reach * (1 + 1e-9)) ** 2
        first = np.argsort(-np.nan_to_num(low.std(0), posinf=0.0, neginf=0.0), kind="stable")[:4]
        total = np.zeros((len(V), len(low)))
        for d in first:
            x = V[:, d, None]
            total += np.maximum(np.maximum(low[None, :, d] - x, x - high[None, :, d]), 0.0) ** 2
        i, j = np.nonzero(~(total > limit[:, None]))
        far = np.concatenate([(np.maximum(np.maximum(low[b] - V[a], V[a] - high[b]), 0.0) ** 2).sum(1) for a, b in (
            (i[s:s + 100_000], j[s:s + 100_000]) for s in range(0, len(i), 100_000))] or [np.zeros(0)])
        near = ~(far > limit[i])
    return i[near], j[near], far[near]


def _visits(boxes: dict, probe: int | None):
    """Rows with every other cell that may hold a nearer row than their k-th."""
    def fn(it):
        for pdf in it:
            own, reach = pdf["cell"].to_numpy(), pdf["rk"].to_numpy()
            at, to = [], []
            for label, rows, V in _classes(pdf, 512):
                rows, V = (x[np.isfinite(V).all(1)] for x in (rows, V))  # others are near to nothing
                cells, low, high = boxes[label]
                i, j, far = _near_boxes(V, reach[rows], low, high)
                if probe is not None:
                    order = np.lexsort((j, far, i))
                    i, j = i[order], j[order]
                    best = np.arange(len(i)) - np.searchsorted(i, i) < probe
                    i, j = i[best], j[best]
                other = cells[j] != own[rows[i]]
                at.append(rows[i[other]])
                to.append(cells[j[other]])
            pick = np.concatenate(at) if at else np.zeros(0, np.int64)
            out = pdf[["id", "label", "vec"]].iloc[pick].copy()
            out["cell"] = np.concatenate(to).astype(np.int32) if to else np.zeros(0, np.int32)
            yield out
    return fn


def _merge(cands: DataFrame, k: int) -> DataFrame:
    best = F.slice(F.array_sort(F.collect_list(F.struct("dist", "cid"))), 1, k)
    return cands.groupBy("qid").agg(best.alias("nn"))


def knn_within_class(df: DataFrame, k: int = 5, block: int = 1024, seed: int = 42,
                     probe: int | None = None) -> DataFrame:
    """``df``: (id long, label string, vec array<double>). Returns (id, label,
    nn_ids, nn_dists): the k nearest other rows of the same label, nearest
    first, ties by id; exact unless ``probe`` limits the cells of a row."""
    base = df.select(F.col("id").cast("long"), F.col("label").cast("string"),
                     F.col("vec").cast("array<double>"))
    sizes = {r["label"]: r["n"] for r in base.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    wide = base.select(F.max(F.size("vec"))).first()[0] or 1
    block = max(block, BLOCK_BYTES // (8 * max(wide, 1)))
    trees = {}
    hashed = base.withColumn("_h", split_hash("id", seed))
    for c, n in sizes.items():  # per class SAMPLED rows a cell reach the driver, of MOST_CELLS at most
        cells = min(math.ceil(CELLS_A_BLOCK * n / block), MOST_CELLS) if n > block else 1
        rows = hashed.where(F.col("label") == c).orderBy("_h", "id").limit(SAMPLED * cells).collect() if cells > 1 else []
        sample = np.array([r["vec"] for r in rows], dtype=np.float64).reshape(len(rows), wide)
        trees[c] = _Tree(sample[np.isfinite(sample).all(1)], SAMPLED)
    schema = T.StructType(base.schema.fields + [T.StructField("cell", T.IntegerType())])
    assigned = stage_table(base.mapInPandas(_assign(trees), schema), "knn-assigned")

    def blocks(rows: DataFrame, name: str) -> DataFrame:
        # one row per (class, cell): bounded by the trees
        return rows.groupBy(F.col("label").alias("label"), F.col("cell").alias("cell")).agg(
            F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias(name))

    def laid(rows: DataFrame, own: str, other: str, salt: int, id_: str = "id", vec: str = "vec") -> DataFrame:
        """Rows in their block of the cell, once for each block of the other side."""
        return rows.select(F.col("label").alias("label"), F.col("cell").alias("cell"),
                           F.pmod(F.xxhash64("id", F.lit(salt)), F.col(own)).cast("int").alias(own[:2]),
                           F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other[:2]),
                           F.col("id").alias(id_), F.col("vec").alias(vec))

    on, keys, topk = ["label", "cell"], ["label", "cell", "tb", "qb"], _local_topk(k)
    held = assigned.join(F.broadcast(blocks(assigned, "tbs")), on)
    own = held.withColumn("qbs", F.col("tbs"))
    r1 = laid(own, "qbs", "tbs", 17).groupBy(*keys).cogroup(
        laid(own, "tbs", "qbs", 0, "tid", "tvec").groupBy(*keys)).applyInPandas(topk, CAND)
    m1 = stage_table(_merge(r1, k), "knn-round1")

    # round two: cells whose boxes are within reach
    ends = [f(F.get("vec", i)).alias(f"{n}{i}") for i in range(wide) for n, f in (("l", F.min), ("h", F.max))]
    boxes = {c: ([], [], []) for c in sizes}
    for r in assigned.groupBy("label", "cell").agg(*ends).collect():  # a row a cell
        for found, value in zip(boxes[r["label"]], (r["cell"], *[[r[f"{n}{i}"] for i in range(wide)] for n in "lh"])):
            found.append(value)
    boxes = {c: (np.array(cells, np.int64), np.array(low, float), np.array(high, float))
             for c, (cells, low, high) in boxes.items()}
    rk = F.when(F.size("nn") >= k, F.element_at("nn", k)["dist"]).otherwise(F.lit(float("inf")))
    reach = assigned.join(m1.select(F.col("qid").alias("_qid"), rk.alias("rk")).hint("merge"),
                          F.col("id") == F.col("_qid"), "left") \
        .select("id", "label", "vec", "cell", F.coalesce("rk", F.lit(float("inf"))).alias("rk"))
    need = stage_table(reach.mapInPandas(_visits(boxes, probe), schema), "knn-visits")
    visitors = blocks(need, "qbs")
    q2 = laid(need.join(F.broadcast(visitors), on).join(F.broadcast(blocks(assigned, "tbs")), on), "qbs", "tbs", 17)
    t2 = laid(held.join(F.broadcast(visitors), on), "tbs", "qbs", 0, "tid", "tvec")
    r2 = q2.groupBy(*keys).cogroup(t2.groupBy(*keys)).applyInPandas(topk, CAND)
    first = m1.select("qid", F.explode("nn").alias("c")).select("qid", "c.cid", "c.dist")
    final = _merge(first.unionByName(r2), k)
    out = base.select("id", "label").join(final.withColumnRenamed("qid", "id").hint("merge"), "id", "left")
    return out.select("id", "label",
                      F.transform(F.coalesce("nn", F.array()), lambda s: s["cid"]).alias("nn_ids"),
                      F.transform(F.coalesce("nn", F.array()), lambda s: s["dist"]).alias("nn_dists"))


def smote(df: DataFrame, k: int = 5, seed: int = 42, probe: int | None = None, **knn) -> DataFrame:
    """Oversample every class up to the largest one (train rows only).

    Neighbours are exact; ``probe`` limits them to each row's cell and its
    ``probe`` nearest cells.

    ``df``: (id, label, vec). Returns the input rows plus synthetic rows with
    ``source_id`` / ``sample_no`` and ``is_synthetic``. An empty table stays empty.
    """
    base = df.select(F.col("id").cast("long"), F.col("label").cast("string"),
                     F.col("vec").cast("array<double>"))
    sizes = {r["label"]: r["n"] for r in base.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_max = max(sizes.values(), default=0)
    need = {c: n_max - n for c, n in sizes.items() if n < n_max and n >= 2}
    orig = base.select("id", "label", "vec", F.lit(None).cast("long").alias("source_id"),
                       F.lit(None).cast("int").alias("sample_no"), F.lit(False).alias("is_synthetic"))
    if not need:
        return orig
    minority = base.where(F.col("label").isin(*need))
    nn = knn_within_class(minority, k=k, seed=seed, probe=probe, **knn)

    def by_class(vals: dict):
        e = None
        for c, v in vals.items():
            e = F.when(F.col("label") == c, F.lit(v)) if e is None else e.when(F.col("label") == c, F.lit(v))
        return e.otherwise(F.lit(0))
    each = {c: m // sizes[c] for c, m in need.items()}
    extra = {c: m % sizes[c] for c, m in need.items()}
    flagged = first_per_class(minority, "label", "id", by_class(extra), seed + 1, "extra")
    per = (flagged.join(nn.select("id", "nn_ids").hint("merge"), "id")
           .withColumn("q", by_class(each) + F.col("extra").cast("int"))
           .where((F.col("q") > 0) & (F.size("nn_ids") > 0)))
    samples = per.select("id", "label", "vec", "nn_ids",
                         F.explode(F.sequence(F.lit(0), F.col("q") - 1)).alias("sample_no"))
    def drawn(salt: int):
        return hash32(F.concat_ws(":", F.col("id").cast("string"), F.col("sample_no").cast("string"),
                                  F.lit(str(salt))))
    pick = F.pmod(drawn(seed), F.size("nn_ids")).cast("int")
    gap = drawn(seed + 7) / F.lit(float(1 << 32))
    samples = samples.select("id", "label", "vec", "sample_no",
                             F.get("nn_ids", pick).alias("nn_id"), gap.alias("u"))
    nbr = base.select(F.col("id").alias("nn_id"), F.col("vec").alias("nn_vec"))
    synth = (samples.join(nbr.hint("merge"), "nn_id")
             .select(F.lit(None).cast("long").alias("id"), "label",
                     F.zip_with("vec", "nn_vec", lambda a, b: a + F.col("u") * (b - a)).alias("vec"),
                     F.col("id").alias("source_id"), "sample_no", F.lit(True).alias("is_synthetic")))
    return orig.unionByName(synth)
