"""Exact top-k inner products over norm-sorted, rotated vectors.

Candidates are laid out by descending length. A rotation from the singular
vectors of all candidates moves most of the length into the first coordinates,
so a partial product over those plus the product of the residual lengths
(Cauchy-Schwarz) bounds a score. Candidates whose bound is below a query's
fifth best score so far are skipped; the others are scored exactly.

Queries and candidates meet in blocks; each block pair returns at most k rows
a query, so no pair list is ever written.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crashlens.llm.common import join_small
from crashlens.session import stage_table

#: Rows of a block of queries and of a block of candidates.
QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 8192
#: Candidates and queries that one matrix product takes.
STRIP = 512
#: Share of the dimensions in the partial product.
HEAD = 0.25
#: Relative slack of bounds computed in floating point.
SLACK = 1e-6
EXACT = float(1 << 53)
#: The smallest score that 64 bits hold.
LEAST = -(1 << 63)


def integer_vector(embedding: Column) -> Column:
    """floor(256 x) of each component as double; null for a vector that is null
    or holds a null, NaN or infinite component, or one whose 256-fold no double holds.
    A double from 2^52 on has no fraction and is its own floor."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x)
                    & (F.abs(x.cast("double") * 256.0) < F.lit(float("inf"))))

    def whole(x: Column) -> Column:
        y = x.cast("double") * 256.0
        return F.when(F.abs(y) < float(1 << 52), F.floor(y).cast("double")).otherwise(y)
    return F.when(embedding.isNotNull() & fine, F.transform(embedding, whole))


def _length(m: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        return np.sqrt(np.einsum("ij,ij->i", m, m))


def _matrix(column) -> np.ndarray:
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = np.asarray(rows.flatten().to_numpy(zero_copy_only=False), float)
    return flat.reshape(len(rows), -1) if len(rows) else np.zeros((0, 0))


def rotation(vectors: DataFrame, d: int) -> np.ndarray:
    """Right singular vectors of all rows, from d x d sums that each task makes."""
    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for b in batches:
            x = _matrix(b.column("v"))
            if x.size:
                x = x / max(1.0, np.abs(x).max())
                total += x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(d), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "row"])

    cells = vectors.select("v").mapInArrow(gram, "i int, row array<double>") \
        .select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x"))
    total = np.zeros((d, d))
    for r in cells.collect():  # d x d numbers, whatever the number of rows
        total[r["i"], r["j"]] = r["x"]
    return np.linalg.eigh(total)[1][:, ::-1] if d else np.zeros((0, 0))


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of integer vectors. Where the product of two lengths is below
    2^53 every partial sum is exact in double; the other pairs are summed as Python
    integers, and a score outside 64 bits becomes the nearest 64-bit integer."""
    with np.errstate(over="ignore", invalid="ignore"):
        large = ~(np.outer(_length(q), _length(x)) * (1 + SLACK) < EXACT)
        s = np.where(large, 0, q @ x.T).astype(np.int64)
    rows, cols = np.nonzero(large)
    left = {i: [int(v) for v in q[i]] for i in set(rows.tolist())}
    right = {j: [int(v) for v in x[j]] for j in set(cols.tolist())}
    for i, j in zip(rows.tolist(), cols.tolist(), strict=True):
        score = sum(map(mul, left[i], right[j]))
        s[i, j] = min(max(score, LEAST), -LEAST - 1)
    return s


def search_block(qid, q, xid, x, turn, k, floor=None):
    """k best candidates of each query: (query place, vec_id, score) arrays.

    ``floor`` holds a score per query that the caller already found k times.
    """
    order = np.lexsort((xid, -np.einsum("ij,ij->i", x, x)))
    xid, x = xid[order], x[order]
    head = max(1, int(np.ceil(HEAD * q.shape[1]))) if q.shape[1] else 0
    xr, qr = x @ turn, q @ turn
    x_len, x_rest, q_rest, q_len = _length(x), _length(xr[:, head:]), _length(qr[:, head:]), _length(q)
    least = np.full(len(q), -np.inf) if floor is None else floor.astype(float)
    best_id = np.zeros((len(q), 0), np.int64)
    best = np.zeros((len(q), 0), np.int64)
    real = np.zeros((len(q), 0), bool)
    for a in range(0, len(x), STRIP):
        part = slice(a, a + STRIP)
        slack = SLACK * (1 + q_len * x_len[a])
        # bounds that are no number, of lengths beyond double, exclude nothing
        open_q = np.flatnonzero(~(q_len * x_len[a] + slack < least))
        if not len(open_q):
            break  # all that follow are shorter still
        upper = qr[open_q, :head] @ xr[part, :head].T + np.outer(q_rest[open_q], x_rest[part])
        may = ~(np.maximum(upper, LEAST) + slack[open_q, None] < least[open_q, None])
        own = qid[open_q][:, None] == xid[part][None, :]
        may &= ~own
        rows = may.any(1)
        if not rows.any():
            continue
        open_q, may = open_q[rows], may[rows]
        cols = np.flatnonzero(may.any(0))
        s = exact_scores(q[open_q], x[part][cols])
        ok = may[:, cols]
        ids = np.concatenate([best_id[open_q], np.broadcast_to(xid[part][cols], s.shape)], 1)
        s = np.concatenate([best[open_q], s], 1)
        ok = np.concatenate([real[open_q], ok], 1)
        rank = np.lexsort((ids, ~s, ~ok), axis=1)[:, :k]  # ~s falls as s grows, within 64 bits
        width = max(best.shape[1], rank.shape[1])
        if best.shape[1] < width:
            grow = ((0, 0), (0, width - best.shape[1]))
            best_id, best, real = np.pad(best_id, grow), np.pad(best, grow), np.pad(real, grow)
        take = lambda m: np.take_along_axis(m, rank, 1)
        w = rank.shape[1]
        best_id[open_q, :w], best[open_q, :w], real[open_q, :w] = take(ids), take(s), take(ok)
        if width >= k:
            full = open_q[real[open_q].all(1)]
            least[full] = np.maximum(least[full], best[full, k - 1])
    who, at = np.nonzero(real)
    return who, best_id[who, at], best[who, at]


def top_inner_products(vectors: DataFrame, is_query: Column, k: int = 5, ident: str = "vec_id",
                       embedding: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best rows of all.

    Ties go to the smaller id. Rows with the query's own id are no candidates;
    repeated candidate rows each count, and of query rows with one id the
    smallest vector is the query. Rows without an id take no part, nor do
    vectors that :func:`integer_vector` rejects; shorter vectors are filled up
    with zeros. Fewer rows than k give all of them; empty tables give none. Scores
    are exact within 64 bits; one beyond them counts as the nearest 64-bit integer,
    so such scores may tie.
    """
    held = vectors.select(F.col(ident).cast("long").alias("vec_id"),
                          integer_vector(F.col(embedding)).alias("v"), is_query.alias("q")) \
        .where("vec_id is not null and v is not null")
    held = stage_table(held, "topk-vectors")
    d = held.agg(F.max(F.size("v"))).first()[0] or 0
    fill = F.concat(F.col("v"), F.array_repeat(F.lit(0.0), F.lit(d) - F.size("v")))
    held = held.withColumn("v", fill).withColumn(
        "norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))
    turn = rotation(held, d)
    queries = held.where("q").groupBy("vec_id").agg(F.min("v").alias("v")) \
        .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))
    n_rows, n_queries = held.count(), queries.count()
    blocks, query_blocks = -(-n_rows // CANDIDATE_BLOCK) or 1, -(-n_queries // QUERY_BLOCK) or 1

    # candidates in blocks by descending length: cut points from a sketch;
    # rows of one length are spread over the blocks of a cut by their id
    cuts = held.agg(F.percentile_approx("norm", [i / blocks for i in range(1, blocks)] or [0.5], 10000)
                    ).first()[0] or []
    edges = sorted(set(cuts), reverse=True) if blocks > 1 else []
    place = F.lit(0)
    if edges:
        place = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e > F.col("norm")))
    spread = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) if blocks > 1 else F.lit(0)
    per_cut = held.withColumn("cut", place).groupBy("cut").count()
    sizes = per_cut.withColumn("parts", F.ceil(F.col("count") / float(CANDIDATE_BLOCK)))
    laid = join_small(held.drop("q").withColumn("cut", place), sizes.select("cut", "parts"), "cut") \
        .withColumn("cb", F.struct("cut", F.pmod(spread, F.col("parts")).alias("part"))) \
        .select("vec_id", "v", "norm", F.to_json("cb").alias("cb"))
    laid = stage_table(laid, "topk-candidates")
    asked = stage_table(queries.withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int")),
                        "topk-queries")

    # a first score to beat: the k-th best among the longest candidates
    longest = laid.orderBy(F.desc("norm"), "vec_id").limit(STRIP).select("vec_id", "v").toArrow()
    top_id, top = longest["vec_id"].to_numpy(), _matrix(longest["v"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            qid, q = b.column("vec_id").to_numpy(), _matrix(b.column("v"))
            least = np.full(len(qid), -np.inf)
            for a in range(0, len(qid), STRIP):
                part = slice(a, a + STRIP)
                s = exact_scores(q[part], top).astype(float)
                s[qid[part][:, None] == top_id[None, :]] = -np.inf
                if s.shape[1] >= k:
                    least[part] = np.sort(s, 1)[:, -k]
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("v"), b.column("norm"), b.column("qb"), pa.array(least)],
                ["query_id", "q", "q_norm", "qb", "least"])

    asked = stage_table(asked.select("vec_id", "v", "norm", "qb").mapInArrow(
        first, "query_id long, q array<double>, q_norm double, qb int, least double"), "topk-first")
    # a query block needs only candidates that are long enough for one of its queries
    slack = 1e-6
    needs = asked.groupBy("qb").agg(F.min(
        F.when(F.col("q_norm") > 0, F.col("least") / F.col("q_norm"))
        .otherwise(F.when(F.col("least") > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))))
        .alias("short"))
    sent = join_small(laid.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))),
                      needs, "qb").where(F.col("norm") * (1 + slack) + slack >= F.col("short"))
    pairs = sent.select(F.col("qb").alias("pair_q"), F.col("cb").alias("pair_c")).distinct()
    copies = asked.join(pairs, F.col("qb") == F.col("pair_q")) \
        .select("query_id", "q", "least", "pair_q", "pair_c")

    def block(key, left: pa.Table, right: pa.Table) -> pa.Table:
        who, ids, score = search_block(
            left["query_id"].to_numpy(), _matrix(left["q"]), right["vec_id"].to_numpy(),
            _matrix(right["v"]), turn, k, left["least"].to_numpy())
        return pa.table({"query_id": left["query_id"].to_numpy()[who], "vec_id": ids, "score": score})

    found = copies.groupBy("pair_q", "pair_c").cogroup(sent.groupBy("qb", "cb")).applyInArrow(
        block, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
