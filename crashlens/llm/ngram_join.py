"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of five-word shingles; the join links texts whose sets have a
Jaccard similarity of at least 0.8. Equal texts are joined by their digest and
go on as one. MinHash bands bring texts together that may be similar; within
such a group pairs compare their MinHash values a few at a time and are
dropped as soon as the posterior probability of reaching the threshold falls
below a tolerance. The pairs that survive are verified exactly.

Words are the op1 words: runs of letters, digits and non-ASCII characters,
A-Z lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crashlens.llm.common import join_small, per_texts, word_chunks
from crashlens.llm.components import connected_components
from crashlens.session import stage_table

WORDS = 5
THRESHOLD = 0.8
#: A pair at the threshold shares a band with probability 1 - (1 - 0.8^7)^48,
#: all but 1 in 80,000; a pair at 0.3 with 1 %, at 0.2 with 0.06 %.
BANDS, ROWS = 48, 7
HASHES = BANDS * ROWS
#: MinHash values compared at a time, and the posterior tolerance.
STEP = 16
TOLERANCE = 1e-7
#: Members of a group of similar texts that meet in one task; larger groups
#: are cut into blocks and every pair of blocks is a task.
BLOCK = 512
#: Shingles whose MinHash values are computed at once, columns of a product.
STRETCH = 1 << 15
COLUMNS = 4096

_RNG = np.random.default_rng(20240607)
MULTIPLIERS = _RNG.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles of a text; a
    text of one to four words is one shingle, a text without words has none."""
    parts = [np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
             for words in word_chunks(text)]
    h = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    if not len(h):
        return h
    width = min(WORDS, len(h))
    n = len(h) - width + 1
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = _mix(out * _MIX[0] + h[k:k + n])
    return np.unique(out)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (uint32) of non-empty shingle sets, one row each."""
    out = np.empty((len(sets), HASHES), np.uint32)
    first = 0
    while first < len(sets):
        last, held = first, 0
        while last < len(sets) and (held == 0 or held + len(sets[last]) <= STRETCH):
            held += len(sets[last])
            last += 1
        joined = np.concatenate(sets[first:last])
        starts = np.cumsum([0, *map(len, sets[first:last - 1])])
        for k in range(HASHES):
            mixed = joined * MULTIPLIERS[k] + OFFSETS[k]
            out[first:last, k] = np.minimum.reduceat((mixed >> np.uint64(32)).astype(np.uint32), starts)
        first = last
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key a band (int64), different from band to band."""
    rows = signature.reshape(-1, BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2]).copy()
    for k in range(ROWS):
        key = _mix(key * _MIX[0] + rows[:, :, k])
    return key.view(np.int64)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> np.ndarray:
    """For n compared values the least number of equal ones for which the
    posterior P(similarity >= threshold) is at least ``tolerance``.

    Under a uniform prior m equal values of n give a Beta(m + 1, n - m + 1)
    posterior, whose upper tail is the binomial sum over 0..m of n + 1 trials.
    """
    out = np.zeros(HASHES + 1, np.int64)
    for n in range(1, HASHES + 1):
        tail = 0.0
        for m in range(n + 1):
            tail += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                out[n] = m
                break
    return out


def similar_pairs(sets: list[np.ndarray], signature: np.ndarray, left: np.ndarray, right: np.ndarray,
                  needed: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places (a, b) of linked pairs with a in ``left`` and b in ``right``;
    with ``same`` the sides are equal and each pair comes once."""
    size = np.array([len(s) for s in sets], np.int64)
    found_a, found_b = [], []
    for at in range(0, len(left), 128):
        a = left[at:at + 128]
        low = np.minimum(size[a][:, None], size[right][None, :])
        may = low >= THRESHOLD * np.maximum(size[a][:, None], size[right][None, :])
        if same:
            may &= right[None, :] > a[:, None]
        i, j = np.nonzero(may)
        x, y = a[i], right[j]
        equal = np.zeros(len(x), np.int64)
        for n in range(0, HASHES, STEP):
            if not len(x):
                break
            equal += (signature[x, n:n + STEP] == signature[y, n:n + STEP]).sum(1)
            keep = equal >= needed[min(n + STEP, HASHES)]
            x, y, equal = x[keep], y[keep], equal[keep]
        found_a.append(x)
        found_b.append(y)
    x, y = np.concatenate(found_a or [left[:0]]), np.concatenate(found_b or [left[:0]])
    if not len(x):
        return x, y
    both = _common(sets, x, y)
    linked = both >= THRESHOLD * (size[x] + size[y] - both) - 1e-9
    return x[linked], y[linked]


def _common(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact sizes of the intersections of pairs of sets."""
    if len(x) <= 64:
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                         for a, b in zip(x, y, strict=True)], np.int64)
    rows, cols = np.unique(x), np.unique(y)
    used = np.union1d(rows, cols)
    joined = np.concatenate([sets[u] for u in used])
    who = np.repeat(np.arange(len(used)), [len(sets[u]) for u in used])
    _, word, times = np.unique(joined, return_inverse=True, return_counts=True)
    shared = times[word] > 1  # shingles of a single text meet no other
    _, word = np.unique(word[shared], return_inverse=True)
    who = who[shared]
    order = np.argsort(word, kind="stable")
    word, who = word[order], who[order]
    at_row, at_col = np.searchsorted(used, rows), np.searchsorted(used, cols)
    total = np.zeros((len(rows), len(cols)))
    last = int(word[-1]) + 1 if len(word) else 0
    for first in range(0, last, COLUMNS):
        a, b = np.searchsorted(word, [first, first + COLUMNS])
        table = np.zeros((len(used), COLUMNS), np.float32)
        table[who[a:b], word[a:b] - first] = 1
        total += table[at_row] @ table[at_col].T
    return np.rint(total[np.searchsorted(rows, x), np.searchsorted(cols, y)]).astype(np.int64)


def _digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def _band_column(text: Column) -> Column:
    def make():
        def work(texts: list[str]):
            sets = [shingles(t) for t in texts]
            full = [s for s in sets if len(s)]
            keys = iter(band_keys(signatures(full)) if full else ())
            return ((next(keys) if len(s) else None,) for s in sets)
        return work
    return per_texts(make, "bands array<bigint>")(text)["bands"]


def _feature_column(text: Column) -> Column:
    def make():
        def work(texts: list[str]):
            sets = [shingles(t) for t in texts]
            marks = signatures(sets) if sets else ()
            return ((s.tobytes(), m.tobytes()) for s, m in zip(sets, marks, strict=True))
        return work
    return per_texts(make, "shingles binary, signature binary")(text)


def _verify(batch: pa.Table, needed: np.ndarray) -> pa.Table:
    """Links within the groups of one task: per text the number of linked rows
    and the smallest id it is connected to here."""
    ids, group = batch["id"].to_numpy(), batch["group"].to_numpy()
    copies, block = batch["copies"].to_numpy(), batch["block"].to_numpy()
    sets = [np.frombuffer(b.as_buffer(), np.uint64) for b in batch["shingles"]]
    marks = np.stack([np.frombuffer(b.as_buffer(), np.uint32) for b in batch["signature"]])
    links = np.zeros(len(ids), np.int64)
    root = ids.copy()
    i, j = batch["i"][0].as_py(), batch["j"][0].as_py()
    order = np.argsort(group, kind="stable")
    for members in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
        if i == j:
            x, y = similar_pairs(sets, marks, members, np.sort(members), needed, True)
        else:
            x, y = similar_pairs(sets, marks, members[block[members] == i], members[block[members] == j],
                                 needed, False)
        np.add.at(links, x, copies[y])
        np.add.at(links, y, copies[x])
        while len(x):
            low = np.minimum(root[x], root[y])
            if (root[x] == low).all() and (root[y] == low).all():
                break
            np.minimum.at(root, x, low)
            np.minimum.at(root, y, low)
    hit = links > 0
    return pa.table({"id": ids[hit], "links": links[hit], "root": root[hit]})


def similarity_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, texts): one row a document with doc_id, digest; one row a distinct
    text with digest, id, copies, first (doc_id and repeats of its first row),
    class (id of its class), links (linked documents with another text).

    Both are written tables. Texts without words (null and empty ones too) are
    in neither class nor link, and only in ``rows``, with worded = false.
    """
    rows = stage_table(docs.select("doc_id", _digest(F.col("text")).alias("digest"),
                                   _band_column(F.col("text")).alias("bands"))
                       .withColumn("worded", F.col("bands").isNotNull()), "join-rows")
    texts = rows.where("worded").groupBy("digest", "doc_id") \
        .agg(F.count(F.lit(1)).alias("n"), F.first("bands").alias("bands")) \
        .groupBy("digest").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "n")).alias("first"),
            F.sum("n").alias("copies"), F.first("bands").alias("bands"))
    texts = stage_table(texts.withColumn("id", F.monotonically_increasing_id()), "join-texts")

    # a band that several texts share: each is tied to the smallest of them
    keys = texts.select("id", F.explode("bands").alias("key"))
    meet = keys.groupBy("key").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1")
    tied = keys.join(meet.select("key", "low"), "key").where("id <> low") \
        .groupBy("id").agg(F.collect_set("low").alias("lows"))  # at most BANDS of them
    # a text and all its ties go to the smallest tie; similar texts have the
    # same ties, so few distinct edges are left of a large group
    tied = stage_table(tied.withColumn("least", F.array_min("lows")), "join-ties")
    edges = tied.select(F.explode("lows").alias("a"), F.col("least").alias("b")).where("a <> b").distinct() \
        .union(tied.select(F.col("id").alias("a"), F.col("least").alias("b")))
    groups = connected_components(edges)
    sizes = groups.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    members = stage_table(
        groups.join(sizes, "label").join(texts.select("id", "digest", "copies", "first"), "id")
        .select("id", F.col("label").alias("group"), "copies", "digest", F.col("first.doc_id").alias("first_id"),
                F.ceil(F.col("size") / float(BLOCK)).cast("int").alias("blocks")), "join-members")

    # whole texts of the members only, one row each
    found = join_small(docs.select(F.col("doc_id").alias("_doc"), "text", _digest(F.col("text")).alias("digest")),
                       members, "digest").where(F.col("_doc").eqNullSafe(F.col("first_id")))
    single = found.groupBy("id", "group", "copies", "blocks").agg(F.first("text").alias("text"))
    features = stage_table(single.select("id", "group", "copies", "blocks",
                                         _feature_column(F.col("text")).alias("_f"))
                           .select("id", "group", "copies", "blocks", "_f.*"), "join-features")
    bins = -(-members.count() // BLOCK) or 1
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    laid = features.withColumn("block", block).select("*", other) \
        .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")) \
        .withColumn("task", F.when(F.col("blocks") > 1, F.col("group"))
                    .otherwise(-1 - F.pmod(F.xxhash64("group"), F.lit(bins)))).drop("other")
    needed = least_matches()

    def verify(table: pa.Table) -> pa.Table:
        return _verify(table, needed)

    linked = stage_table(laid.groupBy("task", "i", "j").applyInArrow(
        verify, "id long, links long, root long"), "join-links")
    classes = connected_components(linked.select(F.col("id").alias("a"), F.col("root").alias("b")))
    links = linked.groupBy("id").agg(F.sum("links").alias("links"))
    joined = texts.drop("bands").join(classes, "id", "left").join(links, "id", "left") \
        .withColumn("class", F.coalesce("label", "id")).drop("label") \
        .withColumn("links", F.coalesce("links", F.lit(0).cast("long")))
    return rows.drop("bands"), stage_table(joined, "join-classes")


def _class_names(texts: DataFrame) -> DataFrame:
    """Per class its first text: the one with the smallest document id."""
    return texts.groupBy("class").agg(F.min(F.struct(
        F.col("first.none"), F.col("first.doc_id"), "digest")).alias("head"))


def ngram_join(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, n_links of every row of ``docs`` (doc_id, text).

    class_id is the smallest doc_id of the documents that links connect;
    n_links counts the other rows with an equal text or a similarity of at
    least 0.8. Texts without words have no link and their own id as class;
    null ids come last in a class. Repeated rows count as copies.
    """
    rows, texts = similarity_classes(docs)
    named = texts.join(_class_names(texts), "class").select(
        "digest", "copies", "links", F.col("head.doc_id").alias("class_id"))
    worded = rows.where("worded").join(named, "digest").select(
        "doc_id", "class_id", (F.col("copies") - 1 + F.col("links")).alias("n_links"))
    return worded.unionByName(rows.where("not worded").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links")))


def keep_one_per_class(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that repeat another: of each class the row with
    the smallest doc_id stays (one of its repeats, if that row is repeated).
    Texts without words all stay. All columns of ``docs`` are kept.
    """
    rows, texts = similarity_classes(docs.select("doc_id", "text"))
    heads = stage_table(texts.join(_class_names(texts), "class").select(
        "digest", (F.col("digest") == F.col("head.digest")).alias("heads"),
        F.col("first.doc_id").alias("first_id"), F.col("first.n").alias("repeats")), "join-heads")
    gone = stage_table(
        rows.where("worded").join(heads, "digest")
        .where(~F.col("heads") | ~F.col("doc_id").eqNullSafe(F.col("first_id")))
        .select(F.col("digest").alias("_digest"), F.col("doc_id").alias("_doc")).distinct(), "join-gone")
    again = stage_table(heads.where("heads and repeats > 1").select(F.col("digest").alias("_digest")),
                        "join-repeats")
    keyed = docs.withColumn("_key", _digest(F.col("text")))
    same = F.col("_key") == F.col("_digest")
    kept = join_small(keyed, gone, same & F.col("doc_id").eqNullSafe(F.col("_doc")), "left_anti")
    if again.limit(1).count():
        once = join_small(kept, again, same, "left_semi").dropDuplicates(["_key"])
        kept = join_small(kept, again, same, "left_anti").unionByName(once)
    return kept.drop("_key")
