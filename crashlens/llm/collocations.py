"""Phrase collocation mining: phrases whose words meet far more often than by chance.

Two passes over the texts. The first counts words and pairs as cells of 2^40
hashes only: a phrase is never more frequent than its cell, and a longer phrase
never more than its parts, so what lies in no frequent cell cannot be a
candidate. The second pass counts words, pairs and triples that are left, word
by word, in HAT-tries: shallow tries of word ids over burstable hash containers.
When a task's tries are full, their largest subtrees leave as sorted runs; Spark
brings the runs of a prefix together, tasks merge them, and counts are exact. A
run travels as one compressed row for each partition of prefixes.

The frequent cells reach the tasks as a Bloom filter of fixed size. It has no
false negatives, and whatever passes by chance fails the exact count.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crashlens.session import stage_table

#: Entries that burst a container, entries of a task's tries that make them spill,
#: and bits of a word's number (a task numbers no more words before it starts anew).
BURST = 4096
FULL = 600_000
WORD_BITS = 19
#: First words that have a container of their own; the others, which a task met
#: later and so mostly are rare, share one by ranges of 2^SHARED_BITS numbers.
OWN, SHARED_BITS = 4096, 10
#: Bits of a cell, cells that a task holds back to count them, and bits of the
#: Bloom filter (8 MB); more frequent cells than it tells apart only let more pass.
CELL_BITS = 40
CELLS_HELD = 1 << 21
FILTER_BITS = 1 << 26
#: Rows that a task hands over at once, and merged rows that it holds.
ROWS = 1 << 15
MERGED = 1 << 21
#: Partitions of prefixes for each partition of a shuffle.
FINER = 4
#: Characters of text that are worked on at once, and words of a language.
SLICE = 1 << 20
WORDS = 1 << 18
#: Parts that every prefix is cut into, so that a hot one is many tasks' work.
PREFIX_PARTS = 16
#: Parts of a language that are ranked on their own first.
RANK_PARTS = 64

END = b"\xff"  # in no UTF-8 text: the mark between pieces
_FOLD = bytes(0xFF if chr(b) in ".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))
_BREAK = re.compile(r"[.,;:!?\n-\r]")
_MASK = (1 << WORD_BITS) - 1


def words_of(text: str) -> Iterator[list[bytes]]:
    """Words of a text, A-Z lower-cased, as UTF-8, with END behind each piece, in
    lists of about SLICE characters that end with a piece."""
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > SLICE:
            found = _BREAK.search(text, at + SLICE)
            end = found.end() if found else end
        yield (text[at:end].encode().translate(_FOLD).replace(END, b" \xff ") + b" \xff").split()
        at = end


class HatTrie:
    """Counts of phrases, given as packed word ids, the first word in the highest bits.

    The root leads from the first word to a hash container of phrases. The
    container of one word that grows beyond BURST entries bursts into a node
    that leads from the second word to containers of their own.
    """

    def __init__(self):
        self.root: dict[int, dict] = {}
        self.burst: dict[int, dict[int, dict]] = {}
        self.sizes: dict[int, int] = {}
        self.entries = 0

    @staticmethod
    def slots(keys: np.ndarray) -> np.ndarray:
        """Where the root leads to; grows with the key."""
        first = keys >> (2 * WORD_BITS)
        return np.where(first < OWN, first, OWN + (first >> SHARED_BITS))

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add sorted distinct phrases."""
        if not len(keys):
            return
        slots = self.slots(keys)
        starts = np.concatenate([[0], np.flatnonzero(np.diff(slots)) + 1, [len(keys)]]).tolist()
        packed, n = keys.tolist(), counts.tolist()
        for slot, a, b in zip(slots[starts[:-1]].tolist(), starts, starts[1:], strict=False):
            had = self.sizes.get(slot, 0)
            if slot in self.burst:
                grown = self._into_node(self.burst[slot], packed[a:b], n[a:b])
            else:
                box = self.root.setdefault(slot, {})
                for key, count in zip(packed[a:b], n[a:b], strict=True):
                    box[key] = box.get(key, 0) + count
                grown = len(box) - had
                if len(box) > BURST and slot < OWN:
                    self.burst[slot] = {}
                    self._into_node(self.burst[slot], box.keys(), box.values())
                    del self.root[slot]
            self.sizes[slot] = had + grown
            self.entries += grown

    @staticmethod
    def _into_node(node: dict[int, dict], keys, counts) -> int:
        grown = 0
        for key, count in zip(keys, counts, strict=True):
            second = key >> WORD_BITS & _MASK
            box = node.get(second)
            if box is None:
                box = node[second] = {}
            if key in box:
                box[key] += count
            else:
                box[key] = count
                grown += 1
        return grown

    def spill(self, keep: int) -> tuple[np.ndarray, np.ndarray]:
        """Take whole subtrees out, the largest first, until ``keep`` entries are left."""
        boxes: list[dict] = []
        for slot in sorted(self.sizes, key=lambda s: (-self.sizes[s], s)):
            if self.entries <= keep:
                break
            boxes += self.burst.pop(slot).values() if slot in self.burst else [self.root.pop(slot)]
            self.entries -= self.sizes.pop(slot)
        size = sum(map(len, boxes))
        return (np.fromiter(chain.from_iterable(boxes), np.int64, size),
                np.fromiter(chain.from_iterable(b.values() for b in boxes), np.int64, size))


class _Ids(dict):
    """Numbers words as they come; 0 is the mark between pieces."""

    def __init__(self):
        super().__init__({END: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a pair from the hashes of its words."""
    with np.errstate(over="ignore"):
        h = (a ^ (a >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + b
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def _cells(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _places(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of the filter for each cell: by its low and by its high bits."""
    return cells & (FILTER_BITS - 1), (cells >> 13) & (FILTER_BITS - 1)


class _Lang:
    """What a task knows of one language: numbers, counts and hashes of its words."""

    def __init__(self, lang: str):
        self.ids, self.trie = _Ids(), HatTrie()
        self.seed = xxhash.xxh32_intdigest(lang.encode())
        self.hashes = np.zeros(1, np.uint64)
        self.counts = np.zeros(1, np.int64)

    def numbered(self, words: list[bytes]) -> np.ndarray:
        had = len(self.ids)
        ids = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
        if len(self.ids) > had:
            fresh = islice(self.ids, had, None)
            self.hashes = np.concatenate([self.hashes, np.fromiter(
                (xxhash.xxh64_intdigest(w, self.seed) for w in fresh), np.uint64, len(self.ids) - had)])
            self.counts = np.concatenate([self.counts, np.zeros(len(self.ids) - had, np.int64)])
        return ids

    def count(self, ids: np.ndarray) -> None:
        self.counts += np.bincount(ids, minlength=len(self.counts))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """(lang, words) of (lang, text) batches: whole pieces, a language's texts joined
    up to about WORDS words, or one piece if it alone is longer."""
    held: dict[str, list[bytes]] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                for words in words_of(text or ""):
                    mine = held.setdefault(lang, [])
                    mine += words
                    if len(mine) > WORDS:
                        yield lang, held.pop(lang)
            if sum(map(len, held.values())) > 4 * WORDS:  # many languages
                yield from held.items()
                held = {}
    yield from held.items()


def _numbered(batches: Iterator[pa.RecordBatch], states: dict[str, _Lang], leave) -> Iterator:
    """Word ids, slice by slice, as (lang, state, ids). Before the numbers run out
    ``leave()`` yields what the states hold, and all of them start anew."""
    step = 1 << (WORD_BITS - 1)
    for lang, words in _slices(batches):
        for at in range(0, len(words), step):
            some = words[at:at + step + 2]  # the last two only end phrases of this step
            if sum(len(s.ids) for s in states.values()) + len(some) > _MASK:
                yield from leave()
                states.clear()
            state = states.get(lang) or states.setdefault(lang, _Lang(lang))
            yield lang, state, state.numbered(some), min(step, len(some))


CELL_RUNS = "part int, n long, cells binary, counts binary"
CELLS = "cell long, n long"


def _packed(data) -> bytes:
    return pa.compress(data, codec="zstd", asbytes=True)


def _parts(spark: SparkSession) -> int:
    return FINER * int(spark.conf.get("spark.sql.shuffle.partitions"))


def _count_cells(parts: int):
    """Task function: runs of sorted cells of words and pairs, with their counts."""
    def made(cells, n):
        cells, where = np.unique(cells, return_inverse=True)
        n = np.bincount(where, n).astype("<u4")
        part = cells * parts >> CELL_BITS
        cuts = np.searchsorted(part, np.arange(parts + 1))
        rows = [(k, b - a, _packed(cells[a:b].astype("<i8").view("<u1").reshape(-1, 8)[:, :5].T.tobytes()),
                 _packed(n[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if a < b]
        for at in range(0, len(rows), 256):
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("part", "n", "cells", "counts"), r, strict=True)) for r in rows[at:at + 256]],
                pa.schema([("part", pa.int32()), ("n", pa.int64()), ("cells", pa.binary()), ("counts", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[str, _Lang] = {}
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def leave():
            for state in states.values():
                met = np.flatnonzero(state.counts[1:]) + 1
                held.append((_cells(state.hashes[met]), state.counts[met]))
            if held:
                yield from made(*map(np.concatenate, zip(*held, strict=True)))
            held.clear()

        for item in _numbered(batches, states, leave):
            if isinstance(item, pa.RecordBatch):
                yield item
                continue
            _, state, ids, step = item
            state.count(ids[:step])
            ids = ids[:step + 1]
            at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
            h = state.hashes[ids]
            held.append(np.unique(_cells(_mixed(h[at], h[at + 1])), return_counts=True))
            if sum(len(c) for c, _ in held) > CELLS_HELD:
                yield from made(*map(np.concatenate, zip(*held, strict=True)))
                held.clear()
        yield from leave()
    return run


def _merge_cells(least: int):
    """Task function: runs to the cells met ``least`` times. Where a task holds more
    distinct cells than it may, all it has leave as partial counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, n, whole = np.zeros(0, np.int64), np.zeros(0, np.int64), True
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged():
            found, where = np.unique(np.concatenate([cells, *(c for c, _ in held)]), return_inverse=True)
            counts = np.bincount(where, np.concatenate([n, *(k for _, k in held)])).astype(np.int64)
            held.clear()
            return found, counts

        def made(keep):
            yield from pa.Table.from_arrays([pa.array(cells[keep]), pa.array(n[keep])], ["cell", "n"]).to_batches(ROWS)

        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                wide = np.zeros((row["n"], 8), "<u1")
                wide[:, :5] = np.frombuffer(pa.decompress(row["cells"], 5 * row["n"], "zstd"), "<u1").reshape(5, -1).T
                held.append((wide.view("<i8").ravel(), np.frombuffer(
                    pa.decompress(row["counts"], 4 * row["n"], "zstd"), "<u4").astype(np.int64)))
                if sum(len(c) for c, _ in held) > MERGED:
                    cells, n = merged()
                    if len(cells) > 2 * MERGED:
                        yield from made(n > 0)
                        cells, n, whole = cells[:0], n[:0], False
        cells, n = merged()
        yield from made(n >= (least if whole else 1))
    return run


def _filter_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, bits) of the cells of each batch in a filter of 64-bit fields."""
    for batch in batches:
        at = np.concatenate(_places(batch.column(0).to_numpy()))
        place, where = np.unique(at >> 6, return_inverse=True)
        bits = np.zeros(len(place), np.uint64)
        np.bitwise_or.at(bits, where, np.uint64(1) << (at & 63).astype(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(bits.view(np.int64))], ["place", "bits"])


def frequent_cells(docs: DataFrame, least: int):
    """Broadcast filter of FILTER_BITS bits over the cells of words and pairs that are
    met ``least`` times in ``docs`` (lang, text). Its bits are set in tasks and
    combined by Spark; at most FILTER_BITS / 64 fields reach the driver."""
    spark = docs.sparkSession
    cells = docs.mapInArrow(_count_cells(_parts(spark)), CELL_RUNS).repartition("part") \
        .mapInArrow(_merge_cells(least), CELLS).groupBy("cell").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    fields = cells.select("cell").mapInArrow(_filter_bits, "place long, bits long") \
        .groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    made = np.zeros(FILTER_BITS // 64, np.int64)
    made[fields["place"].to_numpy()] = fields["bits"].to_numpy()
    return spark.sparkContext.broadcast(made.astype("<i8").tobytes())


RUNS = "part int, lang string, phrases binary, size long, counts binary"
COUNTS = "lang string, phrase string, n long"


def _run(lang: str, state: _Lang, keys: np.ndarray, counts: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """Phrases as runs, one for each part of the prefixes (all words but the last; a
    single word itself), every part in order: a line a phrase, and its counts."""
    if not len(keys):
        return
    ids = [(keys >> (s * WORD_BITS)) & _MASK for s in (2, 1, 0)]
    one, two, three = (state.hashes[i] for i in ids)
    prefix = np.where(ids[2] > 0, _mixed(one, two), one)
    last = np.where(ids[2] > 0, three, two) % np.uint64(PREFIX_PARTS)
    part = (_mixed(prefix, last) % np.uint64(parts)).astype(np.int64)
    used = np.unique(np.concatenate(ids))  # 0 stands for no word
    words = list(state.ids)
    names = [words[i] if i else b"" for i in used.tolist()]
    rank = np.zeros(len(names), np.int64)
    rank[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
    local = [np.searchsorted(used, i) for i in ids]
    order = np.lexsort([*(rank[i] for i in reversed(local)), part])
    array = pa.array(names, pa.large_binary())
    first, second, third = (array.take(pa.array(i[order])) for i in local)
    blank, line = (pa.scalar(x, pa.large_binary()) for x in (b" ", b"\n"))
    none = pa.scalar(b"", pa.large_binary())
    lines = pc.binary_join_element_wise(
        first, pc.if_else(pa.array(ids[1][order] > 0), blank, none), second,
        pc.if_else(pa.array(ids[2][order] > 0), blank, none), third, line, none)
    at, text = np.frombuffer(lines.buffers()[1], np.int64), lines.buffers()[2]
    counts, part = counts[order].astype("<i8"), part[order]
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    for k in range(0, len(cuts) - 1, 256):
        some = list(zip(cuts[k:k + 257], cuts[k + 1:k + 257], strict=False))
        yield pa.RecordBatch.from_arrays(
            [pa.array(part[[a for a, _ in some]], pa.int32()), pa.array([lang] * len(some), pa.string()),
             pa.array([_packed(text[int(at[a]):int(at[b])]) for a, b in some], pa.binary()),
             pa.array([int(at[b] - at[a]) for a, b in some], pa.int64()),
             pa.array([_packed(counts[a:b].tobytes()) for a, b in some], pa.binary())],
            ["part", "lang", "phrases", "size", "counts"])


def _merge_runs(least: int):
    """Task function: runs to the phrases met ``least`` times, and the line without
    a word, which counts all. Where a task holds more distinct phrases than it may,
    all it has leave as partial counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.Table]] = {}
        whole, waiting = True, 0

        def merge():
            for lang, tables in held.items():
                held[lang] = [pa.concat_tables(tables).group_by("phrase").aggregate([("n", "sum")])
                              .rename_columns({"n_sum": "n"})]

        def made(least):
            for lang, (table,) in held.items():
                table = table.filter(pc.or_(pc.greater_equal(table["n"], least), pc.equal(table["phrase"], b"")))
                table = table.add_column(0, "lang", pa.repeat(pa.scalar(lang), len(table)))
                yield from table.set_column(1, "phrase", table["phrase"].cast(pa.string())).to_batches(ROWS)

        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                lines = pa.decompress(row["phrases"], row["size"], "zstd", asbytes=True).split(b"\n")[:-1]
                n = np.frombuffer(pa.decompress(row["counts"], 8 * len(lines), "zstd"), "<i8")
                held.setdefault(row["lang"], []).append(
                    pa.table({"phrase": pa.array(lines, pa.binary()), "n": pa.array(n)}))
                waiting += len(lines)
                if waiting > MERGED // 2:
                    merge()
                    waiting = 0
                    if sum(len(t) for (t,) in held.values()) > MERGED:
                        yield from made(1)
                        held, whole = {}, False
        merge()
        yield from made(least if whole else 1)
    return run


def _count_phrases(frequent, parts: int):
    """Task function: (lang, text) batches to sorted runs of partial counts. The
    phrase without a word counts all words of its language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[str, _Lang] = {}
        bits = np.frombuffer(frequent.value, np.uint8)

        def has(h):
            found = np.ones(len(h), bool)
            for at in _places(_cells(h)):
                found &= (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            return found

        def leave(keep=0):
            for lang, state in states.items():
                if not keep:
                    met = np.flatnonzero(has(state.hashes) & (state.counts > 0))
                    yield from _run(lang, state, met[met > 0] << (2 * WORD_BITS), state.counts[met[met > 0]], parts)
                    yield from _run(lang, state, np.zeros(1, np.int64), state.counts[1:].sum(keepdims=True), parts)
                yield from _run(lang, state, *state.trie.spill(keep * state.trie.entries // 4), parts)

        for item in _numbered(batches, states, leave):
            if isinstance(item, pa.RecordBatch):
                yield item
                continue
            _, state, ids, step = item
            state.count(ids[:step])
            both = (ids[:-1] > 0) & (ids[1:] > 0)
            at = np.flatnonzero(both)
            h = state.hashes[ids]
            both[at] = has(_mixed(h[at], h[at + 1]))
            at = np.flatnonzero(both[:step])
            pairs = (ids[at] << (2 * WORD_BITS)) | (ids[at + 1] << WORD_BITS)
            at = np.flatnonzero((both[:-1] & both[1:])[:step])
            triples = (ids[at] << (2 * WORD_BITS)) | (ids[at + 1] << WORD_BITS) | ids[at + 2]
            state.trie.add(*np.unique(np.concatenate([pairs, triples]), return_counts=True))
            if sum(s.trie.entries for s in states.values()) > FULL:
                yield from leave(keep=1)
        yield from leave()
    return run


def count_phrases(docs: DataFrame, least: int = 10) -> DataFrame:
    """lang, phrase, n of every word, pair and triple that ``docs`` (lang, text) hold
    ``least`` times, and of all words of a language with an empty phrase.

    Runs are merged per prefix; every prefix is cut into PREFIX_PARTS parts by its
    last words, so that a prefix that heads a third of all phrases is many tasks.
    A last aggregate adds up what a task had to let go in parts.
    """
    frequent = frequent_cells(docs, least)
    runs = docs.mapInArrow(_count_phrases(frequent, _parts(docs.sparkSession)), RUNS)
    counts = runs.repartition("part").mapInArrow(_merge_runs(least), COUNTS) \
        .groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | (F.col("phrase") == ""))
    counts = stage_table(counts, "phrases")
    frequent.unpersist()
    return counts


def mine_collocations(docs: DataFrame, least: int = 10, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first ``top`` phrases.

    ``docs`` has ``text`` and ``lang``; other columns, whatever their names, are
    not looked at. A null or empty text has no word; a null language is ``und``.
    Repeated rows count as often as they occur. Equal scores go by count, then
    phrase. Long texts are worked on in slices; an empty table, or one where no
    phrase occurs ``least`` times, gives no row. Counts up to 10^14 stay exact.
    """
    counts = count_phrases(docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                                       F.col("text").alias("text")), least)
    totals = counts.where("phrase = ''").select("lang", "n")
    words = F.split("phrase", " ", -1)
    counts = counts.where("phrase <> ''").select(
        "lang", "phrase", "n", F.size(words).alias("size"), F.element_at(words, -1).alias("last"),
        F.concat_ws(" ", F.slice(words, 1, F.size(words) - 1)).alias("prefix"))
    known = counts.where("size < 3").select("lang", "phrase", "n")
    two, three = counts.where("size = 2"), counts.where("size = 3")

    def cut(k: int, first, rest):
        return F.struct(F.lit(k).alias("k"), first.alias("first"), rest.alias("rest"))
    head, tail = F.substring_index("prefix", " ", 1), F.substring_index("prefix", " ", -1)
    end = F.concat_ws(" ", tail, "last")
    pair = two.select("lang", "phrase", F.col("n").alias("a"),
                      F.array(cut(1, F.col("prefix"), F.col("last"))).alias("cuts"))
    triple = three.select("lang", "phrase", F.col("n").alias("a"),
                          F.array(cut(1, head, end), cut(2, F.col("prefix"), F.col("last"))).alias("cuts"))
    # a pair is dropped for a triple that holds it at least half as often
    inside = three.select("lang", F.col("n").alias("longer"), F.explode(F.array(
        F.col("prefix"), end)).alias("phrase")) \
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    pair = pair.join(inside, ["lang", "phrase"], "left") \
        .where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * 50)).drop("longer")

    cuts = pair.unionByName(triple).select("lang", "phrase", "a", F.explode("cuts").alias("c")) \
        .select("lang", "phrase", "a", "c.*")
    sides = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"]) \
        .join(known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    wide = {c: F.col(c).cast("decimal(14,0)") for c in ("a", "l", "r")}
    sides = sides.withColumn("_above", wide["a"] * wide["a"] * F.lit(1_000_000).cast("decimal(7,0)")) \
        .withColumn("_below", wide["l"] * wide["r"]).withColumn("score", F.expr("_above div _below"))
    best = sides.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b")) \
        .select("lang", "phrase", "a", "b.score", "b.l", "b.r")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = best.withColumn("part", part).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")) \
        .where(F.col("rank") <= top).join(totals, "lang") \
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
