"""Token ids as compact binary files: canonical Huffman codes in independent blocks.

A folder holds two tables. ``codes`` has the code length of every id that
occurs; canonical codes follow from the lengths alone. ``blocks`` has the ids of
all documents in order of ``doc_id``, cut into blocks of BLOCK ids that can be
decoded without any other: the packed codes, the bit offset of every STEP-th id,
and the pieces of documents the block is made of. Blocks are ordered by their
shard, a range of doc_id, and their first id's position in it.

Decoding looks codes up in one table and works on all stretches between two
checkpoints of a block at once.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crashlens.llm.common import byte_slices, join_small
from crashlens.session import staged_path

#: Longest code in bits, at least; more ids than fit get longer codes.
LONGEST = 16
#: Ids of a block, and from one checkpoint to the next.
BLOCK = 1 << 16
STEP = 256
#: Words whose ids a process remembers, and words that shortcuts are tried on.
REMEMBERED = 1 << 19
PROBES = ("zebra", "tokenization", "qxjvzk", "s", "\xf1and\xfa", "gr\xf6\xdfe", "x.", "a@b-c.de", "(+41)", "\"so\"?!", "2026,")
#: Words of simple characters: a-z, small letters of Latin-1, digits, signs without the
#: apostrophe. Such a word is made of runs of letters, digits and runs of signs.
SIMPLE = re.compile(rb"[!-&(-@\[-~]*+(?:\xc3[\x9f-\xb6\xb8-\xbf][!-&(-@\[-~]*+)*+")
#: Kinds of bytes: ASCII white space, letters and all beyond ASCII, digits, the rest.
SPACE, LETTER, DIGIT, SIGN = range(4)
BYTE_KINDS = np.array([SPACE if chr(b) in " \t\n\r\x0b\f" else DIGIT if 0x30 <= b <= 0x39
                       else LETTER if b >= 0x80 or chr(b).isalpha() else SIGN for b in range(256)], np.uint8)
#: Bytes of simple words and white space, and those that a simple word has behind LATIN only;
#: capitals there are 0x20 lower.
LATIN = 0xC3
PLAIN_BYTES = np.array([BYTE_KINDS[b] == SPACE or bool(SIMPLE.fullmatch(bytes([b]))) for b in range(256)])
LATIN_SMALL = np.array([bool(SIMPLE.fullmatch(bytes([LATIN, b]))) for b in range(256)])
LATIN_CAPITAL = np.array([0x80 <= b <= 0x9E and b != 0x97 for b in range(256)])
#: Bytes of texts whose words are looked up at once.
TEXTS = 1 << 22
#: Mark of a word's last token in the vocabulary, and runs that go to the library together.
WORD_END = "</w>"
TOGETHER = 1 << 12

CODES = "id int, length int"
PIECE = "struct<doc_no: long, doc_id: long, n: long>"
BLOCKS = ("shard int, first long, n long, checkpoints array<int>, payload binary, "
          f"pieces array<{PIECE}>")


# ------------------------------------------------------------------ tokens

class WordTokenizer:
    """Ids of texts by a tokenizer none of whose matches spans white space, as is
    that of a vocabulary with word ends: the ids of a text are those of its words
    one after the other. Every word goes through the library once and is then
    remembered.

    Two shortcuts make words fewer or cheaper; each is used only if the library
    gives the same ids for PROBES: capitals of ASCII and, in simple words, Latin-1
    made small before, and words of simple characters split into runs of letters,
    digits and runs of signs. Each of these is learned once, many in one call of the
    library: their ids are told apart by the vocabulary's word ends, and one by one
    should the ends not be as many.

    Words and runs are found, numbered and replaced by their ids for many texts at
    once; only those that differ are Python objects.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task is one thread
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their names in a text are ordinary text
        # runs need no normalizing and no expression to split them, those of ASCII no mapping of bytes
        self.of_units, self.of_ascii = Tokenizer(self.library.model), Tokenizer(self.library.model)
        self.of_units.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.of_ascii.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.library.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self._forget()
        self.folds = all(self._whole(w) == self._whole(w.upper()) for w in PROBES[:5])
        self.plain = True
        self.plain = all(self._whole(w) == ids.tolist() for w, ids in zip(PROBES, self.ids(list(PROBES)), strict=True))
        self._forget()

    def _forget(self) -> None:
        """The words and runs learned; the ids of each are ``size`` ones of ``store`` from ``begin``."""
        self.words = pa.array([], pa.large_binary())
        self.store, self.begin, self.size = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def known(self) -> list[bytes]:
        return self.words.to_pylist()

    def _whole(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _runs(self, runs: list[bytes], by) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of runs in order, and how many are those of each."""
        parts = [runs[at:at + TOGETHER] for at in range(0, len(runs), TOGETHER)]
        found = by.encode_batch_fast([b" ".join(p).decode() for p in parts], add_special_tokens=False)
        for part, encoded in zip(parts, found, strict=True):
            ids = np.array(encoded.ids, "<u4")
            last = np.flatnonzero(self.ends[ids]) + 1
            if len(last) == len(part) and last[-1] == len(ids):
                yield ids, np.diff(last, prepend=0)
            else:
                yield from ((np.array(i, "<u4"), np.array([len(i)])) for i in (self._whole(u.decode()) for u in part))

    def _learn(self, fresh: pa.Array) -> np.ndarray:
        """Learn words and runs; returns their numbers."""
        names = fresh.to_pylist()
        group = np.array([0 if not self.plain or not SIMPLE.fullmatch(w) else 1 + w.isascii() for w in names])
        order = np.argsort(group, kind="stable")
        rest, runs, ascii_runs = ([names[i] for i in np.flatnonzero(group == k)] for k in range(3))
        words = self.library.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False)
        found = [*((np.array(e.ids, "<u4"), np.array([len(e.ids)])) for e in words),
                 *self._runs(runs, self.of_units), *self._runs(ascii_runs, self.of_ascii)]
        size = np.concatenate([s for _, s in found])
        numbers = np.empty(len(names), np.int64)
        numbers[order] = np.arange(len(self.words), len(self.words) + len(names))
        self.words = pa.concat_arrays([self.words, fresh.take(pa.array(order))])
        self.begin = np.concatenate([self.begin, len(self.store) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.store = np.concatenate([self.store, *(i for i, _ in found)])
        return numbers

    def _numbers(self, names: pa.Array) -> np.ndarray:
        """The numbers of different words and runs, which are learned if need be."""
        at = pc.index_in(names, self.words)
        if len(self.words) + at.null_count > REMEMBERED:
            self._forget()
            at = pc.index_in(names, self.words)
        numbers = at.fill_null(-1).to_numpy().astype(np.int64)
        if at.null_count:
            numbers[numbers < 0] = self._learn(names.filter(at.is_null()))
        return numbers

    def _split(self, data: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Where words and the runs of simple words begin, in bytes of a ``kind`` each; capitals
        of Latin-1 in simple words are made small in ``data``."""
        solid = kind != SPACE
        words = solid.copy()
        words[1:] &= ~solid[:-1]
        if not self.plain:
            return words
        begin = solid.copy()
        begin[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        odd = ~PLAIN_BYTES[data]
        latin = np.flatnonzero(data[:-1] == LATIN)
        second = data[latin + 1]
        capital = latin[LATIN_CAPITAL[second]] + 1 if self.folds else latin[:0]
        for at in (latin[LATIN_SMALL[second]], capital - 1):
            odd[at] = odd[at + 1] = False
        data[capital] += 0x20
        at = np.flatnonzero(odd)
        if len(at):  # words of other characters stay whole
            first = np.flatnonzero(words)
            last = np.flatnonzero(solid[:-1] & ~solid[1:]) + 1  # texts end with white space
            whole = np.unique(np.searchsorted(first, at, "right") - 1)
            turn = np.zeros(len(data) + 1, np.int8)
            turn[first[whole] + 1] += 1
            turn[last[whole]] -= 1
            inside = np.cumsum(turn[:-1], dtype=np.int8).astype(bool)
            begin &= ~inside
            data[capital[inside[capital]]] -= 0x20
        return begin

    def ids(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        data = [t.encode() for t in texts]
        ends = np.cumsum([len(d) + 1 for d in data])
        data = b" ".join([*data, b""])
        data = np.frombuffer(bytearray(data.lower() if self.folds else data), np.uint8)
        kind = BYTE_KINDS[data]
        begin, solid = self._split(data, kind), kind != SPACE
        places = np.flatnonzero(begin[solid])
        # the bytes between two places are a word or run
        units = pa.Array.from_buffers(pa.large_binary(), len(places), [
            None, pa.py_buffer(np.append(places, np.count_nonzero(solid))), pa.py_buffer(data[solid])]).dictionary_encode()
        number, which = self._numbers(units.dictionary), units.indices.to_numpy()
        size = self.size[number][which]
        end = np.cumsum(size)
        ids = self.store[np.repeat(self.begin[number][which] - (end - size), size) + np.arange(size.sum())]
        cuts = np.append(0, end)[np.append(0, np.searchsorted(np.flatnonzero(begin), ends))]
        return (ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True))


@lru_cache(1)
def _tokenizer(path: str, changed: int) -> WordTokenizer:
    """The tokenizer of a file, which the tasks of a process share with all that it has learned."""
    return WordTokenizer(path)


# ------------------------------------------------------------------ codes

def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``longest`` bits for symbols that
    occur ``counts`` (positive) times, by package-merge; more symbols than that
    many bits tell apart get as many more bits as they need."""
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    longest = max(longest, (n - 1).bit_length())
    order = np.argsort(counts, kind="stable")
    coins = np.asarray(counts, np.int64)[order]
    merged, single = np.zeros(0, np.int64), []
    for _ in range(longest):
        packages = merged[:len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([coins, packages])
        at = np.argsort(both, kind="stable")
        single.append(at < n)
        merged = both[at]
    lengths, taken = np.zeros(n, np.int64), 2 * n - 2
    for is_coin in reversed(single):
        own = int(is_coin[:taken].sum())
        lengths[:own] += 1  # the cheapest ones
        taken = 2 * (taken - own)
    out = np.zeros(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """Canonical code: shorter codes first, equal lengths by id."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort([ids, lengths])
        self.ids, lengths = ids[order].astype(np.int64), lengths[order].astype(np.int64)
        self.longest = int(lengths.max(initial=1))
        if self.longest > 25:
            raise ValueError("codes of more than 25 bits do not fit the 32-bit window of the decoder")
        width = np.int64(1) << (self.longest - lengths)  # share of the code space
        begin = np.cumsum(width) - width
        self.of_id = np.zeros(int(self.ids.max(initial=0)) + 1, np.int64)
        self.length_of_id = np.zeros_like(self.of_id)
        self.of_id[self.ids] = begin >> (self.longest - lengths)
        self.length_of_id[self.ids] = lengths
        # the table: every window of ``longest`` bits leads to an id and its length
        self.symbol = np.zeros(1 << self.longest, "<u4")
        self.length = np.ones(1 << self.longest, np.int64)
        filled = np.repeat(np.arange(len(lengths)), width)
        self.symbol[:len(filled)] = self.ids[filled]
        self.length[:len(filled)] = lengths[filled]

    def encode(self, ids: np.ndarray) -> tuple[bytes, list[int]]:
        """Packed codes, first bit highest, and the bit offset of every STEP-th id."""
        code, length = self.of_id[ids], self.length_of_id[ids]
        end = np.cumsum(length)
        at = end - length
        size = int(end[-1] + 7) // 8 if len(ids) else 0
        word = code << (32 - (at & 7) - length)  # 32 bits from the byte that the code begins in
        out = np.zeros(size + 4)
        for k in range(4):  # bits of codes never meet, so sums are unions
            out += np.bincount((at >> 3) + k, word >> (24 - 8 * k) & 255, size + 4)
        return out[:size].astype(np.uint8).tobytes(), at[::STEP].tolist()

    def decode(self, payload: bytes, checkpoints, n: int) -> np.ndarray:
        """The ids of a block, all stretches between checkpoints side by side."""
        data = np.frombuffer(payload + b"\0" * 8, np.uint8).astype(np.uint32)
        window = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
        at = np.asarray(checkpoints, np.int64)
        out = np.zeros((len(at), STEP), "<u4")
        last = 8 * len(payload)  # the last stretch may run out of bits
        shift, mask = 32 - self.longest, (1 << self.longest) - 1
        for k in range(min(STEP, n)):
            look = (window[at >> 3] >> (shift - (at & 7)).astype(np.uint32)) & mask
            out[:, k] = self.symbol[look]
            at = np.minimum(at + self.length[look], last)
        return out.reshape(-1)[:n]


def _maker(ids: bytes, lengths: bytes):
    """What builds the code in a task, from its ids and lengths alone."""
    return lambda: Code(np.frombuffer(ids, "<i4"), np.frombuffer(lengths, "<i4"))


# ------------------------------------------------------------------ writing

IDS = "shard int, doc_no long, doc_id long, first long, n long, ids binary"


def _encoding(path: str, end: int, width: str):
    """Task function: (shard, doc_id, text) in order to the ids of the shard's documents."""
    def run(batches):
        tokenizer, doc_no, first = _tokenizer(path, os.stat(path).st_mtime_ns), 0, 0
        for batch in batches:
            at = 0
            for texts in byte_slices(batch.column(2), TEXTS):
                part, at = batch.slice(at, len(texts)), at + len(texts)
                ids = [np.append(i, np.uint32(end)).astype(width)
                       for i in tokenizer.ids([t or "" for t in texts.to_pylist()])]
                n = np.array([len(i) for i in ids])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.arange(doc_no, doc_no + len(n))), part.column(1),
                     pa.array(first + np.cumsum(n) - n), pa.array(n), pa.array([i.tobytes() for i in ids], pa.binary())],
                    ["shard", "doc_no", "doc_id", "first", "n", "ids"])
                doc_no, first = doc_no + len(n), first + int(n.sum())
    return run


def _counting(width: str):
    def run(batches):
        counts = np.zeros(1, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                ids = np.frombuffer(b"".join(batch.column(0).slice(at, 256).to_pylist()), width)
                found = np.bincount(ids, minlength=len(counts))
                found[:len(counts)] += counts
                counts = found
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(counts[met])], ["id", "n"])
    return run


def _blocks(width: str, make):
    """Task function: rows of IDS in order to blocks."""
    def run(batches):
        code = make()
        kind = pa.struct([("doc_no", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64())])
        schema = pa.schema([("shard", pa.int32()), ("first", pa.int64()), ("n", pa.int64()),
                            ("checkpoints", pa.list_(pa.int32())), ("payload", pa.binary()), ("pieces", pa.list_(kind))])
        parts: list[np.ndarray] = []
        pieces: list[dict] = []
        shard = first = held = 0

        def close():
            ids = np.concatenate(parts)
            payload, checkpoints = code.encode(ids)
            row = {"shard": shard, "first": first, "n": len(ids), "checkpoints": checkpoints, "payload": payload,
                   "pieces": list(pieces)}
            parts.clear()
            pieces.clear()
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for row in batch.slice(at, 256).to_pylist():
                    if parts and (row["shard"], row["first"]) != (shard, first + held):
                        yield close()
                    ids, taken = np.frombuffer(row["ids"], width).astype(np.int64), 0
                    while taken < len(ids):
                        if not parts:
                            shard, first, held = row["shard"], row["first"] + taken, 0
                        some = ids[taken:taken + BLOCK - held]
                        parts.append(some)
                        pieces.append({"doc_no": row["doc_no"], "doc_id": row["doc_id"], "n": len(some)})
                        taken, held = taken + len(some), held + len(some)
                        if held == BLOCK:
                            yield close()
        if parts:
            yield close()
    return run


def write_token_files(docs: DataFrame, folder: str, path: str, end: int = 2) -> None:
    """Write the ids of ``docs`` (doc_id, text) under ``folder``, in order of doc_id.

    ``path`` is the tokenizer's file, ``end`` the id behind each document. Null
    texts are empty; null ids come first; rows of one id are in order of a hash of
    their text, and equal rows are as many documents. Texts are read whole and
    dealt in ranges of doc_id before they are encoded; the ids are written once
    without a code, as their counts come first. A long document spans blocks.
    Other columns are not looked at; an empty table gives empty files.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    width = "<u2" if max(end + 1, Tokenizer.from_file(path).get_vocab_size()) <= 1 << 16 else "<u4"
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("row")]
    dealt = docs.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()}) \
        .repartitionByRange(*order).sortWithinPartitions(*order) \
        .select(F.spark_partition_id().alias("shard"), "doc_id", "text")
    plain = staged_path(spark, "token-ids")
    dealt.mapInArrow(_encoding(path, end, width), IDS).write.option("compression", "zstd").parquet(plain)
    rows = spark.read.schema(IDS).parquet(plain)
    # a row an id of the vocabulary
    counts = rows.select("ids").mapInArrow(_counting(width), "id int, n long") \
        .groupBy("id").agg(F.sum("n").alias("n")).toPandas().sort_values("id")
    ids, lengths = (a.astype("<i4") for a in (counts["id"].to_numpy(), code_lengths(counts["n"].to_numpy())))
    spark.createDataFrame(list(zip(ids.tolist(), lengths.tolist(), strict=True)), CODES).coalesce(1) \
        .write.mode("overwrite").parquet(f"{folder}/codes")
    rows.mapInArrow(_blocks(width, _maker(ids.tobytes(), lengths.tobytes())), BLOCKS) \
        .write.mode("overwrite").parquet(f"{folder}/blocks")


# ------------------------------------------------------------------ reading

def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo that of CRC-32, bit 31 the constant term."""
    out = 0
    while a:
        if a & 0x80000000:
            out ^= b
        a = a << 1 & 0xFFFFFFFF
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


def join_crc(first: int, second: int, size: int) -> int:
    """CRC-32 of two byte strings from those of each and the size of the second."""
    power, square = 0x80000000, 0x00800000  # 1 and x^8
    while size:
        if size & 1:
            power = _times(power, square)
        square = _times(square, square)
        size >>= 1
    return _times(power, first) ^ second


def _pieces(make):
    """Task function: blocks to (shard, doc_no, doc_id, start, n, crc) of their pieces."""
    def run(batches):
        code = make()
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                ids = code.decode(row["payload"], row["checkpoints"], row["n"])
                at, out = 0, []
                for piece in row["pieces"]:
                    own = ids[at:at + piece["n"]]
                    out.append((row["shard"], piece["doc_no"], piece["doc_id"], row["first"] + at, piece["n"],
                                zlib.crc32(own)))
                    at += piece["n"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int32() if k == 0 else pa.int64()) for k, c in enumerate(zip(*out, strict=True))],
                    ["shard", "doc_no", "doc_id", "start", "n", "crc"])
    return run


def _joined():
    @F.arrow_udf("long")
    def crc(pieces: pa.Array) -> pa.Array:
        out = []
        for row in pieces.to_pylist():  # in order; nearly always one
            whole = row[0]["crc"]
            for p in row[1:]:
                whole = join_crc(whole, p["crc"], 4 * p["n"])
            out.append(whole)
        return pa.array(out, pa.int64())
    return crc


def read_blocks(spark: SparkSession, folder: str) -> tuple[DataFrame, pd.DataFrame]:
    """The blocks under ``folder`` with ``before``, the ids of earlier shards, and the
    code lengths."""
    codes = spark.read.parquet(f"{folder}/codes").toPandas()
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    # a row a shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = blocks.groupBy("shard").agg(F.sum("n").alias("size")) \
        .select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    return join_small(blocks, shards, "shard"), codes


def document_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers) of every document, decoded from files."""
    blocks, codes = read_blocks(spark, folder)
    code = _maker(codes["id"].to_numpy("<i4").tobytes(), codes["length"].to_numpy("<i4").tobytes())
    placed = blocks.select("shard", (F.col("first") + F.col("before")).alias("first"), "n", "checkpoints", "payload",
                           "pieces")
    found = placed.mapInArrow(_pieces(code), "shard int, doc_no long, doc_id long, start long, n long, crc long")
    docs = found.groupBy("shard", "doc_no").agg(
        F.max("doc_id").alias("doc_id"), F.min("start").alias("start"), F.sum("n").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("start", "crc", "n"))).alias("parts"))
    return docs.select("doc_id", "start", "n_tokens", _joined()("parts").alias("ids_crc32"))


def token_files(docs: DataFrame, path: str, end: int = 2) -> DataFrame:
    """Write the files to the shared folder and give :func:`document_digests` of them."""
    folder = staged_path(docs.sparkSession, "token-files")
    write_token_files(docs, folder, path, end)
    return document_digests(docs.sparkSession, folder)
