"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from crashlens.session import stage_table

#: Most rows of a table that a join may broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """Bind ``value`` once inside an expression: ``body`` gets a lambda variable
    instead of a copy of the expression, so it is evaluated once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def null_key(*names: str) -> Column:
    """One string key for columns that may be null; null differs from every value."""
    parts = [F.coalesce(F.concat(F.lit("v"), F.length(F.col(n).cast("string")).cast("string"),
                                 F.lit(":"), F.col(n).cast("string")), F.lit("n")) for n in names]
    return F.concat_ws("|", *parts)


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join with a table that is usually small: its rows are counted first, and
    only up to BROADCAST_ROWS of them are broadcast; a larger one is shuffled."""
    if small.count() <= BROADCAST_ROWS:
        small = F.broadcast(small)
    return big.join(small, on, how)


def in_order(rows: DataFrame, keys: list[str], name: str, group: str) -> DataFrame:
    """``rows`` with ``place``, their position from 0 within ``group`` (the first of
    ``keys``, never null) in the order of ``keys``, nulls first, and ``size``, the
    group's number of rows.

    No group comes together in one task: rows are dealt in ranges of ``keys``
    and written, and a place is that in the range plus the rows of the group in
    earlier ranges, a table of one row a range and group. Pass a written table,
    as ranges are found by sampling it, with keys that tell hot rows apart.
    """
    order = [F.col(k).asc_nulls_first() for k in keys]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order) \
        .withColumn("_at", F.monotonically_increasing_id())  # range and row within it
    dealt = stage_table(dealt.withColumn("_range", F.shiftright("_at", 33)), name)
    parts = dealt.groupBy(group, "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    parts = stage_table(parts.select(
        group, "_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(whole).alias("size")), f"{name}-ranges")
    return join_small(dealt, parts, [group, "_range"]) \
        .withColumn("place", F.col("_at") + F.col("_shift")).drop("_at", "_range", "_shift")


#: The white space that separates words in the digest columns.
SPACES = " \t\n\x0b\f\r"


def spaced(text: Column) -> Column:
    """The text with every white-space character turned into a space. Plain
    replacements run far faster than a regular expression."""
    for c in SPACES[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def split_words(spaced_text: Column) -> Column:
    """Words of a text that went through :func:`spaced`."""
    return F.array_remove(F.split(spaced_text, " ", -1), "")


#: Bytes of texts that a task turns into Python objects at once.
SLICE = 1 << 21


def byte_slices(texts: pa.Array, size: int | None = None) -> Iterator[pa.Array]:
    """Slices of an array of values of any size, each of about ``size`` (SLICE) bytes or one value."""
    at, n, size = 0, len(texts), size or SLICE
    step = max(1, min(n, n * size // max(texts.nbytes, 1)))
    while at < n:
        part = texts.slice(at, step)
        if part.nbytes > 2 * size and len(part) > 1:
            step = max(1, step // 2)
            continue
        yield part
        at += step


def per_texts(make, returns: str):
    """An Arrow UDF over one text column that yields one struct a row.

    ``make()`` runs once a task and returns a function from a list of texts
    (null comes as the empty text) to an iterable with one tuple of the
    struct's fields for each, so caches live as long as the task. Texts are
    worked on in lists of about SLICE bytes and their results handed on at once,
    so a task holds no more of them than that.
    """
    kind = to_arrow_type(DataType.fromDDL(returns))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = make()
        for texts in batches:
            for part in byte_slices(texts):
                rows = list(work([t.as_py() or "" for t in part]))
                yield pa.StructArray.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), kind, strict=True)],
                    fields=list(kind))

    return F.arrow_udf(run, returnType=returns)


def per_text(make, returns: str):
    """As :func:`per_texts`, with a function of a single text."""
    return per_texts(lambda: (lambda work: lambda texts: map(work, texts))(make()), returns)


#: Bytes outside words of letters and digits (every byte from 0x80 up is inside).
_GAPS = bytes(b if chr(b).isalnum() and b < 0x80 or b >= 0x80 else 0x20 for b in range(256))


def word_chunks(text: str, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text with A-Z lower-cased,
    as UTF-8, in lists of about ``size`` bytes, so long texts take little memory."""
    data = text.encode().lower().translate(_GAPS)
    at = 0
    while at < len(data):
        end = len(data) if len(data) - at <= size else data.find(b" ", at + size)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end
