"""Landed JSON lines whose fields change over time.

Lines are parsed to VARIANT once. Declared fields are read with their type;
whatever has no place there is kept as JSON text in ``rescued``, so a new or
retyped field loses nothing. :func:`schema_drift` reports such changes per batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What a declared type looks like in JSON.
KINDS = {T.StringType: "text", T.BooleanType: "truth", T.LongType: "number", T.IntegerType: "number",
         T.DoubleType: "number"}
WHOLE = (T.IntegerType, T.LongType)


def _object(text: str) -> Column:
    """Fields of a JSON object as a map to VARIANT; null for anything else, also
    for broken text and objects that name a field twice."""
    v = F.try_parse_json(F.col(text))
    return F.when(F.schema_of_variant(v).startswith("OBJECT"), v.cast("map<string,variant>"))


def kind(value: Column) -> Column:
    """number, text, truth, array, object or null (of JSON), by the VARIANT's type."""
    name = F.schema_of_variant(value)
    return F.when(name == "STRING", "text").when(name == "BOOLEAN", "truth").when(name == "VOID", "null") \
        .when(name.startswith("ARRAY"), "array").when(name.startswith("OBJECT"), "object").otherwise("number")


def _typed(value: Column, to: T.DataType) -> Column:
    """The value as the declared type where nothing is lost by it, else null:
    a number written as text is read, a fraction is no whole number."""
    got = F.try_variant_get(value, "$", to.simpleString())
    if isinstance(to, WHOLE):
        return F.when(F.try_variant_get(value, "$", "double") == got.cast("double"), got)
    if isinstance(to, T.StringType):
        return F.when(~kind(value).isin("array", "object"), got)
    return got


def ingest_json(lines: DataFrame, schema: T.StructType, text: str = "value") -> DataFrame:
    """The other columns of ``lines``, the fields of ``schema``, ``rescued`` and ``is_bad``.

    ``rescued`` is a JSON object with every field that ``schema`` does not name
    and every value that its declared type cannot hold (that column is null);
    null if there is none. ``is_bad``: the line is no JSON object, null included;
    its text stays in ``rescued``. Column names must not clash.
    """
    rest = [c for c in lines.columns if c != text]
    made = [f.name for f in schema] + ["rescued", "is_bad"]
    if clash := sorted({c.lower() for c in rest} & {c.lower() for c in made}):
        raise ValueError(f"columns of the lines clash with fields: {clash}")
    unknown = [f.name for f in schema if type(f.dataType) not in KINDS]
    if unknown:
        raise ValueError(f"fields need a plain type: {unknown}")
    df = lines.withColumn("_m", _object(text))
    fields = {f.name: _typed(F.try_element_at(F.col("_m"), F.lit(f.name)), f.dataType) for f in schema}
    df = df.select(*rest, text, "_m", F.struct(*[c.alias(n) for n, c in fields.items()]).alias("_f"))
    lost = [n for n in fields]

    def kept(k: Column, v: Column) -> Column:
        held = F.lit(False)
        for n in lost:
            held = held | ((k == n) & F.col("_f").getField(n).isNotNull())
        named = k.isin(*lost) if lost else F.lit(False)
        return ~held & ~(named & (kind(v) == "null"))
    left = F.map_filter("_m", kept)
    return df.select(*rest, *[F.col("_f").getField(n).alias(n) for n in lost],
                     F.when(F.col("_m").isNull(), F.col(text)).when(F.size(left) > 0, F.to_json(left)).alias("rescued"),
                     F.col("_m").isNull().alias("is_bad"))


def schema_drift(lines: DataFrame, schema: T.StructType, batch: str, text: str = "value") -> DataFrame:
    """batch, field, drift, n_rows, n_present, kinds: fields that are not as declared.

    ``added``: not in ``schema``; ``missing``: in no readable row of the batch;
    ``retyped``: of another kind than declared in some row (JSON null fits all).
    ``n_rows`` counts the batch's readable rows, ``n_present`` those with the
    field; ``kinds`` lists what was met, comma-joined.
    """
    rows = lines.select(F.col(batch).alias("batch"), _object(text).alias("_m")).where("_m is not null")
    sizes = rows.groupBy("batch").agg(F.count(F.lit(1)).alias("n_rows"))
    met = rows.select("batch", F.explode("_m").alias("field", "_v")).select("batch", "field", kind(F.col("_v")).alias("kind")) \
        .groupBy("batch", "field", "kind").agg(F.count(F.lit(1)).alias("n"))
    met = met.groupBy("batch", "field").agg(
        F.sum("n").alias("n_present"), F.array_join(F.sort_array(F.collect_set("kind")), ",").alias("kinds"),
        F.collect_set("kind").alias("_kinds"))
    declared = F.array(*[F.struct(F.lit(f.name).alias("_field"), F.lit(KINDS[type(f.dataType)]).alias("_kind"))
                         for f in schema])
    want = sizes.select(F.col("batch").alias("_batch"), F.inline(declared))  # a row a batch and field
    both = met.join(want, F.col("batch").eqNullSafe(F.col("_batch")) & (F.col("field") == F.col("_field")), "full") \
        .select(F.coalesce("batch", "_batch").alias("batch"), F.coalesce("field", "_field").alias("field"),
                F.coalesce("n_present", F.lit(0)).alias("n_present"), F.coalesce("kinds", F.lit("")).alias("kinds"),
                "_kinds", "_kind")
    drift = F.when(F.col("_kind").isNull(), "added").when(F.col("n_present") == 0, "missing") \
        .when(F.size(F.array_except("_kinds", F.array(F.col("_kind"), F.lit("null")))) > 0, "retyped")
    both = both.withColumn("drift", drift).where("drift is not null")
    return both.join(sizes.withColumnRenamed("batch", "_b"), F.col("batch").eqNullSafe(F.col("_b")), "left") \
        .select("batch", "field", "drift", "n_rows", "n_present", "kinds")
