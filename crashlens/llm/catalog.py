"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlens.llm import (byte_bpe, collocations, labelled, license_scan, merkle, mixing, ngram_join, page_text, pii, quality_model,
                           quality_rules, token_files, topk, toxicity)
from crashlens.llm.common import table
from crashlens.session import ensure_checkpoint_dir, stage_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op2_quality_rules")
def op2(spark, sf):
    return quality_rules.quality_verdicts(table(spark, sf, "documents"))


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS size
  FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
turned AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS turn FROM per),
weighed AS (
  SELECT *, [3, 1, 2][CAST(turn % 3 + 1 AS INT)] AS w, 2 * source_size AS cap FROM turned),
placed AS (
  SELECT *, row_number() OVER (ORDER BY cap / w, turn) AS place,
    coalesce(sum(cap) OVER (ORDER BY cap / w, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
    sum(w) OVER (ORDER BY cap / w, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
    sum(source_size) OVER () AS total
  FROM weighed),
levels AS (
  SELECT *, CAST(150 * total - 100 * filled AS DOUBLE) / (100.0::DOUBLE * rest) AS level FROM placed),
water AS (
  SELECT level AS water FROM levels WHERE level * w <= cap ORDER BY place LIMIT 1),
targets AS (
  SELECT source, source_size,
    CASE WHEN (SELECT water FROM water) IS NULL THEN CAST(cap AS DOUBLE)
         ELSE least(CAST(cap AS DOUBLE), (SELECT water FROM water) * w) END AS target
  FROM levels),
rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate FROM targets)
SELECT s.doc_id, CAST(s.size AS BIGINT) AS size, r.source_size, r.target,
  CAST(s.size * (floor(r.rate) + CASE WHEN
    CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(s.doc_id AS VARCHAR), '')), 1, 12) AS BIGINT)
    < (r.rate - floor(r.rate)) * 281474976710656.0::DOUBLE THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source
"""


@register("op3_mix_sources", MIX_SQL)
def op3(spark, sf):
    docs = table(spark, sf, "documents")
    sized = stage_table(docs.select("doc_id", "source", mixing.text_size(F.col("text")).alias("size")),
                        "mix-sizes")
    return mixing.mix_plan(sized).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@register("op1_license_scan")
def op1(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", license_scan.license_scan(F.col("text")).alias("_r")) \
        .select("doc_id", "_r.*")


@register("op4_byte_bpe")
def op4(spark, sf):
    import public_tokenizers

    docs = table(spark, sf, "documents")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return docs.select("doc_id", byte_bpe.bpe_digests(F.col("text"), path).alias("_r")) \
        .select("doc_id", "_r.*")


def _scored(docs, score, folds, fold):
    return docs.select("doc_id", labelled.held_out(F.col("doc_id"), folds, fold).alias("held_out"),
                       score.alias("score")) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@register("op9_quality_model")
def op9(spark, sf):
    docs = table(spark, sf, "documents")
    train = labelled.training_rows(docs, table(spark, sf, "labels"), "quality", 3, 1)
    return _scored(docs, quality_model.quality_score(F.col("text"), quality_model.fit_quality(train)), 3, 1)


@register("op10_toxicity")
def op10(spark, sf):
    docs = table(spark, sf, "documents")
    train = stage_table(labelled.training_rows(docs, table(spark, sf, "labels"), "toxic", 5, 0),
                        "toxic-sample")
    return _scored(docs, toxicity.toxicity_score(F.col("text"), toxicity.fit_toxicity(train)), 5, 0)


@register("op5_pii")
def op5(spark, sf):
    docs = table(spark, sf, "documents")
    return pii.with_spans(docs.select("doc_id", "text"), pii.fit_pii(docs)).select("doc_id", "_r.*")


@register("op6_page_text")
def op6(spark, sf):
    return page_text.extract_pages(table(spark, sf, "pages"))


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@register("op8_top_inner_products", TOPK_SQL)
def op8(spark, sf):
    return topk.top_inner_products(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


@register("op7_ngram_join")
def op7(spark, sf):
    return ngram_join.ngram_join(table(spark, sf, "documents").select("doc_id", "text"))


COLLOCATION_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM docs),
lists AS (
  SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
one AS (SELECT lang, unnest(w) AS phrase FROM lists),
two AS (
  SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS phrase FROM lists),
three AS (
  SELECT lang, unnest(list_transform(range(1, len(w) - 1),
    lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS phrase FROM lists WHERE len(w) > 2),
f AS (
  SELECT lang, phrase, 1 AS size, count(*) AS n FROM one GROUP BY ALL
  UNION ALL SELECT lang, phrase, 2, count(*) FROM two GROUP BY ALL HAVING count(*) >= 10
  UNION ALL SELECT lang, phrase, 3, count(*) FROM three GROUP BY ALL HAVING count(*) >= 10),
cand AS (SELECT lang, phrase, size, n AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND n >= 10),
inside AS (
  SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, a FROM cand WHERE size = 3),
kept AS (
  SELECT * FROM cand c WHERE NOT EXISTS (
    SELECT 1 FROM inside i WHERE c.size = 2 AND i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.a >= 50 * c.a)),
cuts AS (
  SELECT lang, phrase, size, a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y
  FROM (SELECT *, unnest(range(1, size)) AS k FROM kept)),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.n AS l, y.n AS r,
    CAST((1000000 * CAST(c.a AS HUGEINT) * c.a) // (CAST(x.n AS HUGEINT) * y.n) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.x JOIN f y ON y.lang = c.lang AND y.phrase = c.y),
lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS turn FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest WHERE turn = 1)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score
FROM ranked r JOIN (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang) t ON t.lang = r.lang
WHERE r.rank <= 2000
"""


@register("op11_collocations", COLLOCATION_SQL)
def op11(spark, sf):
    return collocations.mine_collocations(table(spark, sf, "documents"))


#: Unsigned CRC-32 of a decimal number: eight shifts for each of its digits.
_CRC = """(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({x}, ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda v, _: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))))"""


def _field_sql(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || {value} END"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_UP_SQL = """SELECT g, level + 1, list_transform(range(0, (len(hs) + 2) // 3),
    lambda i: sha256(array_to_string(hs[3 * i + 1:3 * i + 3], ''))) FROM {t} WHERE len(hs) > 1"""

MERKLE_SQL = f"""
WITH RECURSIVE base AS (
  SELECT doc_id, source, {_leaf_sql('text')} AS leaf,
    CASE WHEN text IS NOT NULL AND xor({_CRC.format(x="CAST(doc_id AS VARCHAR)")}, 4294967295) % 2 = 0
      THEN {_leaf_sql("replace(text, chr(10), '')")} END AS found
  FROM documents),
leaves AS (
  SELECT *, coalesce('v' || source, 'n') AS g, row_number() OVER (
    PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, found) - 1 AS place FROM base),
tree(g, level, hs) AS (
  SELECT g, 0, list(leaf ORDER BY place) FROM leaves GROUP BY g
  UNION ALL {_UP_SQL.format(t='tree')}),
subs AS (
  SELECT g, hs[1] AS subroot, row_number() OVER (ORDER BY g) - 1 AS turn FROM tree WHERE len(hs) = 1),
top(g, level, hs) AS (
  SELECT 'all', 0, list(subroot ORDER BY turn) FROM subs
  UNION ALL {_UP_SQL.format(t='top')}),
steps AS (
  SELECT l.g, l.place, t.level AS level, t.hs, CAST(floor(l.place / pow(3, t.level)) AS BIGINT) AS p
  FROM leaves l JOIN tree t ON t.g = l.g AND len(t.hs) > 1
  UNION ALL
  SELECT l.g, l.place, 1000 + t.level, t.hs, CAST(floor(s.turn / pow(3, t.level)) AS BIGINT)
  FROM leaves l JOIN subs s ON s.g = l.g JOIN top t ON len(t.hs) > 1),
sides AS (
  SELECT g, place, row_number() OVER (PARTITION BY g, place ORDER BY level) AS turn,
    array_to_string(hs[p - p % 3 + 1:p], '') AS x, array_to_string(hs[p + 2:p - p % 3 + 3], '') AS y FROM steps),
proof AS (
  SELECT g, place, string_agg(x || y, '' ORDER BY turn) AS joined FROM sides GROUP BY g, place),
folding(g, place, turn, h) AS (
  SELECT g, place, 0, coalesce(found, leaf) FROM leaves
  UNION ALL
  SELECT f.g, f.place, f.turn + 1, sha256(s.x || f.h || s.y) FROM folding f
  JOIN sides s ON s.g = f.g AND s.place = f.place AND s.turn = f.turn + 1),
folded AS (SELECT g, place, arg_max(h, turn) AS h FROM folding GROUP BY g, place)
SELECT l.doc_id, l.leaf, s.subroot, r.hs[1] AS root, sha256(coalesce(p.joined, '')) AS proof_sha256,
  f.h AS folded_root, f.h = r.hs[1] AS verified
FROM leaves l JOIN subs s ON s.g = l.g JOIN top r ON len(r.hs) = 1 JOIN folded f ON f.g = l.g AND f.place = l.place
LEFT JOIN proof p ON p.g = l.g AND p.place = l.place
"""


@register("op13_merkle_manifest", MERKLE_SQL)
def op13(spark, sf):
    half = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return merkle.manifest(table(spark, sf, "documents"),
                           F.when(half, F.replace(F.col("text"), F.lit("\n"), F.lit(""))))


@register("op12_token_files")
def op12(spark, sf):
    import public_tokenizers

    return token_files.token_files(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))
