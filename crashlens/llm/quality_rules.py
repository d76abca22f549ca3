"""Quality rules: fixed text rules plus a robust multivariate outlier test.

Text statistics are plain column expressions over the whole text. The outlier
test fits a minimum-covariance-determinant (MCD) estimate of location and
scatter for every language and source and rejects documents whose transformed
statistics lie too far away by Mahalanobis distance. Everything is DataFrame
work: no Python runs on the executors.

Words are runs of characters other than space, tab, \\n, \\v, \\f and \\r.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crashlens.llm.common import SPACES, join_small, let, null_key, spaced, split_words
from crashlens.session import stage_table

SYMBOLS = "#*$%&|<>"

#: Transformed statistics (the vector of the outlier test).
FEATURES = ["f_word_length", "f_symbols", "f_dup_lines", "f_repeats"]
#: Least standard deviation of each: below it a difference says nothing about
#: quality (a corpus without any symbol must not make one symbol an outlier).
FLOORS = [0.05, 0.06, 0.10, 0.14]
#: Share of rows in the subset whose covariance determinant is minimised.
SUBSET = 0.75
#: Consistency of the 75 % subset for normal data in four dimensions:
#: 0.75 / P(chi2_6 <= q) with q the 75 % quantile of chi2_4.
CONSISTENCY = 1.486
#: Rows by which a group's estimate is drawn towards the whole corpus's.
SHRINK_ROWS = 50
#: Concentration steps after the start from medians and absolute deviations.
STEPS = 3
#: Squared distance beyond which a document is rejected: the 99.9 % quantile of
#: chi-square with four degrees of freedom.
CUTOFF = 18.467


def _without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur at least twice in the text.

    Windows are compared by a 64-bit hash within one text: sort (hash, place),
    keep places whose neighbour has the same hash, and add up the union of
    the three-word intervals that begin there. Texts without a repeated hash,
    most of them, need no sort.
    """
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - 3),
                         lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda x, k: F.least(
            F.lit(3), x - F.coalesce(F.get(places, k - 1), x - 3)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def repeated(s: Column) -> Column:
        twice = F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                         | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)))
        return let(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

    def counted(h: Column) -> Column:
        windows = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")) \
            .otherwise(let(windows, repeated))

    return F.when(F.size(words) >= 4, let(hashes, counted)).otherwise(F.lit(0).cast("long"))


def text_statistics(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_lines (lines with a word),
    n_dup_lines and n_repeat_words of a text; all zero for null or empty."""
    text = F.coalesce(text, F.lit(""))

    def measure(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
        line_part = let(lines, lambda x: F.struct(
            F.size(x).cast("long").alias("n"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
        word_part = let(spaced(t), lambda u: F.struct(
            F.length(F.replace(u, F.lit(" "), F.lit(""))).cast("long").alias("chars"),
            let(split_words(u), lambda w: F.struct(
                F.size(w).cast("long").alias("n"), _repeat_words(w).alias("repeat"))).alias("w")))
        return let(F.struct(line_part.alias("l"), word_part.alias("t")), lambda p: F.struct(
            p["t"]["w"]["n"].alias("n_words"),
            p["t"]["chars"].alias("word_chars"),
            (F.length(t) - F.length(_without(t, SYMBOLS))).cast("long").alias("n_symbols"),
            p["l"]["n"].alias("n_lines"),
            p["l"]["dup"].alias("n_dup_lines"),
            p["t"]["w"]["repeat"].alias("n_repeat_words")))

    return let(text, measure)


def feature_columns() -> list[Column]:
    """Transformed statistics. Ratios carry a prior weight (100 words of five
    characters, five lines, ...), so that short texts stay near the middle."""
    n = F.col("n_words")
    return [
        F.log((F.col("word_chars") + 500.0) / (n + 100.0)).alias(FEATURES[0]),
        F.sqrt(F.col("n_symbols") / (F.col("word_chars") + 50.0)).alias(FEATURES[1]),
        (F.col("n_dup_lines") / (F.col("n_lines") + 5.0)).alias(FEATURES[2]),
        (F.col("n_repeat_words") / (n + 30.0)).alias(FEATURES[3]),
    ]


P = len(FEATURES)
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def with_factors(groups: DataFrame, scale: float) -> DataFrame:
    """Replace the scatter s* of each group by the Cholesky factors l* of the
    scatter times ``scale`` plus the squared floors on its diagonal."""
    s = {(i, j): F.col(f"s{i}{j}") * scale + (FLOORS[i] ** 2 if i == j else 0.0) for i, j in PAIRS}
    low: dict[tuple[int, int], Column] = {}
    for i, j in PAIRS:
        rest = s[i, j]
        for q in range(j):
            rest = rest - low[i, q] * low[j, q]
        low[i, j] = F.sqrt(rest) if i == j else rest / low[j, j]
    return groups.select("group", *[f"m{i}" for i in range(P)],
                         *[low[i, j].alias(f"l{i}{j}") for i, j in PAIRS])


def squared_distance() -> Column:
    """Squared Mahalanobis distance of FEATURES from columns m* and l*."""
    y: list[Column] = []
    for i, c in enumerate(FEATURES):
        rest = F.col(c) - F.col(f"m{i}")
        for q in range(i):
            rest = rest - F.col(f"l{i}{q}") * y[q]
        y.append(rest / F.col(f"l{i}{i}"))
    return sum((v * v for v in y[1:]), y[0] * y[0])


def _moments(rows: DataFrame) -> DataFrame:
    """Size, mean and covariance of the features in each group."""
    f = [F.col(c) for c in FEATURES]
    sums = rows.groupBy("group").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(f)],
        *[F.covar_pop(f[i], f[j]).alias(f"s{i}{j}") for i, j in PAIRS])
    return sums


def mcd_estimates(stats: DataFrame, steps: int = STEPS) -> DataFrame:
    """MCD location m0.. and scatter s00.. of every ``group`` in ``stats``
    (columns ``group`` and FEATURES).

    Deterministic start: medians and absolute deviations give diagonal
    distances. Each concentration step keeps the rows whose distance is at
    most the group's SUBSET quantile and takes their mean and covariance,
    which never raises the determinant. Each step's estimates, one row a
    group, are written to the shared folder.
    """
    def place(rows: DataFrame, values: DataFrame) -> DataFrame:
        return join_small(rows, values, "group")

    med = stage_table(stats.groupBy("group").agg(
        *[F.percentile_approx(c, 0.5, 10000).alias(f"med{i}") for i, c in enumerate(FEATURES)]),
        "mcd-median")
    dev = stage_table(place(stats, med).groupBy("group").agg(
        *[F.percentile_approx(F.abs(F.col(c) - F.col(f"med{i}")), 0.5, 10000).alias(f"dev{i}")
          for i, c in enumerate(FEATURES)]), "mcd-deviation")
    est = med.join(dev, "group").select(
        "group", *[F.col(f"med{i}").alias(f"m{i}") for i in range(P)],
        *[(F.pow(1.4826 * F.col(f"dev{i}"), 2) if i == j else F.lit(0.0)).alias(f"s{i}{j}")
          for i, j in PAIRS])
    for _ in range(steps):
        near = place(stats, stage_table(with_factors(est, 1.0), "mcd-factors")).select(
            "group", *FEATURES, squared_distance().alias("d2"))
        limit = stage_table(near.groupBy("group").agg(
            F.percentile_approx("d2", SUBSET, 10000).alias("limit")), "mcd-limit")
        est = stage_table(_moments(place(near, limit).where("d2 <= limit")), "mcd-step")
    return est


def judge(stats: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Add ``distance2`` and ``outlier`` to rows with ``lang``, ``source`` and
    the counts of :func:`text_statistics`. ``stats`` is read several times, so
    pass a written table. A null language or source is a value of its own."""
    stats = stats.withColumn("group", null_key("lang", "source")).select("*", *feature_columns())
    # the whole corpus is one more group; sums per task come before the shuffle
    both = stats.select(F.explode(F.array(F.col("group"), F.lit("*"))).alias("group"), *FEATURES)
    est = mcd_estimates(both)
    whole = est.where("group = '*'").first()  # one row; none for an empty table
    k = float(SHRINK_ROWS)
    parts = [c for c in est.columns if c not in ("group", "n")]
    mixed = stage_table(with_factors(est.where("group <> '*'").select("group", *[
        ((F.col("n") * F.col(c) + k * (whole[c] if whole else 0.0)) / (F.col("n") + k)).alias(c)
        for c in parts]), CONSISTENCY), "mcd-groups")
    judged = join_small(stats, mixed, "group", "left")
    # a group without an estimate cannot occur; a null distance counts as inside
    d2 = F.coalesce(squared_distance(), F.lit(0.0))
    drop = ["group", *FEATURES, *[c for c in mixed.columns if c != "group"]]
    return judged.withColumn("distance2", d2).withColumn("outlier", F.col("distance2") > cutoff) \
        .drop(*drop)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _verdicts(docs: DataFrame, carried: list[str], cutoff: float) -> DataFrame:
    """Counts and verdicts next to the carried columns, named _id_0, _id_1, ..."""
    stats = docs.select(*[F.col(f"`{c}`").alias(f"_id_{i}") for i, c in enumerate(carried)],
                        "lang", "source", text_statistics(F.col("text")).alias("_s")) \
        .select(*[f"_id_{i}" for i in range(len(carried))], "lang", "source", "_s.*")
    judged = judge(stage_table(stats, "text-statistics"), cutoff)
    return judged.withColumn("base_failed", base_failed()) \
        .withColumn("kept", ~F.col("base_failed") & ~F.col("outlier"))


def quality_verdicts(docs: DataFrame, ident: str = "doc_id", cutoff: float = CUTOFF) -> DataFrame:
    """One row per document: its id, the counts, base_failed, kept, distance2.

    Null and empty texts have zero counts and fail the base rules. Repeated
    rows are judged alike; an empty table gives an empty result. Columns of
    ``docs`` other than ident, lang, source and text are not looked at.
    """
    return _verdicts(docs, [ident], cutoff).select(
        F.col("_id_0").alias(ident), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept", "distance2")


def keep_good(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns (any names)."""
    return _verdicts(docs, docs.columns, cutoff).where("kept").select(
        *[F.col(f"_id_{i}").alias(c) for i, c in enumerate(docs.columns)])
