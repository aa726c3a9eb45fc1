"""Operator 11: quality rules by robust multivariate outliers, in DataFrame
functions only.

After Rousseeuw and Van Driessen, "A Fast Algorithm for the Minimum Covariance
Determinant Estimator" (1999), with one robust start as in Hubert, Rousseeuw
and Verdonck, "A Deterministic Algorithm for Robust Location and Scatter"
(2012). Per text, four rates are taken: characters a word, symbols a character,
repeated lines a word and repeated words a word. Their square roots, on a fixed
grid of whole numbers, are the statistic vector. For each language and source
the documents that pass the base rules give a centre and a scatter:

1. start: the medians and interquartile ranges of each component;
2. concentration steps: the share ``SUBSET`` of the documents with the smallest
   Mahalanobis distances gives the next centre and covariance, until no
   group's determinant falls by ``SETTLED`` any more.

The scatter is scaled to be consistent for normal data, and ``GRAIN`` is added
to its diagonal, so that a component that hardly varies cannot reject for
trifles. Rates of short texts scatter more: a distance counts ``n / (n +
SHORT_WORDS)``-fold, n the words. A document beyond the ``TAIL`` quantile of the
chi-squared distribution is rejected.

Scale: texts are read once; the statistics, a few numbers a document, are
written. A step is one pass over them with a partial aggregation to (group,
distance bin), at most ``BINS`` rows a group however many documents a group
holds; the subset's last bin counts in part, so ties are taken alike and no
distances are sorted. Sums are of whole numbers, thus exact, and reruns agree.
The estimates, one row a group, are joined back; nothing is sent to the driver
but whether a step changed them.

Nulls and odd rows: a null or empty text has no words and fails the base rule;
null languages and sources are groups of their own. Groups of fewer than
``MIN_GROUP`` documents are estimated together; are there fewer in all, none
of them is an outlier. Repeated rows and copies each count. Texts of any length are taken
whole. An empty table gives an empty result. Only the four named columns are
read; others, whatever their names, have no influence.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveflow.session import materialize

BASE = ["word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SYMBOLS = "[#*$%&|<>]"
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: words of a window that may repeat
WINDOW = 5

#: the share of a group's documents that its estimates rest on
SUBSET = 0.75
#: documents that a group needs for estimates of its own
MIN_GROUP = 100
#: the probability of a distance beyond which a document is an outlier
TAIL = 1e-7
SHORT_WORDS = 20
#: whole numbers to 1, for the square root of each rate
GRID = [1024, 4096, 4096, 4096]
#: the largest component: the rates of real text are far below
TOP = 65_535
#: added standard deviation of each component, on its grid: 0.075 for symbols, so
#: that tables (one symbol in eight characters) stay, 0.1 for repeats
GRAIN = [96, 307, 409, 409]
BINS = 4_096
#: bins to a distance of 1
BIN_GRID = 16
#: a determinant that falls by a smaller share has settled
SETTLED = 1e-3
MAX_STEPS = 25

_D = len(GRID)
_V = [f"v{i}" for i in range(_D)]
_PAIRS = [(i, j) for i in range(_D) for j in range(i + 1)]


def chi_squared_tail(x: float, freedom: int) -> float:
    """P(X > x) for an even number of degrees of freedom."""
    return math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(freedom // 2))


def chi_squared_beyond(tail: float, freedom: int) -> float:
    """The x with P(X > x) = tail."""
    low, high = 0.0, 1e4
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_squared_tail(mid, freedom) > tail else (low, mid)
    return high


#: the covariance of the SUBSET nearest documents of normal data, to the whole
CONSISTENCY = SUBSET / (1 - chi_squared_tail(chi_squared_beyond(1 - SUBSET, _D), _D + 2))
CUT = chi_squared_beyond(TAIL, _D)


# -- the statistics of a text ----------------------------------------------------

def text_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the text and with n_words, word_chars, n_symbols,
    n_dup_lines and n_repeat_words. Each step refers to the arrays of the
    step before more than once, so Spark computes these once a row."""
    text, rest = F.coalesce(F.col(f"`{text_col}`"), F.lit("")), [c for c in docs.columns if c != text_col]
    rest = [F.col(f"`{c}`") for c in rest]
    rows = docs.select(
        *rest, F.array_remove(F.split(text, SPACES, -1), "").alias("_words"),
        F.filter(F.split(text, "\n", -1), lambda s: s.rlike(WORD)).alias("_lines"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    words, hashes, starts = F.col("_words"), F.col("_hashes"), F.col("_runs")

    def run(i):
        return F.slice(words, i + 1, WINDOW)

    rows = rows.select(
        *rest, "_words", "n_symbols", F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(words) < WINDOW, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(run(i)))).alias("_hashes"))
    rows = rows.select(
        *rest, "_words", "word_chars", "n_symbols", "n_words", "n_dup_lines",
        # in order of the hashes equal windows are neighbours; most texts have none
        F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.array().cast("array<struct<h:bigint,i:int>>"))
        .otherwise(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_runs"))

    def same(x, y):
        return (x["h"] == y["h"]) & (run(x["i"]) == run(y["i"]))

    twice = F.filter(starts, lambda x, k: F.coalesce(same(x, F.get(starts, k - 1)), F.lit(False))
                     | F.coalesce(same(x, F.get(starts, k + 1)), F.lit(False)))
    covered = F.aggregate(
        F.sort_array(F.transform(twice, lambda x: x["i"])),
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct((i + WINDOW).alias("end"),
                              (a["n"] + i + WINDOW - F.greatest(i, a["end"])).alias("n")),
        lambda a: a["n"])
    return rows.select(*rest, "n_words", "word_chars", "n_symbols", "n_dup_lines", covered.alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _rates() -> list[Column]:
    n, chars = F.col("n_words"), F.col("word_chars")
    rates = [F.try_divide(chars, n), F.try_divide(F.col("n_symbols"), chars),
             F.try_divide(F.col("n_dup_lines"), n), F.try_divide(F.col("n_repeat_words"), n)]
    return [F.least(F.floor(F.sqrt(r) * g), F.lit(TOP)).cast("long").alias(v) for r, g, v in zip(rates, GRID, _V)]


# -- the estimates ---------------------------------------------------------------

def _start(rows: DataFrame) -> DataFrame:
    """Medians and quartile ranges of each component, from its histogram."""
    wide = 16
    hist = (rows.select("g", F.posexplode(F.array(*_V)).alias("i", "v"))
            .groupBy("g", "i", F.least(F.floor(F.col("v") / wide), F.lit(BINS)).alias("bin")).agg(F.count("*").alias("c")))
    by = Window.partitionBy("g", "i")
    upto = hist.withColumn("upto", F.sum("c").over(by.orderBy("bin"))).withColumn("all", F.sum("c").over(by))

    def quantile(q):
        return (F.min(F.when(F.col("upto") >= F.col("all") * q, F.col("bin"))) + 0.5) * wide

    one = upto.groupBy("g", "i").agg(quantile(0.25).alias("q1"), quantile(0.5).alias("q2"), quantile(0.75).alias("q3"))
    # 1.349: the quartile range of a normal variable of deviation 1
    spread = (F.col("q3") - F.col("q1")) / 1.349
    cols = []
    for i in range(_D):
        mine = F.col("i") == i
        cols += [F.max(F.when(mine, F.col("q2"))).alias(f"m{i}"),
                 F.max(F.when(mine, F.sqrt(spread * spread + GRAIN[i] ** 2))).alias(f"l{i}{i}")]
    zero = [F.lit(0.0).alias(f"l{i}{j}") for i, j in _PAIRS if i != j]
    return one.groupBy("g").agg(*cols).select("*", *zero)


def distance() -> Column:
    """The squared Mahalanobis distance of a row joined with its group's
    estimates, by substitution in the Cholesky factor."""
    y: list[Column] = []
    for i in range(_D):
        left = F.col(f"v{i}") - F.col(f"m{i}")
        for j in range(i):
            left = left - F.col(f"l{i}{j}") * y[j]
        y.append(left / F.col(f"l{i}{i}"))
    total = y[0] * y[0]
    for part in y[1:]:
        total = total + part * part
    return total * F.col("n_words") / (F.col("n_words") + SHORT_WORDS)


def _concentrate(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """The next estimates: those of each group's nearest documents."""
    far = (rows.join(estimates, "g").withColumn("d", distance())
           .select("g", *_V, F.least(F.floor(F.sqrt("d") * BIN_GRID), F.lit(BINS)).alias("bin")))
    # products are below 2^32: a bin's sums fit a long for 2^31 documents at the very top
    sums = [F.sum(f"v{i}").alias(f"s{i}") for i in range(_D)]
    sums += [F.sum(F.col(f"v{i}") * F.col(f"v{j}")).alias(f"s{i}{j}") for i, j in _PAIRS]
    names = [f"s{i}" for i in range(_D)] + [f"s{i}{j}" for i, j in _PAIRS]
    per = far.groupBy("g", "bin").agg(F.count("*").alias("c"), *sums)
    by = Window.partitionBy("g")
    per = (per.withColumn("h", F.ceil(F.sum("c").over(by) * SUBSET))
           .withColumn("before", F.sum("c").over(by.orderBy("bin")) - F.col("c"))
           .where("before < h")
           .withColumn("part", F.when(F.col("before") + F.col("c") > F.col("h"),
                                      (F.col("h") - F.col("before")) / F.col("c"))))
    # whole bins are added up exactly; the last bin, if it counts in part, is one row
    taken = [(F.coalesce(F.sum(F.when(F.col("part").isNull(), F.col(s).cast("decimal(20,0)"))).cast("double"), F.lit(0.0))
              + F.coalesce(F.max(F.when(F.col("part").isNotNull(), F.col(s).cast("double") * F.col("part"))), F.lit(0.0)))
             .alias(s) for s in names]
    group = per.groupBy("g").agg(F.max("h").cast("double").alias("h"), *taken)
    group = group.select("g", *[(F.col(f"s{i}") / F.col("h")).alias(f"m{i}") for i in range(_D)],
                         *[(F.col(f"s{i}{j}") / F.col("h")).alias(f"x{i}{j}") for i, j in _PAIRS])
    group = group.select("g", *[f"m{i}" for i in range(_D)], *[
        ((F.col(f"x{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}")) * CONSISTENCY
         + (float(GRAIN[i] ** 2) if i == j else 0.0)).alias(f"c{i}{j}") for i, j in _PAIRS])
    for i, j in _PAIRS:                            # Cholesky, row by row
        rest = F.col(f"c{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        # rounding cannot take a variance below the share that was added
        group = group.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(GRAIN[i] ** 2 / 4))) if i == j
                                 else rest / F.col(f"l{j}{j}"))
    return group.drop(*[f"c{i}{j}" for i, j in _PAIRS])


def _determinant(name: str) -> Column:
    det = F.col("l00")
    for i in range(1, _D):
        det = det * F.col(f"l{i}{i}")
    return det.alias(name)


def robust_estimates(rows: DataFrame, max_steps: int = MAX_STEPS) -> DataFrame:
    """(g, m0.., l00..): centre and Cholesky factor of the scatter of each
    group of ``rows`` (g, n_words, v0..), written."""
    now = materialize(_start(rows), "outlier-estimates")
    for step in range(max_steps):
        new = materialize(_concentrate(rows, now), "outlier-estimates")
        fell = (now.select("g", _determinant("old")).join(new.select("g", _determinant("new")), "g")
                .where(F.col("new") < F.col("old") * (1 - SETTLED)))
        now = new
        # the start is no subset's scatter: its determinant may be the smaller one
        if step and fell.isEmpty():
            break
    return now


def reject_outliers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    source_col: str = "source", min_group: int = MIN_GROUP) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, distance) of every document. ``distance`` is null for a
    document that fails the base rules or has no group to be held against."""
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"),
                       # as JSON a null differs from every text
                       F.to_json(F.struct(F.col(f"`{lang_col}`").cast("string").alias("a"),
                                          F.col(f"`{source_col}`").cast("string").alias("b"))).alias("g"))
    stats = materialize(text_statistics(rows, "_text").withColumn("base_failed", base_failed()), "outlier-statistics")
    good = stats.where(~F.col("base_failed")).select("g", "n_words", *_rates())
    large = materialize(good.groupBy("g").agg(F.count("*").alias("c")).where(F.col("c") >= min_group).select(
        "g", F.col("g").alias("own")), "outlier-groups")

    def grouped(df):
        return df.join(large, "g", "left").withColumn("g", F.coalesce("own", F.lit("the small groups"))).drop("own")

    good = materialize(grouped(good), "outlier-vectors")
    size = good.groupBy("g").agg(F.count("*").alias("c"))
    good = good.join(size.where(F.col("c") >= min_group).select("g"), "g", "left_semi")
    out = grouped(stats).join(robust_estimates(good), "g", "left")
    out = out.select("*", *_rates()).withColumn("distance", F.when(~F.col("base_failed"), F.sqrt(distance())))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") * F.col("distance") <= CUT, F.lit(True))
    return out.select(F.col("_id").alias(id_col), "n_words", *BASE, "base_failed", kept.alias("kept"), "distance")
