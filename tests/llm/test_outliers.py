"""Operator 11: statistics and verdicts against a plain implementation."""

import json
import math
import random
import re

import numpy as np
import pytest
from llm_helpers import DOC_SCHEMA

import __spark_entry__ as entry
from sieveflow.llm import outliers
from sieveflow.llm.outliers import BIN_GRID, BINS, CUT, GRAIN, GRID, SHORT_WORDS, SUBSET, reject_outliers

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def statistics(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count = {}
    for w in windows:
        count[w] = count.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def distances(x, n, centre, chol):
    y = np.zeros_like(x)
    for i in range(x.shape[1]):
        y[:, i] = (x[:, i] - centre[i] - y[:, :i] @ chol[i, :i]) / chol[i, i]
    return (y * y).sum(axis=1) * n / (n + SHORT_WORDS)


def start(x):
    quart = []
    for col in x.T:
        bins = np.sort(np.minimum(col // 16, BINS))
        quart.append([(bins[max(math.ceil(len(bins) * q) - 1, 0)] + 0.5) * 16 for q in (.25, .5, .75)])
    quart = np.array(quart)
    return quart[:, 1], np.diag(np.sqrt(((quart[:, 2] - quart[:, 0]) / 1.349) ** 2 + np.array(GRAIN) ** 2))


def concentrate(x, n, centre, chol):
    """The next estimates, from the documents in order of their bins."""
    freedom = x.shape[1]
    q = outliers.chi_squared_beyond(1 - SUBSET, freedom)
    factor = SUBSET / (1 - outliers.chi_squared_tail(q, freedom + 2))
    bins = np.minimum(np.floor(np.sqrt(distances(x, n, centre, chol)) * BIN_GRID), BINS)
    h, weight = math.ceil(len(x) * SUBSET), np.zeros(len(x))
    left = h
    for b in np.unique(bins):
        mine = bins == b
        weight[mine] = min(1.0, left / mine.sum())
        left = max(0, left - mine.sum())
    mean = weight @ x / h
    cov = (x.T * weight) @ x / h - np.outer(mean, mean)
    return mean, np.linalg.cholesky(cov * factor + np.diag(np.array(GRAIN, float) ** 2))


def estimates(groups):
    """(centre, factor) of each (vectors, words); steps until all have settled."""
    now = [start(x) for x, _ in groups]
    for step in range(outliers.MAX_STEPS):
        new = [concentrate(x, n, *e) for (x, n), e in zip(groups, now)]
        fell = any(np.prod(np.diag(b[1])) < np.prod(np.diag(a[1])) * (1 - outliers.SETTLED)
                   for a, b in zip(now, new))
        now = new
        if step and not fell:
            break
    return now


def brute(rows, min_group):
    """rows: (doc_id, text, lang, source)."""
    stats = [statistics(t) for _, t, _, _ in rows]
    failed = [s[0] < 10 or 100 * s[4] > 20 * s[0] for s in stats]
    groups = {}
    for i, r in enumerate(rows):
        if not failed[i]:
            groups.setdefault((r[2], r[3]), []).append(i)
    small = [i for g in groups.values() if len(g) < min_group for i in g]
    groups = [g for g in groups.values() if len(g) >= min_group] + ([small] if len(small) >= min_group else [])
    far, vectors = [None] * len(rows), []
    for g in groups:
        s = np.array([stats[i] for i in g], float)
        n = s[:, 0]
        rates = [s[:, 1] / n, s[:, 2] / s[:, 1], s[:, 3] / n, s[:, 4] / n]
        vectors.append((np.array([np.minimum(np.floor(np.sqrt(r) * k), 65535) for r, k in zip(rates, GRID)]).T, n))
    for g, (x, n), e in zip(groups, vectors, estimates(vectors)):
        for i, d in zip(g, distances(x, n, *e)):
            far[i] = d
    return [(r[0], *s, f, not f and (d is None or bool(d <= CUT)), None if d is None else round(math.sqrt(d), 6))
            for r, s, f, d in zip(rows, stats, failed, far)]


def same(df, rows, min_group):
    got = [(*r[:-1], r[-1] if r[-1] is None else round(r[-1], 6)) for r in
           map(tuple, reject_outliers(df, min_group=min_group).collect())]
    want = brute(rows, min_group)
    assert sorted(map(json.dumps, got)) == sorted(map(json.dumps, want))
    return want


def prose(rng, n, lang):
    size = {"en": 5, "de": 7}.get(lang, 6)
    words = [chr(97 + rng.randrange(26)) * max(1, int(rng.gauss(size, 2))) + str(rng.randrange(50)) for _ in range(n)]
    return "".join(w + rng.choice(["  ", " ", " ", "\n", "\t"]) for w in words)


def corpus(seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(600):
        lang, source = rng.choice(["en", "en", "de", None]), rng.choice(["a", "a", "b", None])
        rows.append((i, prose(rng, rng.choice([12, 40, 150, 300]), lang), lang, source))
    rows += [(1000 + i, rows[3][1], "en", "a") for i in range(250)]                     # copies
    rows += [(2000 + i, " ".join(f"<<<&&&%%%$$${k}###" for k in range(60)) + prose(rng, 200, "en"), "en", "a") for i in range(4)]
    rows += [(3000 + i, ("the very same line of words %d\n" % i) * 30, "en", "a") for i in range(4)]
    rows += [(3100 + i, "".join(f"{w} x y\n" * 2 for w in range(60)) + prose(rng, 60, "en"), "en", "a") for i in range(3)]
    rows += [(4000, None, "en", "a"), (4001, "", None, None), (4002, " \n \t", "en", "a"), (4003, "one two", "fr", "z"),
             (None, prose(rng, 100, "en"), "en", "a"), (4004, prose(rng, 30_000, "en"), "en", "a"),
             (4005, "x" * 50_000 + " " + prose(rng, 20, "en"), "en", "a"), (4004, "word é\x85\xa0 word " * 3, "en", "a")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, 0) for i, t, lang, s in rows], DOC_SCHEMA).selectExpr(
        "*", "'mine' AS g", "1 AS v0", "2 AS n_words", "'x' AS _words", "true AS kept")


def test_verdicts_equal_brute_force(spark):
    rows = corpus()
    want = same(frame(spark, rows), rows, min_group=40)
    out = {r[0] for r in want if not r[6] and not r[7]}
    assert {2000, 2001, 2002, 2003, 4005} <= out and not any(i is not None and i < 2000 for i in out)
    assert all(r[6] for r in want if r[0] is not None and 3000 <= r[0] < 3004)


def test_small_groups_and_empty_table(spark):
    rows = corpus(1)[:60] + [(99, "# " * 40 + "a b c d e f g h i j k l", "en", "q")]
    same(frame(spark, rows), rows, min_group=45)                # estimated together
    assert all(r[7] for r in same(frame(spark, rows), rows, min_group=1000) if not r[6])
    assert reject_outliers(frame(spark, rows).limit(0)).collect() == []


@pytest.mark.parametrize("text", ["a b c d e " * 2, "a a a a a a a", "a b c d e f a b c d e x a b c d e", "x " * 4,
                                  "a b\na b\n\na b\n \n \n", "", "p q r s t u v w x y z"])
def test_statistics(spark, text):
    df = spark.createDataFrame([(text,)], "text string")
    got = outliers.text_statistics(df).first()
    assert tuple(got) == statistics(text)


def test_chi_squared():
    assert outliers.chi_squared_beyond(0.05, 4) == pytest.approx(9.4877, abs=1e-3)
    assert outliers.chi_squared_beyond(0.25, 4) == pytest.approx(5.3853, abs=1e-3)


def test_query_equals_brute_force_without_python_workers(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet")
            .select("doc_id", "text", "lang", "source").collect()]
    df = entry.queries()["op11_quality_outliers"](spark, sf)
    assert df.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                          "base_failed", "kept"]
    assert sorted(map(tuple, df.collect())) == sorted(r[:-1] for r in brute(rows, outliers.MIN_GROUP))
    assert "Python" not in df._jdf.queryExecution().toString()
