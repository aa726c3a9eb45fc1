"""Operator 13 against all pairs of words in plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest
from llm_helpers import docs_of

from sieveflow.llm import spelling
from sieveflow.llm.spelling import SortedWords, near_words, one_edit, spelling_groups

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def distance_is_one(a, b):
    """The whole edit matrix."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j - 1] + (x != y), old[j] + 1, row[j - 1] + 1))
    return row[-1] == 1


def brute(rows):
    n = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and distance_is_one(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def random_words(rng, count):
    words = set()
    while len(words) < count:
        w = "".join(rng.choice(["an", "the", "ion", "é", "ba", "a", "ÿ"]) for _ in range(rng.randint(3, 6)))
        words.add(w)
        for _ in range(rng.randint(0, 3)):
            at, c = rng.randrange(len(w)), rng.choice("abnté")
            words.add(rng.choice([w[:at] + w[at + 1:], w[:at] + c + w[at:], w[:at] + c + w[at + 1:]]))
    return sorted(w for w in words if len(w) >= 7)


@pytest.mark.parametrize("seed", range(4))
def test_walk_equals_all_pairs(seed):
    rng = random.Random(seed)
    words = random_words(rng, 500)
    long = "ab" * 60
    words = sorted({*words, long, long + "c", long[:-1], "c" + long, long[:80] + "x" + long[81:], "abababab"})
    halves = [len(w) // 2 for w in words]
    row, near = SortedWords(words).near(words, halves)
    want = {(i, j) for i, a in enumerate(words) for j, b in enumerate(words)
            if abs(len(a) - len(b)) < 2 and a[:halves[i]] == b[:halves[i]] and distance_is_one(a, b)}
    assert len(want) > 150
    assert sorted(zip(row, near)) == sorted(want)


def test_one_edit():
    rng = random.Random(7)
    for _ in range(3000):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randint(0, 6))) for _ in range(2))
        assert one_edit(a, b) == distance_is_one(a, b), (a, b)


def test_groups_equal_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    words = random_words(rng, 150)
    rows = [(i, " ".join(rng.choice(words[:60] if i % 3 else words).upper() if rng.random() < .1 else
                         rng.choice(words) for _ in range(60))) for i in range(60)]
    rows += [(1000 + i, "Wonderful1wonderful, wonderful\twonderfully") for i in range(300)]
    rows += [(None, "wonderful wondrful"), (5, None), (6, ""), (6, ""), (7, "wonderfvl " * 40 + "wonderfvxl " * 3)]
    rows += [(8, "z" * 300 + " " + "z" * 300 + " " + "z" * 301 + " " + "z" * 301)]
    df = docs_of(spark, [(i, t, "s") for i, t in rows], extra=True)
    want = brute(rows)
    assert any(f is not None for _, f, *_ in want) and any(f is not None and f != r for _, f, r, *_ in want)
    got = [tuple(r) for r in spelling_groups(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    # small blocks and groups: ranges that span blocks, blocks that are visited by several groups
    whole = near_words
    monkeypatch.setattr(spelling, "near_words", lambda v: whole(v, block_words=20, visits=7))
    assert {tuple(r) for r in spelling_groups(df).collect()} == want


def test_empty_table(spark):
    df = docs_of(spark, [(1, "a few short words", "s")])
    assert spelling_groups(df).collect() == [] and spelling_groups(df.limit(0)).collect() == []


def test_query_equals_brute_force(spark, tmp_path):
    import __spark_entry__ as entry

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{tmp_path}/documents.parquet").collect()]
    got = entry.queries()["op13_spelling_groups"](spark, str(tmp_path))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == brute(rows)
