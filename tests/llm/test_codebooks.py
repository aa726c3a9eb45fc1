"""Operator 12: trees against all distances, codes against a plain loop."""

import hashlib
import math
import random

import numpy as np
import pytest

from sieveflow.llm.codebooks import BallTree, anchors, nearest, vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, entries=256, parts=4, rounds=4):
    """rows: (vec_id, vector, label); all distances in Python integers."""
    good = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    good.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    if not good:
        return []
    dim = len(good[0][1])
    good = [r for r in good if len(r[1]) == dim]
    vecs = [[math.floor(1024 * x) for x in r[1]] for r in good]
    cut = [(i * dim // parts, (i + 1) * dim // parts) for i in range(parts)]
    books = [[v[a:b] for v in vecs[:entries]] for a, b in cut]

    def best(v, book):
        return min((sum((x - y) ** 2 for x, y in zip(v, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p, (a, b) in enumerate(cut):
            own = [best(v[a:b], books[p])[1] for v in vecs]
            for e in range(len(books[p])):
                mine = [v[a:b] for v, o in zip(vecs, own) if o == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    ends = [[best(v[a:b], books[p]) for p, (a, b) in enumerate(cut)] for v in vecs]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    error = [sum(d for d, _ in e) for e in ends]
    total = {}
    for r, e in zip(good, error):
        total[r[2]] = total.get(r[2], 0) + e
    top = 2 ** 63 - 1
    return sorted(((r[0], "".join(f"{i:02x}" for _, i in e), min(err, top), min(total[r[2]], top), digest)
                   for r, e, err in zip(good, ends, error)), key=repr)


def points_of(seed, n, dim):
    rng = np.random.default_rng(seed)
    x = np.floor(rng.normal(size=(n, dim)) * 100 + rng.integers(0, 5, size=(n, 1)) * 300)
    x[n // 3:n // 2] = x[0]                         # a group of copies
    return x


@pytest.mark.parametrize("seed,n,dim", [(0, 1, 3), (1, 30, 2), (2, 700, 8), (3, 3000, 16), (4, 500, 1)])
def test_tree_owns_what_all_distances_own(seed, n, dim):
    x = points_of(seed, n, dim)
    tree = BallTree(x)
    assert sorted(tree.order) == list(range(n)) and (tree.points == x[tree.order]).all()
    for a, b, c, r, k in zip(tree.start, tree.end, tree.centre, tree.radius, tree.kids):
        assert np.sqrt(((tree.points[a:b] - c) ** 2).sum(axis=1)).max() <= r
        assert (k < 0).all() or {(tree.start[k[0]], tree.end[k[0]]), (tree.start[k[1]], tree.end[k[1]])} >= {
            (a, tree.end[k[0]] if tree.start[k[0]] == a else tree.end[k[1]])}
    book = np.concatenate([x[:40], x[:3]]).astype(np.int64)
    owned, own = nearest(tree, book)
    for e, ball in owned:
        assert (own[tree.start[ball]:tree.end[ball]] == -1).all()
        own[tree.start[ball]:tree.end[ball]] = e
    far = ((tree.points[:, None] - book[None]) ** 2).sum(axis=2)
    assert (own == far.argmin(axis=1)).all()


def test_balls_are_owned_whole_on_clustered_points():
    rng = np.random.default_rng(1)
    centres = rng.integers(-5000, 5000, size=(20, 8))
    x = (centres[rng.integers(0, 20, 4000)] + rng.integers(-20, 20, size=(4000, 8))).astype(float)
    owned, own = nearest(BallTree(x), centres.astype(np.int64))
    assert (own == -1).all() and len(owned) < 400


def test_anchors_hold_the_nearest_points():
    x = points_of(9, 400, 4)
    groups = anchors(x, np.arange(400), 20)
    assert sorted(np.concatenate(groups)) == list(range(400)) and 2 <= len(groups) <= 20


def table_rows(seed=0):
    rng = random.Random(seed)
    seeds = [[rng.uniform(-1, 1) for _ in range(10)] for _ in range(12)]
    rows = [(i, [x + rng.gauss(0, .05) for x in rng.choice(seeds)], rng.choice([0, 1, 2, None])) for i in range(400)]
    rows += [(500 + i, rows[3][1], 1) for i in range(150)]             # copies
    rows += [(3, rows[3][1], 1), (3, rows[4][1], None), (None, rows[5][1], 0)]
    rows += [(700, None, 1), (701, [None] * 10, 1), (702, [float("nan")] * 10, 1), (703, [float("inf")] * 10, 1),
             (704, [0.0] * 10, 2), (705, [1.0] * 9, 2), (706, [], 2)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("scale", [1, 1e6, 1e35])
def test_codes_equal_brute_force(spark, scale):
    """Ties, copies, nulls, odd rows; whole numbers beyond 64 bits."""
    rows = [(i, v if v is None else [x if x is None else x * scale for x in v], label)
            for i, v, label in table_rows()]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'mine' AS code", "'mine' AS id", "1 AS n", "2 AS entry")
    got = sorted(map(tuple, vector_codes(df.repartition(5), entries=20, block_rows=64).collect()), key=repr)
    assert got == brute(rows, entries=20)


def test_few_rows_and_empty_table(spark):
    rows = [(2, [0.5, -0.25, 0.125], None), (1, [0.5, -0.25, 0.1], None)]
    got = sorted(map(tuple, vector_codes(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == brute(rows)
    for odd in ([], [(1, None, 2)]):
        assert vector_codes(spark.createDataFrame(odd, SCHEMA)).collect() == []
    rows = [(1, [], 1), (2, [], 1)]
    got = sorted(map(tuple, vector_codes(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == brute(rows)
