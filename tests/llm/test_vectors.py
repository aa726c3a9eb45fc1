"""Operators 4 and 6: links and nearest neighbours of embeddings."""

import numpy as np
import pytest
from llm_helpers import components
from pyspark.sql import functions as F

from sieveflow.llm import ann, rangejoin
from sieveflow.llm.ann import nearest
from sieveflow.llm.rangejoin import vector_components

SCHEMA = "vec_id long, embedding array<float>, label int"


def rows_of(n=260, dim=24, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    out = []
    for i in range(n):
        if i % 3 == 0:
            v = centres[0] + rng.normal(size=dim) * 0.09     # a third is one loose group
        elif i % 5 == 0:
            v = centres[1]                                   # exact copies
        else:
            v = centres[rng.integers(12)] + rng.normal(size=dim) * rng.choice([0.02, 0.12, 1])
        out.append((i, [float(np.float32(x)) for x in v * rng.uniform(0.5, 2)], int(i % 2) if i % 11 else None))
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [0.0] * dim, [nan] + [1.0] * (dim - 1), [inf] + [1.0] * (dim - 1), [None] + [1.0] * (dim - 1)]
    out += [(1_000 + i, v, 1) for i, v in enumerate(bad)]
    out += [(2_000, [1.0, 2.0], 1), (2_020, [1.0, 2.0], 1), (None, out[1][1], 1), (1, out[1][1], 1)]
    return out


def good(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)


def table(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("gid", "n", "cell", "score", "rank", "id", "vec", "dim", "kept"):
        df = df.withColumn(c, F.lit("mine"))
    return df


def linked(a, b):
    if a[2] is None or a[2] != b[2] or not good(a[1]) or not good(b[1]) or len(a[1]) != len(b[1]):
        return False
    x, y = np.array(a[1]), np.array(b[1])
    return x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98


@pytest.mark.parametrize("cell,block", [(1_024, 4_096), (20, 4_096), (20, 7), (1, 3)])
def test_links_equal_brute_force(spark, monkeypatch, cell, block):
    monkeypatch.setattr(rangejoin, "CELL_ROWS", cell)
    monkeypatch.setattr(rangejoin, "BLOCK_ROWS", block)
    rows = rows_of()
    comp = components(rows, linked)
    least = {}
    for r, c in zip(rows, comp):
        if r[0] is not None:
            least[c] = min(r[0], least.get(c, r[0]))
    want = [(r[0], sum(linked(r, s) for j, s in enumerate(rows) if j != i), least.get(c), r[0] is not None and r[0] == least.get(c))
            for i, (r, c) in enumerate(zip(rows, comp))]
    out = vector_components(table(spark, rows))
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted(want, key=str)


def test_replication_holds_every_partner():
    rng = np.random.default_rng(3)
    import pyarrow as pa

    x = rng.normal(size=(400, 8))
    x[200:] = x[:200] + rng.normal(size=(200, 8)) * 0.15
    pivots = rangejoin._unit(rng.normal(size=(30, 8)))
    reach = np.sqrt(2 - 2 * 0.98)
    t = pa.table({"vec": [v.tolist() for v in x]})
    row, cell, home = rangejoin._placed(t, pivots, reach)
    places = {i: set(cell[row == i]) for i in range(400)}
    own = {i: int(cell[(row == i) & home][0]) for i in range(400)}
    u = rangejoin._unit(x)
    for i, j in zip(*np.nonzero(u @ u.T >= 0.98)):
        assert own[i] in places[j]
    assert len(row) < 400 * 30     # not everything everywhere


def test_many_pivots_take_bounded_memory():
    """As many pivots as there can be: no table of pivots by pivots."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(6)
    pivots = rangejoin._unit(rng.normal(size=(rangejoin.MAX_PIVOTS, 64)))
    rows = rangejoin._slice_rows(pivots)
    t = pa.table({"vec": list(rng.normal(size=(rows, 64)))})
    tracemalloc.start()
    row, _, home = rangejoin._placed(t, pivots, np.sqrt(2 - 2 * 0.98))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows >= 200 and home.sum() == rows and set(row) == set(range(rows))
    assert peak < 500e6, peak


def test_no_vectors(spark):
    empty = table(spark, rows_of(3)).limit(0)
    assert vector_components(empty).count() == 0
    assert nearest(empty, F.col("vec_id") % 20 == 0).count() == 0


def brute_nearest(rows, k):
    rows = [r for r in {(r[0], tuple(r[1])) for r in rows if r[0] is not None and good(r[1])}]
    out = []
    for q in rows:
        if q[0] % 20 == 0:
            scored = []
            for c in rows:
                if c[0] != q[0] and len(c[1]) == len(q[1]):
                    s = 0.0
                    for a, b in zip(q[1], c[1]):
                        s += a * b
                    scored.append((-s, c[0]))
            out += [(q[0], n, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block,queries", [(16_384, 4_096), (40, 3)])
def test_nearest_recall_and_scores(spark, monkeypatch, block, queries):
    monkeypatch.setattr(ann, "BLOCK_ROWS", block)
    monkeypatch.setattr(ann, "QUERY_ROWS", queries)
    rows = rows_of()
    got = sorted(tuple(r) for r in nearest(table(spark, rows), F.col("vec_id") % 20 == 0, k=20).collect())
    want = brute_nearest(rows, 20)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    found = {(g[0], g[2]): g[3] for g in got}
    hits = [w for w in want if (w[0], w[2]) in found]
    assert len(hits) >= 0.99 * len(want) and all(found[w[0], w[2]] == w[3] for w in hits)


def test_codes_bound_the_inner_product():
    rng = np.random.default_rng(5)
    x, q = rng.normal(size=(2_000, 64)), rng.normal(size=64)
    turn, centre = ann.rotation(64), x.mean(axis=0)
    assert np.allclose(turn @ turn.T, np.eye(64))
    bits, size, fit = ann.codes(x, centre, turn)
    assert bits.shape == (2_000, 8)
    signs = np.unpackbits(bits, axis=1).astype(float) * 2 - 1
    guess = q @ centre + size * (signs @ (q @ turn) / 8) / fit
    wide = size * np.linalg.norm(q) * np.sqrt((1 - fit ** 2) / fit ** 2 / 63)
    error = np.abs(guess - x @ q)
    assert (error <= ann.EPSILON * wide).mean() > 0.97 and abs((guess - x @ q).mean()) < 0.1 * error.std()


@pytest.mark.parametrize("kind", ["gaussian", "clustered"])
def test_recall_where_the_codes_prune(kind):
    """20,000 vectors, 1,000 queries: most pairs are never scored exactly, and
    nearly all of the nearest are found."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(20_000, 64))
    if kind == "clustered":
        x = rng.normal(size=(200, 64))[rng.integers(0, 200, 20_000)] + 0.5 * x
    ids, k = np.arange(len(x)), 20
    q = x[::20]
    centre = x[:4000].mean(axis=0)
    bits, size, fit = ann.codes(x, centre, ann.rotation(64))
    pairs = []
    row, score, found = ann.search_block(ids[::20], q, ids, x, bits, size, fit, centre, k, ann.EPSILON, pairs)
    full = q @ x.T
    full[np.arange(len(q)), ids[::20]] = -np.inf
    want = np.argsort(-full, axis=1)[:, :k]
    got = {(r, i) for r, i in zip(row.tolist(), found.tolist())}
    recall = np.mean([(r, i) in got for r in range(len(q)) for i in want[r].tolist()])
    assert np.bincount(row, minlength=len(q)).tolist() == [k] * len(q)
    assert np.allclose(score, full[row, found])
    assert recall >= 0.99 and sum(pairs) < 0.3 * full.size, (recall, sum(pairs) / full.size)
