"""Operator 12: vector codes from codebooks that are refined over metric trees.

After Moore, "The Anchors Hierarchy: Using the Triangle Inequality to Survive
High Dimensional Data" (UAI 2000). Vectors are cut into parts. For each block
of vectors and each part a tree of balls is built once, middle-out: about
sqrt(n) anchors take the points that are nearest to them (the triangle
inequality spares most distances), anchors are merged upwards into the root
and split downwards in the same way. Every ball caches the count and the sum of
its points. The trees are written; each round of refinement walks them with the
codebook. A ball inherits its parent's list of candidate entries and strikes
those that cannot be nearest to any of its points: with centre c and radius r,
entry e loses to entry b when ``|c-e|^2 - |c-b|^2 > 2 r |e-b|``. When one entry
is left the ball is owned wholly and its cached sum and count are added; only
in leaves are distances computed, in whole numbers.

Scale: a block holds up to ``BLOCK_ROWS`` vectors; a task adds up its blocks
and returns one sum per part, entry and component, which Spark adds up over all
tasks. The driver sees ``entries * components`` numbers a round, the codebooks.

Nulls, ties and odd rows: rows whose vector is null, or has a null or
non-finite component, are dropped; so are vectors of another length than that of
the smallest id, which no codebook fits. The first entries are the vectors of
the smallest ids (null ids last, equal ids by vector); fewer vectors give fewer
entries. Equal distances go to the lower entry. Repeated rows each count. A
length that is no multiple of the parts is cut at ``i * length // parts``. An
empty table gives an empty result. Whole numbers are exact at any size (Python
integers beyond 64 bits; components beyond 2**140, which no single-precision
value reaches, are taken as that); an error beyond 64 bits is given as the
largest long. Only the three named columns are read, whatever else there is.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveflow.llm.vectors import matrix
from sieveflow.session import materialize

#: vectors of a block, at most; and its components, at most
BLOCK_ROWS = 8_192
BLOCK_VALUES = 4_194_304
#: points of a ball that is not split further
LEAF = 24
#: whole numbers beyond a long are added up in pieces of this many bits
_BITS = 40
_PIECES = 4
_LARGEST = float(2 ** 140)
_LONG = 2 ** 63 - 1


def finite(vec: Column) -> Column:
    """True for a vector without null and non-finite components."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(~bad, F.lit(False))


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): whole numbers, kept as doubles."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(x * scale), -_LARGEST, _LARGEST)


def exact(x: np.ndarray, reach: float) -> np.ndarray:
    """Doubles that are whole numbers as 64-bit integers, or as Python integers
    where squared distances up to ``reach`` a component would not fit."""
    if x.shape[1] * (2 * reach + 2) ** 2 < 2.0 ** 60:
        return x.astype(np.int64)
    out = np.empty(x.shape, object)
    out[...] = [[int(v) for v in row] for row in x]
    return out


# -- the tree -------------------------------------------------------------------

def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def anchors(points: np.ndarray, members: np.ndarray, count: int) -> list[np.ndarray]:
    """``members`` dealt to up to ``count`` anchors, each point to the nearest.
    An anchor's points are sorted by distance, farthest first: a new anchor at
    distance d can only take points at d / 2 or more."""
    far = _norms(points[members] - points[members[0]])
    order = np.argsort(-far, kind="stable")
    pivots, owned, dists = [members[0]], [members[order]], [far[order]]
    while len(pivots) < count:
        widest = max(range(len(pivots)), key=lambda a: dists[a][0] if len(dists[a]) else 0.0)
        if not len(dists[widest]) or dists[widest][0] == 0:
            break
        pivot = owned[widest][0]
        gaps = _norms(points[np.array(pivots)] - points[pivot])
        taken, taken_far = [], []
        for a, gap in enumerate(gaps):
            upto = np.searchsorted(-dists[a], -gap / 2, side="right")
            if upto:
                new = _norms(points[owned[a][:upto]] - points[pivot])
                closer = np.flatnonzero(new < dists[a][:upto])
                if len(closer):
                    taken.append(owned[a][closer])
                    taken_far.append(new[closer])
                    owned[a], dists[a] = np.delete(owned[a], closer), np.delete(dists[a], closer)
        took, took_far = np.concatenate(taken), np.concatenate(taken_far)
        order = np.argsort(-took_far, kind="stable")
        pivots.append(pivot)
        owned.append(took[order])
        dists.append(took_far[order])
    return [o for o in owned if len(o)]


class BallTree:
    """Balls over the points of one part; ball 0 is the root. ``start`` and
    ``end`` bound a ball's points in ``points``, whose rows are in tree order
    (``order`` gives their place in the block)."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self._leaf, self._children, self._members = leaf, [], []
        root = self._grow(points, np.arange(len(points)))
        self._lay_out(points, root)
        del self._children, self._members

    def _node(self, members, children=()) -> int:
        self._members.append(members)
        self._children.append(children)
        return len(self._members) - 1

    def _grow(self, points: np.ndarray, members: np.ndarray) -> int:
        """Middle-out: anchors, below each its own tree, above them the merges."""
        if len(members) <= self._leaf:
            return self._node(members)
        groups = anchors(points, members, max(2, int(len(members) ** 0.5)))
        if len(groups) == 1:                       # equal points
            return self._node(members)
        roots = [self._grow(points, g) for g in groups]
        centre = np.array([points[g].mean(axis=0) for g in groups])
        radius = np.array([_norms(points[g] - c).max() for g, c in zip(groups, centre)])
        count = np.array([float(len(g)) for g in groups])
        while len(roots) > 1:
            # the pair with the smallest ball around both
            gap = np.sqrt(np.maximum(((centre[:, None] - centre[None]) ** 2).sum(axis=2), 0))
            ball = np.maximum((gap + radius[:, None] + radius[None]) / 2, np.maximum(radius[:, None], radius[None]))
            np.fill_diagonal(ball, np.inf)
            i, j = divmod(int(np.argmin(ball)), len(roots))
            roots[i] = self._node(None, (roots[i], roots[j]))
            centre[i] = (centre[i] * count[i] + centre[j] * count[j]) / (count[i] + count[j])
            radius[i], count[i] = ball[i, j], count[i] + count[j]
            del roots[j]
            centre, radius, count = (np.delete(x, j, axis=0) for x in (centre, radius, count))
        return roots[0]

    def _lay_out(self, points: np.ndarray, root: int) -> None:
        order, start, end, kids, at = [], [], [], [], 0
        stack = [(root, -1, 0)]
        while stack:
            node, parent, side = stack.pop()
            if node < 0:                           # all below this ball is placed
                end[parent] = at
                continue
            me = len(start)
            if parent >= 0:
                kids[parent][side] = me
            start.append(at)
            end.append(at)
            kids.append([-1, -1])
            if self._children[node]:
                stack.append((-1, me, 0))
                stack.extend((c, me, s) for s, c in enumerate(self._children[node]))
            else:
                order.append(self._members[node])
                at += len(self._members[node])
                end[me] = at
        self.order = np.concatenate(order)
        self.points = points[self.order]
        self.start, self.end, self.kids = np.array(start), np.array(end), np.array(kids)
        self.centre = np.array([self.points[a:b].mean(axis=0) for a, b in zip(start, end)])
        self.radius = np.array([_norms(self.points[a:b] - c).max() for a, b, c in zip(start, end, self.centre)])
        self.sums = None

    # a tree as bytes

    def dump(self) -> dict[str, np.ndarray]:
        top = float(np.abs(self.points).max(initial=0))
        kind = next((k for k, m in ((np.int16, 2.0 ** 15), (np.int32, 2.0 ** 31)) if top < m), np.float64)
        out = {"order": self.order.astype(np.int32), "points": self.points.astype(kind),
               "start": self.start.astype(np.int32), "end": self.end.astype(np.int32),
               "kids": self.kids.astype(np.int32), "centre": self.centre, "radius": self.radius}
        if kind is not np.float64:                 # sums that fit into a long are cached
            upto = np.zeros((len(self.points) + 1, self.points.shape[1]), np.int64)
            np.cumsum(self.points.astype(np.int64), axis=0, out=upto[1:])
            out["sums"] = upto[self.end] - upto[self.start]
        return out

    @staticmethod
    def load(data) -> "BallTree":
        tree = BallTree.__new__(BallTree)
        for name in ("order", "start", "end", "kids", "centre", "radius"):
            setattr(tree, name, data[name])
        tree.points = data["points"].astype(np.float64)
        tree.sums = data.get("sums")
        return tree


def nearest(tree: BallTree, book: np.ndarray) -> tuple[list, np.ndarray]:
    """What each entry of ``book`` owns: (entry, ball) pairs for balls that
    are owned wholly, and the entry of every point of the other balls (-1 for
    the points of owned ones)."""
    if not book.shape[1]:
        return [(0, 0)], np.full(len(tree.points), -1)
    reach = max(float(np.abs(tree.points).max(initial=0)), max(abs(float(v)) for v in book.flat))
    near = book.astype(np.float64)
    points, entries = exact(tree.points, reach), (book.astype(np.int64) if abs(reach) < 2.0 ** 62 else book)
    if points.dtype == object:
        entries = book
    between = np.sqrt(((near[:, None] - near[None]) ** 2).sum(axis=2))
    first = {}                                     # equal entries: only the lowest can win
    for e, row in enumerate(book.tolist()):
        first.setdefault(tuple(row), e)
    owned, own = [], np.full(len(points), -1)
    stack = [(0, np.array(sorted(first.values())))]
    while stack:
        ball, some = stack.pop()
        far = ((near[some] - tree.centre[ball]) ** 2).sum(axis=1)
        best = int(np.argmin(far))
        span = 2 * tree.radius[ball] * between[some, some[best]]
        # an entry is struck only beyond the rounding of these doubles
        some = some[~(far - far[best] - span > 1e-9 * (far + far[best] + span))]
        if len(some) == 1:
            owned.append((int(some[0]), ball))
        elif tree.kids[ball, 0] < 0:
            part = slice(tree.start[ball], tree.end[ball])
            d = ((points[part, None, :] - entries[some][None]) ** 2).sum(axis=2)
            own[part] = some[np.argmin(d, axis=1)]
        else:
            stack.extend((int(k), some) for k in tree.kids[ball])
    return owned, own


# -- over all blocks ------------------------------------------------------------

def _cuts(dim: int, parts: int) -> list[slice]:
    return [slice(i * dim // parts, (i + 1) * dim // parts) for i in range(parts)]


def build_trees(vecs: DataFrame, dim: int, parts: int, scale: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(ids, labels, trees), a row for each block of ``vecs`` (id, label, vec), written."""
    rows = max(1, min(block_rows, BLOCK_VALUES // max(dim, 1)))

    def block(table: pa.Table) -> pa.RecordBatch:
        x = whole(matrix(table["vec"]) if dim else np.zeros((len(table), 0)), scale)
        files = {f"{p}/{k}": v for p, cut in enumerate(_cuts(dim, parts))
                 for k, v in BallTree(x[:, cut]).dump().items()}
        out = io.BytesIO()
        np.savez(out, **files)
        one = lambda c: pa.ListArray.from_arrays(pa.array([0, len(table)], pa.int32()),
                                                 table[c].combine_chunks())
        return pa.RecordBatch.from_arrays([one("id"), one("label"), pa.array([out.getvalue()], pa.binary())],
                                          ["ids", "labels", "trees"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held, n = [*held, batch], n + batch.num_rows
            while n >= rows:
                table = pa.Table.from_batches(held)
                yield block(table.slice(0, rows))
                held, n = table.slice(rows).to_batches(), n - rows
        if n:
            yield block(pa.Table.from_batches(held))

    kind = {f.name: f.dataType.simpleString() for f in vecs.schema}
    return materialize(vecs.select("id", "label", "vec").mapInArrow(
        build, f"ids array<{kind['id']}>, labels array<{kind['label']}>, trees binary"), "codebook-trees")


def _load(trees: bytes, parts: int) -> list[BallTree]:
    with np.load(io.BytesIO(trees)) as data:
        held = {k: data[k] for k in data.files}
    return [BallTree.load({k.split("/")[1]: v for k, v in held.items() if k.startswith(f"{p}/")})
            for p in range(parts)]


def _pieces(x: np.ndarray) -> list[np.ndarray]:
    """Python integers as longs of ``_BITS`` bits each, the last one signed."""
    low = (1 << _BITS) - 1
    return [np.array([(v >> (_BITS * i)) & low for v in x], np.int64) for i in range(_PIECES - 1)] + [
        np.array([v >> (_BITS * (_PIECES - 1)) for v in x], np.int64)]


def _sums(trees: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(part, entry, pos, n, s0..): the count and the sums of each entry's points."""
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(b.shape, object) for b in books]
        count = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            for data in batch["trees"]:
                for tree, book, t, n in zip(_load(data.as_py(), len(books)), books, total, count):
                    owned, own = nearest(tree, book)
                    loose = own >= 0
                    n += np.bincount(own[loose], minlength=len(book))
                    points = tree.points[loose]
                    if tree.sums is not None:
                        here, points = np.zeros(book.shape, np.int64), points.astype(np.int64)
                    else:
                        here, points = np.zeros(book.shape, object), exact(points, np.inf)
                    np.add.at(here, own[loose], points)
                    for e, ball in owned:
                        a, b = tree.start[ball], tree.end[ball]
                        n[e] += b - a
                        here[e] += (tree.sums[ball] if tree.sums is not None
                                    else exact(tree.points[a:b], np.inf).sum(axis=0))
                    t += here.astype(object)
        for p, (t, n) in enumerate(zip(total, count)):
            entry, pos = np.nonzero(np.broadcast_to(n[:, None] > 0, t.shape))
            if len(entry):
                pieces = _pieces(t[entry, pos])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(entry), p, np.int32)), pa.array(entry.astype(np.int32)),
                     pa.array(pos.astype(np.int32)), pa.array(n[entry]), *map(pa.array, pieces)],
                    ["part", "entry", "pos", "n", *[f"s{i}" for i in range(_PIECES)]])

    cols = [f"s{i}" for i in range(_PIECES)]
    rows = trees.select("trees").mapInArrow(add_up, "part int, entry int, pos int, n long, "
                                            + ", ".join(f"{c} long" for c in cols))
    return rows.groupBy("part", "entry", "pos").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in cols])


def refine(trees: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """One round: every entry becomes the floored mean of the points it is
    nearest to; entries without points stay."""
    out = [b.copy() for b in books]
    # entries * components rows: as many numbers as the codebooks hold
    for r in _sums(trees, books).collect():
        total = sum(r[f"s{i}"] << (_BITS * i) for i in range(_PIECES))
        out[r["part"]][r["entry"], r["pos"]] = total // r["n"]
    return out


def _encode(trees: DataFrame, books: list[np.ndarray], id_type: str, label_type: str) -> DataFrame:
    """(id, label, code, error) of every vector."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data in enumerate(batch["trees"]):
                code, error = [], 0
                for tree, book in zip(_load(data.as_py(), len(books)), books):
                    owned, own = nearest(tree, book)
                    for e, ball in owned:
                        own[tree.start[ball]:tree.end[ball]] = e
                    far = np.zeros(len(own), np.int64)
                    if book.shape[1]:
                        reach = max(float(np.abs(tree.points).max(initial=0)), max(abs(float(v)) for v in book.flat))
                        points = exact(tree.points, reach)
                        far = ((points - book.astype(points.dtype)[own]) ** 2).sum(axis=1)
                    back = np.empty(len(own), np.int64)
                    back[tree.order] = np.arange(len(own))
                    code.append(own[back])
                    error = error + far[back]
                yield pa.RecordBatch.from_arrays(
                    [batch["ids"][i].values, batch["labels"][i].values,
                     pa.array(["".join(f"{c:02x}" for c in row) for row in zip(*code)], pa.string()),
                     pa.array([min(int(e), _LONG) for e in error], pa.int64())], ["id", "label", "code", "error"])

    return trees.mapInArrow(encode, f"id {id_type}, label {label_type}, code string, error long")


def vector_codes(table: DataFrame, entries: int = 256, parts: int = 4, rounds: int = 4, scale: int = 1024,
                 id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                 block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every kept vector."""
    vecs = table.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"),
                        F.col(f"`{vec_col}`").alias("vec")).where(finite(F.col("vec")))
    by_id = [F.asc_nulls_last("id"), F.asc("vec")]
    first = vecs.orderBy(*by_id).limit(1).collect()
    dim = len(first[0]["vec"]) if first else 0
    vecs = vecs.where(F.size("vec") == dim)
    start = [r["vec"] for r in vecs.orderBy(*by_id).limit(entries).select("vec").collect()]
    ints = np.empty((len(start), dim), object)
    ints[...] = [[int(v) for v in row] for row in whole(np.array(start, np.float64).reshape(len(start), dim), scale)]
    books = [ints[:, cut] for cut in _cuts(dim, parts)]
    kind = {f.name: f.dataType.simpleString() for f in vecs.schema}
    if not start:
        empty = table.sparkSession.createDataFrame(
            [], f"`{id_col}` {kind['id']}, code string, error long, label_error long, codebooks_sha256 string")
        return empty
    trees = build_trees(vecs, dim, parts, scale, block_rows)
    for _ in range(rounds):
        books = refine(trees, books)
    digest = hashlib.sha256(",".join(str(v) for b in books for v in b.flat).encode()).hexdigest()
    codes = materialize(_encode(trees, books, kind["id"], kind["label"]), "vector-codes")
    by_label = codes.groupBy(F.col("label").alias("its_label")).agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONG)).cast("long").alias("label_error"))
    return (codes.join(by_label, F.col("label").eqNullSafe(F.col("its_label")))
            .select(F.col("id").alias(id_col), "code", "error", "label_error",
                    F.lit(digest).alias("codebooks_sha256")))
