"""Operator 4: embedding near-duplicates by an exact metric range join.

Vectors of one label are compared by cosine in double precision; a cosine of
at least ``threshold`` is a distance of at most r = sqrt(2 - 2 threshold)
between the unit vectors.

1. Equal vectors of a label collapse to one row with its count.
2. Pivots (a hash sample of the label's vectors, about one for every
   ``CELL_ROWS`` of them) partition the vectors: a vector's home is its nearest
   pivot's cell.
3. By the triangle inequality a partner of a vector whose home is cell p lies
   at most d(home) + 2r from p, and on p's side of the bisector of p and its
   own pivot or within r of it. Vectors are copied to just the cells for which
   both hold, so every link of a home vector is inside its own cell.
4. Cells join independently. A cell is cut into blocks of home rows by blocks
   of members, so a task holds two blocks, however large a cell is. A task
   counts the links of its home rows and emits a spanning forest of the links,
   never the pairs.
5. Components of the forests are the components of the links.

Scale: what is broadcast (in the function's closure) is the pivots, at most
``MAX_PIVOTS``; beyond them cells grow and only the number of blocks rises.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveflow.llm.components import connected_components
from sieveflow.llm.vectors import matrix, usable
from sieveflow.session import materialize

CELL_ROWS = 1_024
BLOCK_ROWS = 4_096
MAX_PIVOTS = 16_384
#: rounding of the pivots' distances
_SLACK = 1e-7


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _groups(rows: DataFrame, vec: str) -> DataFrame:
    """Distinct vectors of a label: (gid, label, dim, vec, n, least)."""
    found = rows.groupBy("label", F.col(vec).alias("vec")).agg(
        F.count("*").alias("n"), F.min("id").alias("least"))
    return materialize(found.select(F.monotonically_increasing_id().alias("gid"), "label",
                                    F.size("vec").alias("dim"), "vec", "n", "least"), "rangejoin")


def choose_pivots(groups: DataFrame) -> dict[tuple, np.ndarray]:
    """Unit pivots of each (label, dimension); one without any is a single cell."""
    per_cell = max(CELL_ROWS, groups.count() / MAX_PIVOTS)
    drawn = (groups.where(F.pmod(F.xxhash64("vec", F.lit(11)), F.lit(1 << 40)) < F.lit((1 << 40) / per_cell))
             .select("label", "dim", "vec").collect())
    out: dict[tuple, list] = {}
    for r in drawn:
        out.setdefault((r["label"], r["dim"]), []).append(r["vec"])
    return {k: _unit(np.array(sorted(v), np.float64)) for k, v in out.items()}


def _cells(groups: DataFrame, pivots: dict[tuple, np.ndarray], reach: float) -> DataFrame:
    """(label, dim, cell, home, gid, n, vec): each vector in its home cell and in
    those whose home vectors may link with it."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            keys = list(zip(table["label"].to_pylist(), table["dim"].to_pylist()))
            by_key: dict[tuple, list[int]] = {}
            for i, k in enumerate(keys):
                by_key.setdefault(k, []).append(i)
            for key, rows in by_key.items():
                part = table.take(pa.array(rows))
                step = _slice_rows(pivots.get(key))
                for at in range(0, len(rows), step):
                    some = part.slice(at, step)
                    row, cell, home = _placed(some, pivots.get(key), reach)
                    got = some.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [got["label"].combine_chunks(), got["dim"].combine_chunks(), pa.array(cell, pa.int32()),
                         pa.array(home), got["gid"].combine_chunks(), got["n"].combine_chunks(),
                         got["vec"].combine_chunks()],
                        ["label", "dim", "cell", "home", "gid", "n", "vec"])

    kind = groups.schema
    schema = (f"label {kind['label'].dataType.simpleString()}, dim int, cell int, home boolean, gid long, n long, "
              f"vec {kind['vec'].dataType.simpleString()}")
    return materialize(groups.select("label", "dim", "gid", "n", "vec").mapInArrow(spread, schema), "rangejoin")


def _slice_rows(pivots: np.ndarray | None) -> int:
    """Rows that are held against all pivots at a time: about 4 million distances."""
    return 1024 if pivots is None else max(1, min(1024, (4 << 20) // max(1, len(pivots))))


def _placed(some: pa.Table, pivots: np.ndarray | None, reach: float):
    n = len(some)
    if pivots is None or len(pivots) < 2:
        return np.arange(n), np.zeros(n, np.int32), np.ones(n, bool)
    x = _unit(matrix(some["vec"]))
    square = np.maximum(2 - 2 * (x @ pivots.T), 0)          # squared distances to the pivots
    own = square.argmin(axis=1)
    least = square[np.arange(n), own][:, None]
    near = np.sqrt(square) <= np.sqrt(least) + 2 * reach + _SLACK
    # own pivot to the others: of the pivots that own one of these rows only
    used, which = np.unique(own, return_inverse=True)
    between = np.sqrt(np.maximum(2 - 2 * (pivots[used] @ pivots.T), 0))
    near &= square - least <= 2 * between[which] * (reach + _SLACK) + _SLACK
    near[np.arange(n), own] = True
    row, cell = np.nonzero(near)
    return row, cell.astype(np.int32), cell == own[row]


def _join_block(table: pa.Table, threshold: float) -> pa.Table:
    """Links of one block of home rows with one block of members:
    (gid, links counted, one linked gid or null) rows."""
    role = table["home_side"].to_numpy()
    x = _unit(matrix(table["vec"]))
    gid, weight = table["gid"].to_numpy(), table["n"].to_numpy()
    h, m = np.flatnonzero(role), np.flatnonzero(~role)
    links = np.zeros(len(h), np.int64)
    # local components over home and member rows, by gid
    ids, inverse = np.unique(np.concatenate((gid[h], gid[m])), return_inverse=True)
    hi, mi = inverse[:len(h)], inverse[len(h):]
    root = np.arange(len(ids))
    step = max(1, (4 << 20) // max(1, len(m)))
    for at in range(0, len(h), step):
        some = slice(at, at + step)
        near = x[h[some]] @ x[m].T >= threshold
        near &= gid[h[some]][:, None] != gid[m][None, :]
        links[some] = near @ weight[m]
        root = _merged(root, hi[some], mi, near)
    out_edge = np.flatnonzero(root != np.arange(len(ids)))
    return pa.table({
        "gid": pa.array(np.concatenate((gid[h], ids[out_edge]))),
        "links": pa.array(np.concatenate((links, np.zeros(len(out_edge), np.int64)))),
        "other": pa.array(np.concatenate((np.zeros(len(h), np.int64), ids[root[out_edge]])),
                          mask=np.arange(len(h) + len(out_edge)) < len(h)),
    })


def _merged(root: np.ndarray, rows: np.ndarray, cols: np.ndarray, near: np.ndarray) -> np.ndarray:
    """``root`` (smallest index of each local component) after the links in
    ``near``. Labels fall to the smallest of a neighbourhood until none moves."""
    some = np.flatnonzero(near.any(axis=1))
    if not len(some):
        return root
    rows, near = rows[some], near[some]
    used = np.flatnonzero(near.any(axis=0))
    cols, near = cols[used], near[:, used]
    big = np.iinfo(np.int64).max
    while True:
        low = np.where(near, root[cols][None, :], big).min(axis=1)
        low = np.minimum(low, root[rows])
        back = np.where(near, low[:, None], big).min(axis=0)
        new = root.copy()
        # whole components move: what a root falls to, all below it follow
        np.minimum.at(new, root[rows], low)
        np.minimum.at(new, root[cols], back)
        new = np.minimum(new, new[root])
        while True:
            flat = new[new]
            if (flat == new).all():
                break
            new = flat
        if (new == root).all():
            return root
        root = new


def vector_links(groups: DataFrame, threshold: float) -> DataFrame:
    """(gid, links, other): the home rows' counts of linked vectors (copies
    counted) and edges between linked groups."""
    reach = float(np.sqrt(2 - 2 * threshold))
    cells = _cells(groups, choose_pivots(groups), reach)
    counts = materialize(cells.groupBy("label", "dim", "cell").agg(
        F.ceil(F.sum(F.col("home").cast("int")) / BLOCK_ROWS).cast("int").alias("home_blocks"),
        F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("member_blocks")), "rangejoin")
    rows = cells.join(counts, ["label", "dim", "cell"]).where("home_blocks > 0")
    mine = lambda blocks: F.pmod(F.xxhash64("gid"), F.col(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    keep = ["label", "dim", "cell", "gid", "vec", "n"]
    homes = rows.where("home").select(*keep, F.lit(True).alias("home_side"),
                                      mine("home_blocks").alias("i"), every("member_blocks").alias("j"))
    members = rows.select(*keep, F.lit(False).alias("home_side"),
                          mine("member_blocks").alias("j"), every("home_blocks").alias("i"))
    both = homes.unionByName(members)

    def join_block(table: pa.Table) -> pa.Table:
        return _join_block(table, threshold)

    return materialize(both.groupBy("label", "dim", "cell", "i", "j")
                       .applyInArrow(join_block, "gid long, links long, other long"), "rangejoin")


def vector_components(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                      label_col: str = "label", threshold: float = 0.98) -> DataFrame:
    """(``id_col``, n_links, component_id, kept), one row per row of ``vectors``.

    Rows link when their labels are equal and not null, their vectors have one
    length and their cosine is at least ``threshold`` (above 0). Vectors that
    are null, empty, zero or hold null or non-finite components, and null
    labels, link with nothing: 0 links, their own component. ``n_links``
    counts rows, so a repeated row links with its copies. ``kept`` is true for
    the row(s) whose id is the component's smallest; a null id is never
    smallest and never kept. Other columns are not read. No rows: an empty
    result.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec"))
    able = F.col("label").isNotNull() & usable("vec")
    groups = _groups(rows.where(able), "vec")
    links = vector_links(groups, threshold)
    counts = links.groupBy("gid").agg(F.sum("links").alias("links"))
    comps = connected_components(links.where("other is not null"), "gid", "other")
    named = groups.join(counts, "gid").join(comps.withColumnRenamed("node", "gid"), "gid", "left") \
        .withColumn("comp", F.coalesce("component", "gid"))
    named = materialize(named.select("label", "vec", "n", "least", "links", "comp"), "rangejoin")
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    by_group = named.join(least, "comp").select(
        "label", "vec", (F.col("n") - 1 + F.col("links")).alias("n_links"), "component_id")
    linked = rows.where(able).join(by_group, ["label", "vec"]).select("id", "n_links", "component_id")
    rest = rows.where(~able).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.union(rest).select(
        F.col("id").alias(id_col), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
