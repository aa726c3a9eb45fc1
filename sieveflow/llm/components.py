"""Connected components of an edge table by alternating large-star and
small-star steps (Kiveris, Lattanzi, Mirrokni, Rastogi, Vassilvitskii:
"Connected Components in MapReduce and Beyond", SoCC 2014).

A step takes the smallest neighbour of every node with a partial ``min``
aggregation and joins it back onto the edges, so no neighbour list is ever
gathered; the join's hot nodes (hubs) are split by AQE. The edges of each
round are written to the shared checkpoint folder: a lost executor costs the
current round only. The rounds needed grow with the logarithm of the node
count. The driver sees two numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveflow.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (u, v), u > v."""
    if large:
        # neighbours above a node move to the smallest of its closed neighbourhood
        both = edges.select(F.col("v").alias("n"), F.col("u").alias("w")).union(
            edges.select(F.col("u").alias("n"), F.col("v").alias("w")))
    else:
        # the node itself and its lower neighbours move to its smallest neighbour
        both = edges.select(F.col("u").alias("n"), F.col("v").alias("w"))
    low = both.groupBy(F.col("n").alias("m_n")).agg(F.min("w").alias("m"))
    joined = both.join(low, F.col("n") == F.col("m_n"))
    if large:
        out = (joined.where(F.col("w") > F.col("n"))
               .select(F.col("w").alias("u"), F.least("n", "m").alias("v")))
    else:
        out = (joined.select(F.col("w").alias("u"), F.col("m").alias("v"))
               .union(low.select(F.col("m_n").alias("u"), F.col("m").alias("v"))))
    return out.where(F.col("u") > F.col("v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b",
                         max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node that ``edges`` links to another one;
    ``component`` is the smallest node of the component.

    ``a`` and ``b`` are columns of one orderable type. Loops, repeated edges
    and either direction are fine; rows with a null end are ignored. No edges:
    an empty result. ``max_rounds`` only guards against a defect: reaching it
    raises, it never returns unfinished components.
    """
    e = (edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
         .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    e = materialize(e, "components")
    last = _mark(e)
    for _ in range(max_rounds):
        if last[0] == 0:
            break
        e = materialize(_star(_star(e, large=True), large=False), "components")
        now = _mark(e)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("connected components did not settle")
    # settled: every edge leads from a node to the smallest of its component
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(e.select(F.col("v"), F.col("v")).distinct()))
