"""J5 along long chains: whole runs of messages that hang on one another are
decided in a number of rounds that grows with the logarithm of their length.

In the graph of :mod:`~sieveflow.operators.ingest` an edge (a message) waits for
the earlier live edges at its two ends. An edge that waits for exactly one
other is a *link*: it is kept iff that one is not. Links follow one another in
chains, and along a chain the answer only alternates, so chains are followed by
pointer jumping: every link remembers an edge further back and whether the
number of steps to it is odd, and each round doubles the steps. A chain that
starts at a locally first edge, which is kept, is decided whole. One that starts
at an edge that waits for several others stays for a later round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

OPEN, DECIDED, STUCK = 0, 1, 2


def links(ends: DataFrame) -> DataFrame:
    """(s, target, odd, state) of the locally first edges (decided) and the
    links (open) among ``ends`` (end, s): each edge once for both its ends."""
    at = Window.partitionBy("end").orderBy("s")
    # the two first edges of each end; the limit works before the shuffle, so
    # a key that many messages share stays small
    two = ends.withColumn("r", F.row_number().over(at)).where("r <= 2")
    two = two.groupBy("end").agg(F.min("s").alias("first"), F.max("s").alias("second"))
    late = F.col("second") != F.col("first")
    spots = two.select(F.explode(F.filter(F.array(
        F.struct(F.col("first").alias("s"), F.lit(1).alias("rank"),
                 F.when(F.lit(False), F.col("first")).alias("target")),
        F.when(late, F.struct(F.col("second").alias("s"), F.lit(2).alias("rank"), F.col("first").alias("target")))),
        lambda x: x.isNotNull())).alias("x"))
    edges = spots.groupBy("x.s").agg(F.count(F.lit(1)).alias("ends"), F.sum("x.rank").alias("ranks"),
                                     F.max("x.target").alias("target"))
    return (edges.where("ends = 2 and ranks <= 3")
            .select("s", "target", (F.col("ranks") == 3).alias("odd"),
                    F.when(F.col("ranks") == 2, F.lit(DECIDED)).otherwise(F.lit(OPEN)).alias("state")))


def follow(table: DataFrame, path: str) -> tuple[DataFrame, int]:
    """Pointer jumping over the rows of :func:`links`; returns (rows that are
    decided or stuck, rounds). The tables of the rounds go below ``path``."""
    now, rounds = materialize(table, "", f"{path}/step=0"), 0
    while not now.where(F.col("state") == OPEN).isEmpty():
        rounds += 1
        back = now.select(F.col("s").alias("target"), F.col("target").alias("further"),
                          F.col("odd").alias("more"), F.col("state").alias("there"))
        is_open = F.col("state") == OPEN
        step = now.join(back, "target", "left").select(
            "s",
            F.when(is_open & (F.col("there") == OPEN), F.col("further")).otherwise(F.col("target")).alias("target"),
            F.when(is_open & F.col("there").isNotNull(), F.col("odd") != F.col("more")).otherwise(F.col("odd")).alias("odd"),
            # an edge that is neither first nor a link is not in the table
            F.when(is_open, F.coalesce("there", F.lit(STUCK))).otherwise(F.col("state")).alias("state"))
        now = materialize(step, "", f"{path}/step={rounds}")
    return now, rounds


def kept_on_chains(ends: DataFrame, path: str) -> tuple[DataFrame, int]:
    """(s) of the edges that are kept for certain: the locally first ones and
    every second link of the chains that start at them."""
    done, rounds = follow(links(ends), path)
    return done.where((F.col("state") == DECIDED) & ~F.col("odd")).select("s"), rounds
