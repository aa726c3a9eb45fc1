"""Ordered scans within groups that may be huge (rank, lag, running sums).

``Window.partitionBy(group)`` puts every row of a group into one task; a
channel holding a third of all messages would then be sorted by one core.
Here a group is cut into *slices* first:

1. ``repartitionByRange(P, group, order)`` samples the keys and cuts the total
   order into P contiguous ranges, so a hot group spans many slices and no
   slice is larger than about N/P rows;
2. window functions run per ``(group, slice)`` (bounded sizes);
3. only the first group of a slice can go on from an earlier slice, so the
   carries are computed from the first and the last group of each slice: at
   most 2P summary rows, however many groups there are;
4. these rows are joined back on ``(group, slice)``: Spark broadcasts them, and
   the data itself is not shuffled again.

The range cut samples with a seed that differs per exchange, so two
consumers of the same sliced rows could disagree on the slice bounds; the
sliced rows are therefore written once to the shared checkpoint folder
(``materialize``) and every later step reads that table. Callers should
select the columns they need first: the optimizer cannot prune through that
write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

SLICE = "_slice"


def _parts(df: DataFrame, slices: int | None) -> int:
    if slices:
        return int(slices)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def slice_groups(df: DataFrame, group: list[str], order: list[str],
                 slices: int | None = None) -> DataFrame:
    """Tag rows with the contiguous range slice of ``(group, order)``.

    ``order`` must make the order total (end with a unique column)."""
    return (df.repartitionByRange(_parts(df, slices), *group, *order)
            .withColumn(SLICE, F.spark_partition_id()))


def ordered_scan(df: DataFrame, group: list[str], order: list[str], *,
                 lag: list[str] = (), rank: str | None = "rank",
                 slices: int | None = None) -> DataFrame:
    """Add the 1-based position in the group (``rank``) and, for each column
    ``c`` in ``lag``, ``prev_<c>``: its value on the preceding row of the
    group (null on the first). Keeps the ``_slice`` column for later passes."""
    sliced = df if SLICE in df.columns else slice_groups(df, group, order, slices)
    w = Window.partitionBy(*group, SLICE).orderBy(*order)
    local = sliced.withColumn("_lrank", F.row_number().over(w))
    for c in lag:
        local = local.withColumn(f"_lprev_{c}", F.lag(c).over(w))
    local = materialize(local, "ordered-scan")
    summ_aggs = [F.count(F.lit(1)).alias("_n")]
    summ_aggs += [F.max_by(c, "_lrank").alias(f"_last_{c}") for c in lag]
    summary = edge_groups(local, group).groupBy(*group, SLICE).agg(*summ_aggs)
    ws = Window.partitionBy(*group).orderBy(SLICE)
    before = ws.rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(
        *group, SLICE,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        *[F.lag(f"_last_{c}").over(ws).alias(f"_carry_{c}") for c in lag])
    # at most two rows for each slice
    out = local.join(materialize(summary, "ordered-scan"), [*group, SLICE], "left")
    if rank:
        out = out.withColumn(rank, F.col("_lrank") + F.coalesce("_offset", F.lit(0)))
    for c in lag:
        out = out.withColumn(f"prev_{c}", F.when(F.col("_lrank") == 1, F.col(f"_carry_{c}"))
                             .otherwise(F.col(f"_lprev_{c}")))
    drop = ["_lrank", "_offset"] + [f"_lprev_{c}" for c in lag] + [f"_carry_{c}" for c in lag]
    return out.drop(*drop)


def edge_groups(local: DataFrame, group: list[str]) -> DataFrame:
    """The rows of the first and the last group of each slice."""
    g = F.struct(*group)
    edges = materialize(local.groupBy(SLICE).agg(F.min(g).alias("_low"), F.max(g).alias("_high")),
                        "slice-edges")
    return (local.join(edges, [SLICE], "inner")
            .where(g.eqNullSafe(F.col("_low")) | g.eqNullSafe(F.col("_high")))
            .drop("_low", "_high"))
