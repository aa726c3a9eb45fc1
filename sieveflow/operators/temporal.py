"""Time-based operators over message dates.

All three need "the previous message of the group"; they use the sliced
ordered scan (``ordered.py``) so that one busy channel or one often-repeated
text is spread over many tasks instead of one window partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .ordered import SLICE, edge_groups, ordered_scan, slice_groups


def _gap_seconds(later: str, earlier: str):
    """Seconds between two dates (time-zone free for timestamp_ntz)."""
    return F.timestamp_diff("MICROSECOND", F.col(earlier), F.col(later)) / F.lit(1_000_000.0)


def rapid_reposts(messages: DataFrame, within_seconds: float, *, seq: str = "seq",
                  slices: int | None = None) -> DataFrame:
    """D3: flag a message whose channel and content hash equal those of the
    previous such message, posted at most ``within_seconds`` earlier.

    Adds ``prev_date``, ``gap_seconds`` and ``is_repost``."""
    scanned = ordered_scan(messages, ["channel_id", "content_hash"], ["date", seq],
                           lag=["date"], rank=None, slices=slices)
    gap = _gap_seconds("date", "prev_date")
    return (scanned.drop(SLICE)
            .withColumn("gap_seconds", gap)
            .withColumn("is_repost", F.coalesce(gap <= F.lit(float(within_seconds)),
                                                F.lit(False))))


def burst_ids(messages: DataFrame, gap_seconds: float, *, seq: str = "seq",
              slices: int | None = None) -> DataFrame:
    """Temporal clustering. A new burst starts in a channel when the gap to
    the previous message is more than ``gap_seconds``; ``burst_id`` numbers
    the bursts of each channel from 1.

    One windowed pass over the range slices: inside a slice every row but the
    first knows its predecessor, so its start flag and the running count of
    starts are local. Only the first row of a slice needs the previous slice's
    last date; that comes from a summary of the first and the last channel of
    each slice, which also carries the number of starts before the slice. Any
    other channel lies in one slice whole."""
    group, order = ["channel_id"], ["date", seq]
    gap = F.lit(float(gap_seconds))
    w = Window.partitionBy(*group, SLICE).orderBy(*order)
    local = (slice_groups(messages, group, order, slices)
             .withColumn("_lprev", F.lag("date").over(w))
             .withColumn("_lstart", F.when(F.col("_lprev").isNotNull()
                                           & (_gap_seconds("date", "_lprev") > gap), 1)
                         .otherwise(0))
             .withColumn("_lcum", F.sum("_lstart").over(
                 w.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    local = materialize(local, "bursts")
    summary = edge_groups(local, group).groupBy(*group, SLICE).agg(
        F.min("date").alias("_first"), F.max("date").alias("_last"),
        F.sum("_lstart").alias("_inner"))
    ws = Window.partitionBy(*group).orderBy(SLICE)
    prev_last = F.lag("_last").over(ws)
    first_start = F.when(prev_last.isNull() | (_gap_seconds("_first", "_prev_last") > gap), 1
                         ).otherwise(0)
    summary = (summary.withColumn("_prev_last", prev_last)
               .withColumn("_fstart", first_start)
               .withColumn("_before", F.coalesce(F.sum(F.col("_fstart") + F.col("_inner")).over(
                   ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
               .select(*group, SLICE, "_fstart", "_before"))
    # at most two rows for each slice
    out = local.join(materialize(summary, "burst-edges"), [*group, SLICE], "left")
    burst = F.coalesce("_before", F.lit(0)) + F.coalesce("_fstart", F.lit(1)) + F.col("_lcum")
    return (out.withColumn("burst_id", burst.cast("long"))
            .drop("_lprev", "_lstart", "_lcum", "_fstart", "_before", SLICE))


def burst_summary(messages: DataFrame, gap_seconds: float, *, seq: str = "seq",
                  slices: int | None = None) -> DataFrame:
    """Per channel and burst: first and last date, message count and
    distinct texts (by content hash)."""
    b = burst_ids(messages, gap_seconds, seq=seq, slices=slices)
    return (b.groupBy("channel_id", "burst_id")
            .agg(F.min("date").alias("burst_start"), F.max("date").alias("burst_end"),
                 F.count(F.lit(1)).alias("messages"),
                 F.count_distinct("content_hash").alias("distinct_texts")))
