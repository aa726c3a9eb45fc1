"""Which messages to take.

* L1 keeps the newest N per channel in two steps: per (channel, hash part) and
  then per channel. Both are planned with a partial ``WindowGroupLimit`` before
  the shuffle, so a first-step task gets at most N rows of a map task and a
  final one N rows of each part, however many map tasks there are.
* D9 numbers fixed-size batches with the sliced ordered scan.
* D12 marks are ``max_by`` aggregates; the "after the mark" filter joins the
  written marks (one row per channel): Spark broadcasts them by their bytes or
  lets AQE split busy channels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordered import SLICE, ordered_scan
from ..session import materialize


#: first-step groups per channel
LIMIT_PARTS = 32


def latest_n_per_channel(messages: DataFrame, n: int, *, seq: str = "seq",
                         group: str | None = None) -> DataFrame:
    """L1: at most ``n`` messages per channel, newest first by (date, seq).
    ``group`` defaults to ``channel_ordinal`` when present (a channel listed
    twice is taken twice), else ``channel_id``."""
    group = group or ("channel_ordinal" if "channel_ordinal" in messages.columns
                      else "channel_id")
    order = [F.col("date").desc(), F.col(seq).desc()]
    part = Window.partitionBy(group, "_part").orderBy(*order)
    whole = Window.partitionBy(group).orderBy(*order)
    return (messages.withColumn("_part", F.pmod(F.xxhash64(seq), F.lit(LIMIT_PARTS)))
            .withColumn("position", F.row_number().over(part).cast("long"))
            .where(F.col("position") <= F.lit(int(n))).drop("_part")
            .withColumn("position", F.row_number().over(whole).cast("long"))
            .where(F.col("position") <= F.lit(int(n))))


def recent_messages(messages: DataFrame, as_of, days: int) -> DataFrame:
    """Messages dated within ``days`` days before ``as_of`` (rows without
    a date are kept). A plain predicate, pushed into the scan when ``date``
    is a stored column."""
    cutoff = F.lit(str(as_of)).cast("timestamp_ntz") - F.make_interval(days=F.lit(int(days)))
    return messages.where(F.col("date").isNull() | (F.col("date") >= cutoff))


def message_batches(messages: DataFrame, batch_size: int, *, seq: str = "seq",
                    slices: int | None = None) -> DataFrame:
    """Split each channel, in arrival order, into batches of
    ``batch_size``: ``position`` (1-based) and ``batch_number`` (0-based)."""
    ranked = ordered_scan(messages, ["channel_id"], [seq], rank="position", slices=slices)
    return (ranked.drop(SLICE)
            .withColumn("batch_number",
                        F.floor((F.col("position") - 1) / F.lit(int(batch_size))).cast("long")))


def batch_sizes(batches: DataFrame) -> DataFrame:
    """Messages per (channel, batch)."""
    return batches.groupBy("channel_id", "batch_number").agg(
        F.count(F.lit(1)).alias("messages"))


def high_water_marks(messages: DataFrame, *, seq: str = "seq") -> DataFrame:
    """Per channel the last message by (date, seq) and its position."""
    pos = F.struct(F.col("date").alias("date"), F.col(seq).alias("seq"))
    return (messages.groupBy("channel_id")
            .agg(F.max_by("message_id", pos).alias("last_message_id"),
                 F.max(pos).alias("_mark"), F.count(F.lit(1)).alias("_n"))
            .select("channel_id", "last_message_id", F.col("_mark.date").alias("mark_date"),
                    F.col("_mark.seq").alias("mark_seq"), "_n"))


def after_mark(messages: DataFrame, marks: DataFrame, *, seq: str = "seq") -> DataFrame:
    """Messages that come after their channel's mark; channels without a
    mark keep all their messages."""
    m = materialize(marks.select("channel_id", "mark_date", "mark_seq"), "marks")
    j = messages.join(m, ["channel_id"], "left")
    pos = F.struct(F.col("date"), F.col(seq))
    mark = F.struct(F.col("mark_date"), F.col("mark_seq"))
    return j.where(F.col("mark_seq").isNull() | (pos > mark)).drop("mark_date", "mark_seq")
