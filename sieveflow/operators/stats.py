"""Statistics over classified messages and the tracking log.

Every aggregate here combines map-side (count, sum, min, max, max_by, exact
distinct counts rewritten by Catalyst into two partial aggregations), so a hot
channel costs one row per map task, not one task for all its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import NEW, TRACKER_VERSION, percent, percent_text, safe_ratio, seconds_text


def _counts(df: DataFrame, *group) -> DataFrame:
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("total_messages"),
        F.count_if(F.col("status") == F.lit(NEW)).alias("new_messages"),
        F.count_if(F.col("status") != F.lit(NEW)).alias("duplicates"))


def _with_rates(df: DataFrame) -> DataFrame:
    return (df.withColumn("duplicate_rate", F.round(percent("duplicates", "total_messages"), 6))
            .withColumn("duplicate_rate_text", percent_text("duplicates", "total_messages")))


def channel_stats(classified: DataFrame, channels: DataFrame | None = None) -> DataFrame:
    """A1: per channel total / new / duplicates and the duplicate rate (number
    and text). With the channel list, listed channels without messages appear
    with zeros and '0%', and a channel listed twice has one row per listing."""
    if channels is None:
        return _with_rates(_counts(classified, "channel_id"))
    if "channel_ordinal" in classified.columns:
        g = _counts(classified, "channel_ordinal")
        j = channels.join(g, ["channel_ordinal"], "left")
    else:
        g = _counts(classified, "channel_id")
        j = channels.join(g, channels["channel"] == g["channel_id"], "left").drop("channel_id")
    j = j.select("channel_ordinal", F.col("channel").alias("channel_id"),
                 *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
                   for c in ("total_messages", "new_messages", "duplicates")])
    return _with_rates(j)


def run_totals(stats: DataFrame) -> DataFrame:
    """A2: channels processed, summed counts, overall rate ('0%' when empty)."""
    g = stats.agg(F.count(F.lit(1)).alias("channels_processed"),
                  F.coalesce(F.sum("total_messages"), F.lit(0)).cast("long").alias("total_messages"),
                  F.coalesce(F.sum("new_messages"), F.lit(0)).cast("long").alias("new_messages"),
                  F.coalesce(F.sum("duplicates"), F.lit(0)).cast("long").alias("duplicates"))
    return _with_rates(g)


def stats_rollup(classified: DataFrame) -> DataFrame:
    """A1 + A2 in one aggregation: ``rollup(channel_id)``; the total row has a
    null channel."""
    return _with_rates(classified.rollup("channel_id").agg(
        F.count(F.lit(1)).alias("total_messages"),
        F.count_if(F.col("status") == F.lit(NEW)).alias("new_messages"),
        F.count_if(F.col("status") != F.lit(NEW)).alias("duplicates")))


def tracker_statistics(log: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Channels tracked, distinct ID keys, distinct hashes (of every
    row ever appended, Q11), rows of the table view (one per key), version.

    ``ids`` adds ID keys from a JSON snapshot (U1). Two distinct aggregations
    (ID keys, hashes), each combined map-side, instead of one aggregation
    with four distinct counts (which Catalyst would run by copying every row
    four times); the two one-row results are merged through a tagged union."""
    keys = log.select("channel_id", "message_id", F.lit(True).alias("_in_log"))
    if ids is not None:
        keys = keys.unionByName(ids.select("channel_id", "message_id",
                                           F.lit(False).alias("_in_log")))
    per_key = keys.groupBy("channel_id", "message_id").agg(F.max("_in_log").alias("_in_log"))
    id_stats = per_key.agg(
        F.count_distinct("channel_id").alias("channels_tracked"),
        F.count(F.lit(1)).alias("total_messages_tracked"),
        F.count_if("_in_log").alias("total_in_db"),
        F.lit(None).cast("long").alias("content_hashes"))
    hash_stats = (log.where("content_hash is not null and content_hash <> ''")
                  .select("content_hash").distinct()
                  .agg(F.lit(None).cast("long").alias("channels_tracked"),
                       F.lit(None).cast("long").alias("total_messages_tracked"),
                       F.lit(None).cast("long").alias("total_in_db"),
                       F.count(F.lit(1)).alias("content_hashes")))
    both = id_stats.unionByName(hash_stats)
    return both.agg(*[F.max(c).alias(c) for c in
                      ("channels_tracked", "total_messages_tracked", "content_hashes",
                       "total_in_db")]).withColumn("version", F.lit(TRACKER_VERSION))


def ids_per_channel(log: DataFrame) -> DataFrame:
    """Size and range of each channel's ID set. The sets themselves
    are written in bounded chunks by the snapshot (K11), never gathered per
    channel."""
    return (log.select("channel_id", "message_id").distinct()
            .groupBy("channel_id")
            .agg(F.count(F.lit(1)).alias("n_ids"), F.min("message_id").alias("first_id"),
                 F.max("message_id").alias("last_id")))


def check_counters(classified: DataFrame) -> DataFrame:
    """A5: session counters of the duplicate checks."""
    dup = F.count_if(F.col("is_duplicate"))
    return classified.agg(F.count(F.lit(1)).alias("messages_checked"),
                          dup.alias("duplicates_detected"), dup.alias("cache_hits"))


def channel_throughput(classified: DataFrame) -> DataFrame:
    """A6 over data time: accepted messages per second of the channel's span
    (0 when the span is 0), span in seconds, as a number and as text (F12)."""
    g = classified.groupBy("channel_id").agg(
        F.count_if(F.col("status") == F.lit(NEW)).alias("new_messages"),
        (F.timestamp_diff("MICROSECOND", F.min("date"), F.max("date"))
         / F.lit(1_000_000.0)).alias("elapsed_seconds"))
    return (g.withColumn("messages_per_second",
                         F.round(safe_ratio("new_messages", "elapsed_seconds"), 6))
            .withColumn("elapsed_text", seconds_text("elapsed_seconds"))
            .withColumn("elapsed_seconds", F.round("elapsed_seconds", 2)))


def cumulative_daily(classified: DataFrame) -> DataFrame:
    """Per channel and day: counts of the day and running totals.

    The rows are first reduced to one per (channel, day); the running sums
    then window over days, a group bounded by the calendar, not the data."""
    daily = (classified.withColumn("day", F.to_date("date"))
             .groupBy("channel_id", "day")
             .agg(F.count(F.lit(1)).alias("messages"),
                  F.count_if(F.col("status") == F.lit(NEW)).alias("new_messages"),
                  F.count_if(F.col("status") != F.lit(NEW)).alias("duplicates")))
    w = Window.partitionBy("channel_id").orderBy("day").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    for c in ("messages", "new_messages", "duplicates"):
        daily = daily.withColumn(f"cum_{c}", F.sum(c).over(w))
    return daily


def duplicates_by_reason(classified: DataFrame) -> DataFrame:
    """Messages per channel and status with channel and grand totals
    (``rollup``)."""
    return (classified.rollup("channel_id", "status")
            .agg(F.count(F.lit(1)).alias("messages")))
