"""A1-A3, D8 kept up to date: statistics from partial aggregates of batches.

Each batch leaves one small table of counts per channel and day. All of these
add up (counts) or combine (first and last date), so statistics over everything
recorded are an aggregation over the parts; neither the log nor earlier batches
are read again. A part belongs to its batch: a batch that is replayed writes its
part anew, and the totals follow.

Accepted messages have ID keys and hashes of their own, by the ingest's rule, so
the counts of distinct IDs and hashes are sums as well (of both layers' ingest;
with one layer switched off the other key may repeat).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import read_or_empty
from ..functions.text import NEW, TRACKER_VERSION
from .stats import _with_rates

PART_SCHEMA = T.StructType([
    T.StructField("channel_id", T.StringType()),
    T.StructField("day", T.DateType()),
    T.StructField("messages", T.LongType()),
    T.StructField("new_messages", T.LongType()),
    T.StructField("new_hashes", T.LongType()),
    T.StructField("duplicates", T.LongType()),
    T.StructField("first_date", T.TimestampNTZType()),
    T.StructField("last_date", T.TimestampNTZType()),
    T.StructField("batch_id", T.LongType()),
])


def batch_part(classified: DataFrame) -> DataFrame:
    """The partial aggregate of a batch of classified messages."""
    is_new = F.col("status") == F.lit(NEW)
    return (classified.groupBy("channel_id", F.to_date("date").alias("day"))
            .agg(F.count(F.lit(1)).alias("messages"), F.count_if(is_new).alias("new_messages"),
                 F.count_if(is_new & (F.col("content_hash") != "")).alias("new_hashes"),
                 F.count_if(~is_new).alias("duplicates"),
                 F.min(F.col("date").cast("timestamp_ntz")).alias("first_date"),
                 F.max(F.col("date").cast("timestamp_ntz")).alias("last_date")))


def write_part(classified: DataFrame, root: str, batch_id: int) -> None:
    """Writes (or, after a replay, writes anew) the part of a batch."""
    batch_part(classified).write.mode("overwrite").parquet(f"{root}/batch_id={int(batch_id)}")


def read_parts(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, root, PART_SCHEMA)


def running_channel_stats(parts: DataFrame) -> DataFrame:
    """A1 over all batches: per channel total / new / duplicates and rates."""
    return _with_rates(parts.groupBy("channel_id").agg(
        F.sum("messages").alias("total_messages"), F.sum("new_messages").alias("new_messages"),
        F.sum("duplicates").alias("duplicates")))


def running_tracker_statistics(parts: DataFrame) -> DataFrame:
    """A3 over all batches."""
    per = parts.where("new_messages > 0").groupBy("channel_id").agg(
        F.sum("new_messages").alias("n"), F.sum("new_hashes").alias("h"))
    none = F.lit(0).cast("long")
    return per.agg(F.count(F.lit(1)).alias("channels_tracked"),
                   F.coalesce(F.sum("n"), none).alias("total_messages_tracked"),
                   F.coalesce(F.sum("h"), none).alias("content_hashes"),
                   F.coalesce(F.sum("n"), none).alias("total_in_db")).withColumn("version", F.lit(TRACKER_VERSION))


def running_daily(parts: DataFrame) -> DataFrame:
    """D8 over all batches: per channel and day counts and running totals."""
    names = ["messages", "new_messages", "duplicates"]
    daily = parts.groupBy("channel_id", "day").agg(*[F.sum(c).alias(c) for c in names])
    w = Window.partitionBy("channel_id").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select("*", *[F.sum(c).over(w).alias(f"cum_{c}") for c in names])
