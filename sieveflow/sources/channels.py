"""K4: the ordered channel list, and W2: channel-major processing order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordered import ordered_scan
from ..session import materialize

CHANNEL_LIST_SCHEMA = T.StructType([
    T.StructField("channel_ordinal", T.IntegerType(), False),
    T.StructField("channel", T.StringType(), True),
])


def channel_list(spark: SparkSession, channels: str | None) -> DataFrame:
    """Split a comma-separated channel setting into ``(channel_ordinal, channel)``.

    Like ``s.split(',')``: no trimming, empty items kept, a channel listed
    twice appears twice. Unset or empty -> no rows.
    """
    if not channels:
        return spark.createDataFrame([], CHANNEL_LIST_SCHEMA)
    return spark.range(1).select(
        F.posexplode(F.split(F.lit(channels), ",", -1)).alias("channel_ordinal", "channel"))


def channels_of(messages: DataFrame) -> DataFrame:
    """The channel list of a whole feed: every channel that occurs, numbered
    in code-point order. The distinct channels are cut into contiguous ranges
    and ranked within them (``ordered_scan``), so no task gets them all.
    Written, so that Spark knows its size."""
    names = messages.select(F.col("channel_id").alias("channel")).distinct().withColumn("_all", F.lit(0))
    ranked = ordered_scan(names, ["_all"], ["channel"], rank="_rank")
    return materialize(ranked.select((F.col("_rank") - 1).cast("int").alias("channel_ordinal"), "channel"), "channels")


def in_channel_order(messages: DataFrame, channels: DataFrame,
                     seq_col: str = "seq") -> DataFrame:
    """Messages of the listed channels in processing order (Q13).

    Channels run one after another in list order, so the arrival order becomes
    ``struct(channel_ordinal, seq)``. Messages of other channels are left out.
    """
    return (messages.join(channels, messages["channel_id"] == channels["channel"], "inner")
            .withColumn(seq_col, F.struct(F.col("channel_ordinal").alias("channel_ordinal"),
                                          F.col(seq_col).alias("seq")))
            .drop("channel"))
