"""Stream forms that need one key only, on Spark's own keyed state.

D2, one layer: the first arrival of each key, with state that expires behind
the watermark. D3: reposts, as a join of the stream with itself over an interval
of event time. Both bound their state by time, not by the length of the feed;
:func:`rocksdb` keeps that state on disk instead of in the executors' heap.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ingest import HASH_KEY, ID_KEY

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streaming queries started within keep their state in RocksDB."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def _timed(stream: DataFrame, time_col: str, watermark: str) -> DataFrame:
    return stream.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, watermark)


def first_arrivals(stream: DataFrame, horizon: str, *, id_layer: bool = True,
                   time_col: str = "date") -> DataFrame:
    """D2 on a stream with one layer: the first message of each ID key (or
    content hash). A key is remembered until the watermark, ``horizon`` behind
    the latest message, has passed it: with a horizon that covers the feed this
    is the batch answer, with a shorter one a key may come again later."""
    return _timed(stream, time_col, horizon).dropDuplicatesWithinWatermark(ID_KEY if id_layer else HASH_KEY)


def stream_reposts(stream: DataFrame, again: DataFrame, within_seconds: float, watermark: str,
                   *, seq: str = "seq", time_col: str = "date") -> DataFrame:
    """D3 on a stream: the messages of ``stream`` whose channel and text came
    at most ``within_seconds`` earlier. ``again`` is a second reading of the same
    feed. A semi join over the interval: a message comes out once, however
    many earlier ones match, and both sides are kept for the interval and the
    ``watermark`` only.

    A join of streams compares all rows of a key, so time is part of the key:
    spans of the interval's length, an earlier message counts in its own span and
    the next. When nothing may come late (a ``watermark`` of zero), the earlier
    messages of one date are one row too, with their first ``seq``: that date is
    done when a later one has come or the run ends."""
    span = F.make_dt_interval(secs=F.lit(float(within_seconds)))
    width = F.lit(max(1, math.ceil(within_seconds * 1_000_000)))
    late = _timed(stream, time_col, watermark).withColumn("_span", _span_start(time_col, width))
    early = again.select(F.col("channel_id").alias("_channel"), F.col("content_hash").alias("_hash"),
                         F.col(time_col).cast("timestamp").alias("_time"), F.col(seq).alias("_seq"))
    soon = F.lit(True)
    if re.search("[1-9]", watermark):
        early = early.withWatermark("_time", watermark)
    else:
        # a watermark is a whole number of milliseconds
        early = (early.withColumn("_milli", F.date_trunc("millisecond", "_time")).withWatermark("_milli", watermark)
                 .groupBy("_channel", "_hash", "_milli", "_time").agg(F.min("_seq").alias("_seq")))
        soon = ((F.col("_milli") <= F.col(time_col))
                & (F.col("_milli") >= F.col(time_col) - span - F.make_dt_interval(secs=F.lit(0.001))))
    start = _span_start("_time", width)
    early = early.withColumn("_near", F.explode(F.array(start, start + width)))
    return late.join(early, (F.col("channel_id") == F.col("_channel")) & (F.col("content_hash") == F.col("_hash"))
                     & (F.col("_span") == F.col("_near")) & soon
                     & (F.col("_time") <= F.col(time_col)) & (F.col("_time") >= F.col(time_col) - span)
                     & ((F.col("_time") < F.col(time_col)) | (F.col("_seq") < F.col(seq))), "left_semi").drop("_span")


def _span_start(time_col: str, width: Column) -> Column:
    """The start of a date's span of ``width`` microseconds."""
    micros = F.unix_micros(F.col(time_col))
    return micros - F.pmod(micros, width)
