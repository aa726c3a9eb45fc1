"""Incremental ingest with durable state on Structured Streaming.

``readStream`` -> ``foreachBatch``: every micro-batch runs the ordered ingest
against the state recorded by the *earlier* batches and then writes

* its classified messages to ``output/batch_id=N`` and
* its accepted messages to the state and
* with ``stats_path``, its partial statistics (``operators/running_stats``).

N is the state's batch id. The state remembers which stream and micro-batch it
recorded as N, so a micro-batch that is run again after a failure gets the same
N, reads the same state ("batch id below N") and replaces exactly its own
output; a stream started anew on the same state continues behind it. The
streaming checkpoint records which files a batch took; a stopped query resumes
with the next batch (S2).

Arrival order is (micro-batch, seq): messages of a later micro-batch are later
than every message of an earlier one, whatever their ``seq``. With
``lateness_seconds`` messages wait in a reorder buffer (``reorder``) until the
watermark has passed them, and the order is that of their dates, across
micro-batches too; :func:`drain_stream` releases the rest of a feed that has ended.

Built-in ``dropDuplicates`` / ``dropDuplicatesWithinWatermark`` cannot express
the two-key fold (chaining them gives the two-pass answer), and
``transformWithState`` is keyed by one key, hence ``foreachBatch``.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import NEW
from ..operators.ingest import ingest
from ..operators.running_stats import write_part
from ..plans.run import record_batch
from ..sources.snapshots import read_latest_snapshot
from ..sources.state_store import open_state
from .reorder import ReorderBuffer, event_order

CLASSIFIED_COLUMNS = ["channel_id", "message_id", "channel_name", "text", "date", "seq",
                      "content_hash", "status", "is_duplicate", "reason"]


def ingest_batch(batch: DataFrame, source_batch: int, *, state_path: str, output_path: str,
                 to_messages: Callable[[DataFrame], DataFrame], processed_at=None,
                 source: str = "batches", snapshot_path: str | None = None, stats_path: str | None = None,
                 compact_every: int | None = None) -> int:
    """One micro-batch (also usable from a plain batch job). Returns the
    number of rounds the matching took. ``source`` and ``source_batch`` name
    the micro-batch; the same pair again is a replay. ``compact_every`` batches
    the days of the state with many small files are rewritten as few."""
    spark = batch.sparkSession
    tables = open_state(spark, state_path)
    batch_id, again = tables.next_batch(source, int(source_batch))
    state = tables.state(before_batch=batch_id, spark=spark)
    if snapshot_path is not None:
        state = state.union(read_latest_snapshot(spark, snapshot_path))
    res = ingest(to_messages(batch), state)
    out_dir = f"{output_path}/batch_id={batch_id}"
    (res.messages.select(*CLASSIFIED_COLUMNS).withColumn("batch_id", F.lit(batch_id).cast("long"))
     .write.mode("overwrite").parquet(out_dir))
    # the accepted rows come from the written output: the status join is not
    # computed again for the state writes
    classified = spark.read.parquet(out_dir)
    accepted = classified.where(F.col("status") == F.lit(NEW))
    if stats_path is not None:
        write_part(classified, stats_path, batch_id)
    record_batch(tables, accepted, batch_id, replay=again, source=source,
                 source_batch=int(source_batch), snapshot_path=snapshot_path,
                 processed_at=processed_at if processed_at is not None else F.col("date"))
    if compact_every and (batch_id + 1) % compact_every == 0:
        tables.compact()
    return res.rounds


def _stream_id(spark: SparkSession, checkpoint_location: str) -> str:
    """The id that a checkpoint gives its query for life."""
    text = spark.read.text(f"{checkpoint_location}/metadata", wholetext=True).first()[0]
    return json.loads(text)["id"]


def start_ingest_stream(spark: SparkSession, source_path: str, source_schema: T.StructType,
                        *, state_path: str, output_path: str, checkpoint_location: str,
                        to_messages: Callable[[DataFrame], DataFrame], fmt: str = "parquet",
                        available_now: bool = True, max_files_per_trigger: int | None = None,
                        processed_at=None, snapshot_path: str | None = None,
                        stats_path: str | None = None, compact_every: int | None = None,
                        lateness_seconds: float | None = None,
                        buffer_path: str | None = None) -> StreamingQuery:
    """Start the streaming ingest over files arriving in ``source_path``.
    ``lateness_seconds`` and ``buffer_path`` (a folder for the messages that
    wait) put messages in the order of their dates."""
    reader = spark.readStream.schema(source_schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    stream = reader.load(source_path)

    def run(batch: DataFrame, batch_id: int) -> None:
        ordered = to_messages if lateness_seconds is None else in_event_order(
            to_messages, ReorderBuffer(spark, buffer_path, lateness_seconds), batch_id)
        ingest_batch(batch, batch_id, state_path=state_path, output_path=output_path, to_messages=ordered,
                     processed_at=processed_at, snapshot_path=snapshot_path, stats_path=stats_path,
                     compact_every=compact_every, source=_stream_id(spark, checkpoint_location))

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation",
                                                         checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def in_event_order(to_messages: Callable[[DataFrame], DataFrame], buffer: ReorderBuffer, batch: int,
                   end_of_feed: bool = False) -> Callable[[DataFrame], DataFrame]:
    """``to_messages`` followed by the reorder buffer: what micro-batch
    ``batch`` releases, with the arrival order of its dates."""
    return lambda rows: event_order(buffer.release(to_messages(rows), batch, end_of_feed=end_of_feed))


def drain_stream(spark: SparkSession, source_schema: T.StructType, *, state_path: str, output_path: str,
                 checkpoint_location: str, to_messages: Callable[[DataFrame], DataFrame],
                 lateness_seconds: float, buffer_path: str, **kwargs) -> int:
    """The end of a feed: ingests what still waits in the reorder buffer, as
    the micro-batch after the stream's last one."""
    buffer = ReorderBuffer(spark, buffer_path, lateness_seconds)
    last = buffer.marks().agg(F.max("batch")).first()[0]
    batch = 0 if last is None else last + 1
    return ingest_batch(spark.createDataFrame([], source_schema), batch, state_path=state_path,
                        output_path=output_path, source=_stream_id(spark, checkpoint_location),
                        to_messages=in_event_order(to_messages, buffer, batch, end_of_feed=True), **kwargs)


def read_stream_output(spark: SparkSession, output_path: str) -> DataFrame:
    return spark.read.parquet(output_path)


def stream_bursts(stream: DataFrame, gap_seconds: int, watermark: str,
                  time_col: str = "date") -> DataFrame:
    """D5 on a stream: per channel, sessions of messages no more than
    ``gap_seconds`` apart (``session_window``), closed by the watermark. Rows
    up to ``watermark`` late join their burst. A row without a channel only
    moves the watermark: :func:`end_of_feed` closes the last bursts with one."""
    ts = stream.withColumn(time_col, F.col(time_col).cast("timestamp"))
    return (ts.withWatermark(time_col, watermark)
            .groupBy("channel_id", F.session_window(time_col, f"{int(gap_seconds)} seconds")
                     .alias("burst"))
            .agg(F.count("channel_id").alias("messages"),
                 F.min(time_col).alias("burst_start"), F.max(time_col).alias("burst_end"))
            # on a count: a condition on the channel would be pushed below the watermark
            .where("messages > 0"))


def end_of_feed(messages: DataFrame, gap_seconds: int, lateness_seconds: int = 0,
                time_col: str = "date") -> DataFrame:
    """D5 on a stream: one row (null channel, a date past every burst) that a
    feed that has ended puts behind its messages, so that all bursts come out."""
    past = F.make_interval(secs=F.lit(int(gap_seconds) + int(lateness_seconds) + 1))
    return messages.agg((F.max(time_col) + past).alias(time_col)).select(
        F.lit(None).cast("string").alias("channel_id"), time_col)
