"""The reference's application run, as one Spark job per batch.

``messages -> channel order (K4/W2) -> per-channel limit (L1) -> ordered
ingest against the recorded state (J5) -> record accepted rows (K7) ->
per-channel statistics (A1) and run totals (A2)``. ``dry_run`` (D14) skips the
recording. :func:`process_in_groups` records group by group of channels, so
that a run that is cut keeps what it finished (S2).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import NEW
from ..session import materialize, read_or_empty, scratch_path
from ..operators.ingest import IngestState, ingest
from ..operators.selection import latest_n_per_channel
from ..operators.stats import channel_stats, run_totals
from ..sources.channels import channel_list, channels_of, in_channel_order
from ..sources.snapshots import read_latest_snapshot, write_snapshot
from ..sources.state_store import FolderState, open_state, tracking_rows


@dataclass
class RunReport:
    classified: DataFrame
    channel_stats: DataFrame
    totals: DataFrame
    rounds: int
    batch_id: int | None = None


def record_batch(tables: FolderState, accepted: DataFrame, batch_id: int, *, processed_at=None,
                 snapshot_path: str | None = None, replay: bool = False,
                 source: str | None = None, source_batch: int | None = None) -> None:
    """The end of a run: the accepted rows are recorded (K7) and, when a
    snapshot folder is named, the state is saved as JSON documents (K11) of
    version ``batch_id``."""
    spark = accepted.sparkSession
    rows = tracking_rows(accepted, processed_at=processed_at)
    tables.append(rows, batch_id, replay=replay, source=source, source_batch=source_batch)
    if snapshot_path is not None:
        state = tables.state(spark=spark).union(read_latest_snapshot(spark, snapshot_path))
        write_snapshot(state, snapshot_path, saved_at=str(processed_at) if isinstance(processed_at, str)
                       else datetime.now().isoformat(), version=batch_id)


def process_channels(messages: DataFrame, *, channels: str | DataFrame | None = None,
                     state_path: str | None = None, state: IngestState | None = None,
                     batch_id: int | None = None, replay: bool = False,
                     limit_per_channel: int | None = None, processed_at=None,
                     dry_run: bool = False, id_layer: bool = True, content_layer: bool = True,
                     work_dir: str | None = None, snapshot_path: str | None = None) -> RunReport:
    """Run one ingest batch over ``messages`` (normalised, fingerprinted).

    ``channels`` is the channel setting or a ready channel list; other channels
    are left out. With ``state_path`` the run continues the recorded state: it
    is created when missing, everything recorded counts as processed, and the
    accepted messages are recorded as the next batch. ``batch_id`` with
    ``replay`` repeats a recorded batch against the batches below it.
    ``snapshot_path`` names a folder of JSON state documents, merged at the start and written at
    the end."""
    spark = messages.sparkSession
    ch = None
    if channels is not None:
        ch = channels if isinstance(channels, DataFrame) else channel_list(spark, channels)
        messages = in_channel_order(messages, ch)
    if limit_per_channel is not None:
        messages = latest_n_per_channel(messages, limit_per_channel).drop("position")
    tables = open_state(spark, state_path) if state_path is not None else None
    if tables is not None and batch_id is None:
        batch_id = tables.next_batch()[0]
    if state is None and tables is not None:
        state = tables.state(before_batch=batch_id)
    if snapshot_path is not None:
        saved = read_latest_snapshot(spark, snapshot_path)
        state = saved if state is None else state.union(saved)
    work = work_dir or scratch_path(spark, "run")
    res = ingest(messages, state, id_layer=id_layer, content_layer=content_layer,
                 work_dir=f"{work}/ingest")
    # the record and the report both read it: classify once
    classified = materialize(res.messages, "classified", f"{work}/classified-{uuid.uuid4().hex[:12]}")
    if tables is not None and not dry_run:
        record_batch(tables, classified.where(F.col("status") == F.lit(NEW)), batch_id,
                     processed_at=processed_at, snapshot_path=snapshot_path, replay=replay)
    stats = channel_stats(classified, ch)
    return RunReport(classified, stats, run_totals(stats), res.rounds, batch_id)


def process_in_groups(messages: DataFrame, *, state_path: str, output_path: str, run_id: str,
                      channels: str | DataFrame | None = None, channels_per_commit: int = 100,
                      max_groups: int | None = None, limit_per_channel: int | None = None, processed_at=None,
                      work_dir: str | None = None) -> RunReport:
    """One run that records as it goes, and goes on where it was cut.

    Channels run one after another (Q13), so the messages of the first
    ``channels_per_commit`` channels are decided whatever comes later: each such
    group is ingested against everything recorded before it, its classified
    messages are written below ``output_path``, its accepted ones recorded. The
    state remembers (``run_id``, group); a run started again with the same
    ``run_id`` and channel list leaves out the groups it finished. The outcome
    is that of one whole run. ``max_groups`` ends a run after that many further
    groups (a time slot); the report then covers the groups finished so far."""
    spark = messages.sparkSession
    ch = channels_of(messages) if channels is None else (
        channels if isinstance(channels, DataFrame) else channel_list(spark, channels))
    if limit_per_channel is not None:
        messages = latest_n_per_channel(messages, limit_per_channel).drop("position")
    group = F.floor(F.col("channel_ordinal") / channels_per_commit)
    work = work_dir or scratch_path(spark, "groups")
    rows = in_channel_order(messages, ch).withColumn("_group", group)
    # one pass over the messages, a folder for each group
    rows.write.mode("overwrite").partitionBy("_group").parquet(f"{work}/messages")
    rows = spark.read.schema(rows.schema).parquet(f"{work}/messages")
    tables = open_state(spark, state_path)
    out, rounds, ran, batch_id = f"{output_path}/run_id={run_id}", 0, 0, None
    last = ch.agg(F.max(group)).first()[0]
    for g in range(0 if last is None else last + 1):
        batch_id, done = tables.next_batch(run_id, g)
        if done:
            continue
        if max_groups is not None and ran == max_groups:
            break
        res = ingest(rows.where(F.col("_group") == g).drop("_group"), tables.state(before_batch=batch_id),
                     work_dir=f"{work}/ingest")
        part = f"{out}/channel_group={g}"
        res.messages.write.mode("overwrite").parquet(part)
        # the same record, if the run is cut between the two writes and starts again
        accepted = spark.read.schema(res.messages.schema).parquet(part).where(F.col("status") == F.lit(NEW))
        record_batch(tables, accepted, batch_id, processed_at=processed_at, source=run_id, source_batch=g)
        rounds, ran = rounds + res.rounds, ran + 1
    finished = tables.batches().where(F.col("source") == run_id).select(
        F.col("source_batch").cast("int").alias("channel_group"))
    schema = T.StructType([*_finished_schema(rows).fields, T.StructField("channel_group", T.IntegerType())])
    classified = read_or_empty(spark, out, schema).join(finished, ["channel_group"], "left_semi").drop("channel_group")
    stats = channel_stats(classified, ch)
    return RunReport(classified, stats, run_totals(stats), rounds, batch_id)


def _finished_schema(rows: DataFrame) -> T.StructType:
    """The columns of classified messages."""
    return T.StructType([*[f for f in rows.schema.fields if f.name != "_group"], T.StructField("status", T.StringType()),
                         T.StructField("is_duplicate", T.BooleanType()), T.StructField("reason", T.StringType())])
