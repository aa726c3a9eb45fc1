"""The registered queries: one per operator of the inventory, each reading the
driver's tables, plus the equivalent SQL for DuckDB.

Mappings of the tables onto messages are in ``sources/messages.py``:
D = documents (channel = source, id = doc_id), E = events (channel =
event_type, id = user_id, text = event_type || props, date = ts),
C = conversations (channel = role). Arrival order is doc_id / event_id.

State split for the membership queries: documents that already carry a label
(``labels``) count as processed by an earlier run; the batch is the whole
documents table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import hash_prefix
from ..operators import membership, routing, running_stats, selection, stats, temporal
from ..operators.ingest import IngestState, ingest
from ..operators.refold import refold
from ..sources import channels as ch
from ..sources import datasets, export, snapshots, state_store
from ..sources.messages import FIXTURE_INGEST_TIME  # noqa: F401  (used by the oracle SQL)
from ..sources.messages import (
    conversations_feed, documents_feed, event_messages, events_by_user_feed, events_by_value_feed,
    events_feed,
)
from ..session import FILE_ROWS, materialize, read_or_empty, scratch_path
from .run import process_channels, process_in_groups
from ..streaming import ingest_stream, keyed, reorder

# Parameters of the catalogue queries.
PROCESSED_AT = "2024-02-01 12:00:00"
AS_OF = "2024-01-31 00:00:00"
RECENT_DAYS = 7
RETENTION_DAYS = 10
SPLIT_TS = "2024-01-16 00:00:00"          # "first half" of the events
EVENT_CHANNELS = "view,click,purchase,signup,error,refund"   # a channel setting (K4)
LIMIT_PER_CHANNEL = 100
REPOST_SECONDS = 300
BURST_GAP_SECONDS = 60
BATCH_SIZE = 50
ROUTE_TASK = "summary"
TASK_NAMES = [*routing.TASK_ROUTING, "translate"]
STREAM_BATCHES = 4
LATENESS_SECONDS = 86_400               # how far the shuffled feed is out of order
CHANNELS_PER_COMMIT = 7
SQL_MIN_CHARS = 1000
DATASET_SQL = ("SELECT source, lang, COUNT(*) AS docs, CAST(SUM(n_chars) AS BIGINT) AS chars "
               "FROM {name} WHERE n_chars > ? GROUP BY source, lang")


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def _label_state(spark: SparkSession, sf: str, docs: DataFrame) -> IngestState:
    labelled = docs.join(_t(spark, sf, "labels").select(F.col("doc_id").alias("seq")),
                         ["seq"], "left_semi")
    rows = state_store.tracking_rows(labelled, processed_at=PROCESSED_AT)
    return IngestState(rows.select("channel_id", "message_id"), rows.select("content_hash"))


def _events_ingest(spark: SparkSession, sf: str):
    return ingest(events_feed(spark, sf))


# -- sources / projections ------------------------------------------------------

def q_normalize_messages(spark, sf):
    return documents_feed(spark, sf).drop("content_hash")


def q_content_fingerprint(spark, sf):
    def fp(df, feed):
        return df.select(F.lit(feed).alias("feed"), "channel_id", "message_id", "content_hash",
                         hash_prefix("content_hash").alias("hash_prefix"))
    return fp(documents_feed(spark, sf), "documents").unionByName(
        fp(conversations_feed(spark, sf), "conversations"))


def q_tracking_rows(spark, sf):
    rows = state_store.tracking_rows(events_feed(spark, sf), processed_at=PROCESSED_AT)
    return state_store.tracking_rows_as_text(rows)


def q_distinct_ids(spark, sf):
    log = state_store.tracking_rows(events_feed(spark, sf), processed_at=PROCESSED_AT)
    return state_store.id_state(log)


def q_distinct_hashes(spark, sf):
    log = state_store.tracking_rows(documents_feed(spark, sf), processed_at=PROCESSED_AT)
    return state_store.hash_state(log)


# -- membership against a state ------------------------------------------------------

def _membership_out(df):
    return df.select(F.col("seq").alias("doc_id"), "channel_id", "message_id")


def q_id_members(spark, sf):
    d = documents_feed(spark, sf)
    return _membership_out(membership.id_members(d, _label_state(spark, sf, d)))


def q_content_members(spark, sf):
    d = documents_feed(spark, sf)
    return _membership_out(membership.content_members(d, _label_state(spark, sf, d)))


def q_classify_against_state(spark, sf):
    d = documents_feed(spark, sf)
    c = membership.classify_against_state(d, _label_state(spark, sf, d))
    return c.select(F.col("seq").alias("doc_id"), "status", "is_duplicate", "reason")


def q_filter_against_state(spark, sf):
    d = documents_feed(spark, sf)
    return _membership_out(membership.filter_against_state(d, _label_state(spark, sf, d)))


def q_classify_against_recorded(spark, sf):
    """J1/J2 against a recorded state: only the key ranges of the batch are read."""
    d = documents_feed(spark, sf)
    labelled = d.join(_t(spark, sf, "labels").select(F.col("doc_id").alias("seq")), ["seq"], "left_semi")
    root = f"{scratch_path(spark, 'recorded-labels')}/state"
    state_store.append_batch(state_store.tracking_rows(labelled, processed_at=PROCESSED_AT), root)
    c = membership.classify_against_state(d, state_store.load_state(spark, root))
    return c.select(F.col("seq").alias("doc_id"), "status")


def q_check_counters(spark, sf):
    d = documents_feed(spark, sf)
    return stats.check_counters(membership.classify_against_state(d, _label_state(spark, sf, d)))


# -- ordered ingest --------------------------------------------------------------------

def q_ingest_status(spark, sf):
    res = _events_ingest(spark, sf)
    return res.messages.select(F.col("seq").alias("event_id"), "channel_id", "message_id",
                               "status", "reason")


def q_ingest_documents(spark, sf):
    res = ingest(documents_feed(spark, sf))
    return res.messages.select(F.col("seq").alias("doc_id"), "status", "reason")


def q_ingest_by_channel(spark, sf):
    docs = documents_feed(spark, sf)
    res = ingest(ch.in_channel_order(docs, ch.channels_of(docs)))
    return res.messages.select("channel_ordinal", F.col("seq.seq").alias("doc_id"), "status")


def q_ingest_by_value(spark, sf):
    res = ingest(events_by_value_feed(spark, sf))
    return res.messages.select(F.col("seq").alias("event_id"), "status")


def q_ingest_by_user(spark, sf):
    res = ingest(events_by_user_feed(spark, sf))
    return res.messages.select(F.col("seq").alias("event_id"), "status")


def q_ingest_with_state(spark, sf):
    e = events_feed(spark, sf)
    first = ingest(e.where(F.col("date") < F.lit(SPLIT_TS).cast("timestamp_ntz")))
    rows = state_store.tracking_rows(first.accepted(), processed_at=PROCESSED_AT)
    state = IngestState(rows.select("channel_id", "message_id"), rows.select("content_hash"))
    second = ingest(e.where(F.col("date") >= F.lit(SPLIT_TS).cast("timestamp_ntz")), state)
    return second.messages.select(F.col("seq").alias("event_id"), "status")


def q_accepted_messages(spark, sf):
    res = _events_ingest(spark, sf)
    return res.accepted().select(F.col("seq").alias("event_id"), "channel_id", "message_id")


def q_duplicate_messages(spark, sf):
    res = _events_ingest(spark, sf)
    return res.duplicates().select(F.col("seq").alias("event_id"), "message_id", "reason")


def q_ingest_conversations(spark, sf):
    res = ingest(conversations_feed(spark, sf))
    return res.messages.select("message_id", "channel_id", "status")


def q_dry_run_report(spark, sf):
    docs = documents_feed(spark, sf)
    return process_channels(docs, channels=ch.channels_of(docs), dry_run=True).channel_stats


def _halves(spark, sf):
    e = events_feed(spark, sf)
    cut = F.lit(SPLIT_TS).cast("timestamp_ntz")
    return e.where(F.col("date") < cut), e.where(F.col("date") >= cut)


def _two_runs(spark, sf, root: str, **kwargs):
    """The application run over the first and then the second half of
    the events, on one state folder that carries on by itself."""
    return [process_channels(half, state_path=f"{root}/state", processed_at=PROCESSED_AT, **kwargs)
            for half in _halves(spark, sf)]


def q_continued_runs(spark, sf):
    first, second = _two_runs(spark, sf, scratch_path(spark, "continued-runs"))
    return (first.classified.select(F.col("seq").alias("event_id"), "status")
            .unionByName(second.classified.select(F.col("seq").alias("event_id"), "status")))


def q_resumed_run(spark, sf):
    """A run over all channels that ends after one group of channels and
    is started again."""
    root = scratch_path(spark, "resumed-run")
    for groups in (1, None):
        report = process_in_groups(documents_feed(spark, sf), state_path=f"{root}/state", output_path=f"{root}/out",
                                   run_id="documents", channels_per_commit=CHANNELS_PER_COMMIT,
                                   max_groups=groups, processed_at=PROCESSED_AT)
    return report.classified.select("channel_ordinal", F.col("seq.seq").alias("doc_id"), "status")


def q_recorded_log(spark, sf):
    """K9: the tracking table after two runs."""
    root = scratch_path(spark, "recorded-log")
    _two_runs(spark, sf, root)
    log = state_store.read_log(spark, f"{root}/state")
    return state_store.tracking_rows_as_text(log).select(
        "channel_id", "message_id", "content_hash", "processed_at", "processing_status", "ai_processed")


def q_state_metadata(spark, sf):
    """The metadata that two runs leave behind."""
    root = scratch_path(spark, "state-metadata")
    _two_runs(spark, sf, root)
    return state_store.read_metadata(spark, f"{root}/state").select("key", "value")


def _keys(state: IngestState) -> DataFrame:
    """ID keys and hashes of a state in one table."""
    none = F.lit(None).cast("string")
    return (state.distinct_ids().withColumn("content_hash", none)
            .unionByName(state.distinct_hashes().select(
                none.alias("channel_id"), none.alias("message_id"), "content_hash")))


def q_state_union(spark, sf):
    """The state of a tracking log (first half of the events, ingested as
    batch 0) merged with a JSON state document (second half, ingested on its
    own); set semantics."""
    root = scratch_path(spark, "state-union")
    first, second = _halves(spark, sf)
    state_store.append_batch(state_store.tracking_rows(ingest(first).accepted(), PROCESSED_AT),
                             f"{root}/state")
    accepted = ingest(second).accepted()
    snapshots.write_snapshot(
        IngestState(accepted.select("channel_id", "message_id"), accepted.select("content_hash")),
        f"{root}/snapshot", saved_at=PROCESSED_AT, version=0)
    return _keys(state_store.load_state(spark, f"{root}/state", snapshot_path=f"{root}/snapshot"))


def q_id_only_dedup(spark, sf):
    res = ingest(events_feed(spark, sf), content_layer=False)
    return res.messages.select(F.col("seq").alias("event_id"), "status")


def q_content_only_dedup(spark, sf):
    res = ingest(events_feed(spark, sf), id_layer=False)
    return res.messages.select(F.col("seq").alias("event_id"), "status")


# -- statistics ---------------------------------------------------------------------------

def q_channel_stats(spark, sf):
    events = _events_ingest(spark, sf).messages
    e = stats.channel_stats(events, ch.channels_of(events_feed(spark, sf)))
    d = stats.channel_stats(ingest(documents_feed(spark, sf)).messages)
    d = d.withColumn("channel_ordinal", F.lit(None).cast("int"))
    return (e.withColumn("feed", F.lit("events"))
            .unionByName(d.withColumn("feed", F.lit("documents"))))


def q_listed_channel_stats(spark, sf):
    """K4: a channel setting decides which channels are reported, and their order."""
    return stats.channel_stats(_events_ingest(spark, sf).messages,
                               ch.channel_list(spark, EVENT_CHANNELS))


def q_stats_rollup(spark, sf):
    return stats.stats_rollup(_events_ingest(spark, sf).messages)


def q_run_totals(spark, sf):
    s = stats.channel_stats(_events_ingest(spark, sf).messages)
    return stats.run_totals(s)


def q_duplicates_by_reason(spark, sf):
    return stats.duplicates_by_reason(_events_ingest(spark, sf).messages)


def _accepted_log(spark, sf):
    res = _events_ingest(spark, sf)
    return state_store.tracking_rows(res.accepted(), processed_at=PROCESSED_AT)


def q_tracker_statistics(spark, sf):
    return stats.tracker_statistics(_accepted_log(spark, sf))


def q_ids_per_channel(spark, sf):
    return stats.ids_per_channel(_accepted_log(spark, sf))


def q_channel_throughput(spark, sf):
    return stats.channel_throughput(_events_ingest(spark, sf).messages)


def q_cumulative_daily(spark, sf):
    return stats.cumulative_daily(_events_ingest(spark, sf).messages)


# -- windows, selection, state views ----------------------------------------------------------

def q_latest_per_key(spark, sf):
    e = events_feed(spark, sf)
    log = state_store.tracking_rows(e, processed_at=F.col("date"))
    w1 = state_store.latest_per_key(log)
    return w1.select("channel_id", "message_id", F.col("mark_seq").alias("event_id"),
                     "content_hash")


def q_latest_n_per_channel(spark, sf):
    top = selection.latest_n_per_channel(events_feed(spark, sf), LIMIT_PER_CHANNEL)
    return top.select("channel_id", F.col("seq").alias("event_id"), "position")


def q_recent_messages(spark, sf):
    feed = events_feed(spark, sf, since=(AS_OF, RECENT_DAYS))
    r = selection.recent_messages(feed, AS_OF, RECENT_DAYS)
    return r.select(F.col("seq").alias("event_id"), "channel_id", "message_id")


def q_message_batches(spark, sf):
    # project first: the sliced rows are written once, so carry only what is used
    e = events_feed(spark, sf).select("channel_id", "seq")
    b = selection.message_batches(e, BATCH_SIZE)
    return b.select(F.col("seq").alias("event_id"), "channel_id", "position", "batch_number")


def q_batch_sizes(spark, sf):
    e = events_feed(spark, sf).select("channel_id", "seq")
    return selection.batch_sizes(selection.message_batches(e, BATCH_SIZE))


def q_high_water_mark(spark, sf):
    m = selection.high_water_marks(events_feed(spark, sf))
    return m.select("channel_id", "last_message_id", F.col("mark_seq").alias("mark_event_id"))


def q_after_mark(spark, sf):
    e = events_feed(spark, sf)
    marks = selection.high_water_marks(
        e.where(F.col("date") < F.lit(SPLIT_TS).cast("timestamp_ntz")))
    return selection.after_mark(e, marks).select(F.col("seq").alias("event_id"), "channel_id")


def q_retained_rows(spark, sf):
    """Every event recorded (processed at its own time), the older half
    and the newer half as a batch each; then the retention and what is left."""
    root = f"{scratch_path(spark, 'retention')}/state"
    for half in _halves(spark, sf):
        state_store.append_batch(state_store.tracking_rows(half, processed_at=F.col("date")), root)
    state_store.apply_retention(spark, root, AS_OF, RETENTION_DAYS)
    return state_store.read_log(spark, root).select(
        F.col("mark_seq").alias("event_id"), "channel_id", "message_id")


def q_readmitted_messages(spark, sf):
    """D11 with J5: the events that are kept once those before the retention's
    limit are gone, refolded from what their removal touches."""
    e = events_feed(spark, sf).select("channel_id", "message_id", "content_hash", "seq", "date")
    first = ingest(e.drop("date"))
    limit = F.lit(AS_OF).cast("timestamp_ntz") - F.make_interval(days=F.lit(RETENTION_DAYS))
    out = refold(e.drop("date"), first.kept, removed=e.where(F.col("date") < limit).select("seq"))
    return out.kept.select(F.col("seq").alias("event_id"), "channel_id", "message_id")


# -- time operators --------------------------------------------------------------------------

def q_rapid_reposts(spark, sf):
    e = events_feed(spark, sf).select("channel_id", "content_hash", "date", "seq")
    r = temporal.rapid_reposts(e, REPOST_SECONDS)
    return r.select(F.col("seq").alias("event_id"), "channel_id", "is_repost",
                    F.round("gap_seconds", 6).alias("gap_seconds"))


def q_burst_ids(spark, sf):
    b = temporal.burst_ids(events_feed(spark, sf).select("channel_id", "date", "seq"),
                           BURST_GAP_SECONDS)
    return b.select(F.col("seq").alias("event_id"), "channel_id", "burst_id")


def q_burst_summary(spark, sf):
    e = events_feed(spark, sf).select("channel_id", "content_hash", "date", "seq")
    return temporal.burst_summary(e, BURST_GAP_SECONDS)


# -- routing, SQL ------------------------------------------------------------------------------

def q_model_for_task(spark, sf):
    tasks = (_t(spark, sf, "events").select(F.col("event_type").alias("task"))
             .unionByName(spark.createDataFrame([(t,) for t in TASK_NAMES], "task string"))
             .distinct())
    return tasks.select("task", routing.model_for_task("task").alias("model"))


def q_route_messages(spark, sf):
    r = routing.route_messages(documents_feed(spark, sf), task=F.lit(ROUTE_TASK))
    return r.select(F.col("seq").alias("doc_id"), "task", "tokens", "provider", "model")


def q_sql_over_dataset(spark, sf):
    datasets.register_dataset(spark, "docs", f"{sf.rstrip('/')}/documents.parquet")
    return datasets.execute_query(spark, DATASET_SQL.format(name="docs"), (SQL_MIN_CHARS,),
                                  fetch="all", dataset="docs")


# -- sinks and state documents ---------------------------------------------------------------------

def q_json_roundtrip(spark, sf):
    d = documents_feed(spark, sf)
    path = scratch_path(spark, "json-export")
    export.write_json(d, path)
    back = export.read_json(spark, path, d.select(*export.EXPORT_COLUMNS).schema)
    return back.select("channel_id", "message_id", "text", "content_hash")


def q_csv_roundtrip(spark, sf):
    d = documents_feed(spark, sf)
    path = scratch_path(spark, "csv-export")
    export.write_csv(d, path)
    return export.read_csv(spark, path).select("channel_id", "message_id", "text",
                                               "content_hash")


def q_snapshot_roundtrip(spark, sf):
    return _keys(snapshots.read_snapshot(spark, _documents_snapshot(spark, sf)))


def q_snapshot_documents(spark, sf):
    """What the JSON documents hold, counted on them as they are."""
    docs = (spark.read.schema(snapshots.SNAPSHOT_SCHEMA).json(_documents_snapshot(spark, sf))
            .select("saved_at", F.aggregate(F.map_values("processed_message_ids"), F.lit(0).cast("long"),
                                            lambda n, ids: n + F.size(ids)).alias("ids"),
                    F.size("content_hashes").cast("long").alias("hashes")))
    return docs.groupBy("saved_at").agg(F.sum("ids").alias("ids"), F.sum("hashes").alias("hashes"))


def _documents_snapshot(spark, sf) -> str:
    acc = ingest(documents_feed(spark, sf)).accepted()
    state = IngestState(acc.select("channel_id", "message_id"), acc.select("content_hash"))
    return snapshots.write_snapshot(state, scratch_path(spark, "snapshot"),
                                      saved_at=PROCESSED_AT, version=1, chunk_rows=100)


# -- streaming ----------------------------------------------------------------------------------------

def q_stream_ingest(spark, sf):
    """Events arrive as STREAM_BATCHES files in time order; the stream is run
    after each arrival (availableNow), resuming from its checkpoint."""
    events = _t(spark, sf, "events")
    bounds = events.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    lo, hi = bounds["lo"], bounds["hi"]
    step = (hi - lo) / STREAM_BATCHES
    root = scratch_path(spark, "stream")
    src, out, state = f"{root}/incoming", f"{root}/output", f"{root}/state"
    cuts = [lo + step * i for i in range(1, STREAM_BATCHES)]
    edges = [None, *cuts, None]
    for i in range(STREAM_BATCHES):
        part = events
        if edges[i] is not None:
            part = part.where(F.col("ts") >= F.lit(edges[i]).cast("timestamp_ntz"))
        if edges[i + 1] is not None:
            part = part.where(F.col("ts") < F.lit(edges[i + 1]).cast("timestamp_ntz"))
        part.write.mode("append").parquet(src)
        q = ingest_stream.start_ingest_stream(
            spark, src, events.schema, state_path=state, output_path=out,
            checkpoint_location=f"{root}/checkpoint", to_messages=event_messages,
            processed_at=PROCESSED_AT, compact_every=3)
        q.awaitTermination()
    res = ingest_stream.read_stream_output(spark, out)
    return res.select(F.col("seq").alias("event_id"), "status")


def _arrivals(events, by):
    """The events in STREAM_BATCHES arrivals of equal spans of ``by``, cut in one
    pass. Where the table lies in order of time, an arrival comes from few of its
    splits: their rows go to several files, so that as many tasks read them."""
    spark = events.sparkSession
    span = events.agg(F.min(by).alias("lo"), F.max(by).alias("hi")).first()
    step = (span["hi"] - span["lo"]) / STREAM_BATCHES + 1
    path = scratch_path(spark, "arrivals")
    (events.withColumn("arrival", F.floor((by - span["lo"]) / step)).where("arrival is not null")
     .write.option("maxRecordsPerFile", FILE_ROWS).partitionBy("arrival").parquet(path))
    return [read_or_empty(spark, f"{path}/arrival={i}", events.schema) for i in range(STREAM_BATCHES)]


def _event_micros():
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))


def q_event_order_ingest(spark, sf):
    """The events arrive out of order, each up to LATENESS_SECONDS after its
    date; the reorder buffer puts them in the order of their dates."""
    late = F.pmod(F.xxhash64("event_id"), F.lit(LATENESS_SECONDS * 1_000_000))
    root = scratch_path(spark, "event-order")
    buffer = reorder.ReorderBuffer(spark, f"{root}/buffer", LATENESS_SECONDS)
    parts = _arrivals(_t(spark, sf, "events"), _event_micros() + late)
    parts.append(parts[0].limit(0))                # the feed ends
    for i, part in enumerate(parts):
        ingest_stream.ingest_batch(
            part, i, state_path=f"{root}/state", output_path=f"{root}/out", processed_at=PROCESSED_AT,
            to_messages=ingest_stream.in_event_order(event_messages, buffer, i, i == len(parts) - 1))
    res = ingest_stream.read_stream_output(spark, f"{root}/out")
    return res.select(F.col("seq.seq").alias("event_id"), "status")


def _running_parts(spark, sf):
    root = scratch_path(spark, "running-stats")
    parts = _arrivals(_t(spark, sf, "events"), _event_micros())
    for i in (0, 1, 1, 2, 3):                      # the second arrival is run again
        ingest_stream.ingest_batch(parts[i], i, state_path=f"{root}/state", output_path=f"{root}/out",
                                   to_messages=event_messages, processed_at=PROCESSED_AT, stats_path=f"{root}/stats")
    return running_stats.read_parts(spark, f"{root}/stats")


def q_running_statistics(spark, sf):
    """A1 and A3 from the partial aggregates of four arrivals."""
    parts = materialize(_running_parts(spark, sf), "running-parts")
    none = F.lit(None).cast("long")
    a1 = running_stats.running_channel_stats(parts).select(
        "channel_id", "total_messages", "new_messages", "duplicates", "duplicate_rate_text", none.alias("channels"))
    a3 = running_stats.running_tracker_statistics(parts).select(
        F.lit("all").alias("channel_id"), F.col("total_in_db").alias("total_messages"),
        F.col("total_messages_tracked").alias("new_messages"), F.col("content_hashes").alias("duplicates"),
        F.col("version").alias("duplicate_rate_text"), F.col("channels_tracked").alias("channels"))
    return a1.unionByName(a3)


def q_running_daily(spark, sf):
    """D8 from the partial aggregates of four arrivals."""
    return running_stats.running_daily(_running_parts(spark, sf))


def _run_stream(spark, df, root):
    query = (df.writeStream.format("parquet").option("path", f"{root}/out").outputMode("append")
             .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{root}/out")


def _event_stream(spark, sf, root):
    """The events as files that arrive, read as a stream (as often as asked)."""
    events = _t(spark, sf, "events")
    events.write.parquet(f"{root}/in")
    return lambda: event_messages(spark.readStream.schema(events.schema).parquet(f"{root}/in"))


def q_stream_first_ids(spark, sf):
    """D2 on a stream, ID layer: the keys that were let through, each once."""
    root = scratch_path(spark, "stream-first")
    read = _event_stream(spark, sf, root)
    with keyed.rocksdb(spark):
        first = keyed.first_arrivals(read(), "3650 days").select("channel_id", "message_id")
        return _run_stream(spark, first, root)


def q_stream_reposts(spark, sf):
    """D3 on a stream: the events that repeat a text of their channel."""
    root = scratch_path(spark, "stream-reposts")
    read = _event_stream(spark, sf, root)
    out = keyed.stream_reposts(read(), read(), REPOST_SECONDS, "0 seconds")
    return _run_stream(spark, out.select(F.col("seq").alias("event_id"), "channel_id"), root)


def q_stream_bursts(spark, sf):
    """D5 on a stream: the events as a feed that ends, per-channel sessions of
    messages at most BURST_GAP_SECONDS apart."""
    events = _t(spark, sf, "events").select(F.col("event_type").alias("channel_id"),
                                            F.col("ts").alias("date"))
    root = scratch_path(spark, "stream-bursts")
    # the file source watches a folder: the events land there as arriving files
    events.write.parquet(f"{root}/in")
    ingest_stream.end_of_feed(events, BURST_GAP_SECONDS).write.mode("append").parquet(f"{root}/in")
    msgs = spark.readStream.schema(events.schema).parquet(f"{root}/in")
    q = (ingest_stream.stream_bursts(msgs, BURST_GAP_SECONDS, "0 seconds")
         .select("channel_id", F.col("burst_start").cast("timestamp_ntz").alias("burst_start"),
                 F.col("burst_end").cast("timestamp_ntz").alias("burst_end"), "messages")
         .writeStream.format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/checkpoint").outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "normalize_messages": q_normalize_messages,
    "content_fingerprint": q_content_fingerprint,
    "tracking_rows": q_tracking_rows,
    "distinct_ids": q_distinct_ids,
    "distinct_hashes": q_distinct_hashes,
    "id_members": q_id_members,
    "content_members": q_content_members,
    "classify_against_state": q_classify_against_state,
    "filter_against_state": q_filter_against_state,
    "classify_against_recorded": q_classify_against_recorded,
    "check_counters": q_check_counters,
    "ingest_status": q_ingest_status,
    "ingest_documents": q_ingest_documents,
    "ingest_by_channel": q_ingest_by_channel,
    "ingest_by_value": q_ingest_by_value,
    "ingest_by_user": q_ingest_by_user,
    "ingest_with_state": q_ingest_with_state,
    "accepted_messages": q_accepted_messages,
    "duplicate_messages": q_duplicate_messages,
    "ingest_conversations": q_ingest_conversations,
    "dry_run_report": q_dry_run_report,
    "continued_runs": q_continued_runs,
    "resumed_run": q_resumed_run,
    "recorded_log": q_recorded_log,
    "state_metadata": q_state_metadata,
    "state_union": q_state_union,
    "id_only_dedup": q_id_only_dedup,
    "content_only_dedup": q_content_only_dedup,
    "channel_stats": q_channel_stats,
    "listed_channel_stats": q_listed_channel_stats,
    "stats_rollup": q_stats_rollup,
    "run_totals": q_run_totals,
    "duplicates_by_reason": q_duplicates_by_reason,
    "tracker_statistics": q_tracker_statistics,
    "ids_per_channel": q_ids_per_channel,
    "channel_throughput": q_channel_throughput,
    "cumulative_daily": q_cumulative_daily,
    "latest_per_key": q_latest_per_key,
    "latest_n_per_channel": q_latest_n_per_channel,
    "recent_messages": q_recent_messages,
    "message_batches": q_message_batches,
    "batch_sizes": q_batch_sizes,
    "high_water_mark": q_high_water_mark,
    "after_mark": q_after_mark,
    "retained_rows": q_retained_rows,
    "readmitted_messages": q_readmitted_messages,
    "rapid_reposts": q_rapid_reposts,
    "burst_ids": q_burst_ids,
    "burst_summary": q_burst_summary,
    "model_for_task": q_model_for_task,
    "route_messages": q_route_messages,
    "sql_over_dataset": q_sql_over_dataset,
    "json_roundtrip": q_json_roundtrip,
    "csv_roundtrip": q_csv_roundtrip,
    "snapshot_roundtrip": q_snapshot_roundtrip,
    "snapshot_documents": q_snapshot_documents,
    "stream_ingest": q_stream_ingest,
    "stream_bursts": q_stream_bursts,
    "event_order_ingest": q_event_order_ingest,
    "running_statistics": q_running_statistics,
    "running_daily": q_running_daily,
    "stream_first_ids": q_stream_first_ids,
    "stream_reposts": q_stream_reposts,
}
