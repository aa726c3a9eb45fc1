"""Structured Streaming forms: session-window bursts and the foreachBatch
ingest resuming from its checkpoint."""

import datetime as dt

from pyspark.sql import types as T

from sieveflow.operators import temporal
from sieveflow.streaming import ingest_stream
from tests.fold import sequential_fold

SCHEMA = T.StructType([
    T.StructField("channel_id", T.StringType()),
    T.StructField("content_hash", T.StringType()),
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
])


def test_stream_bursts_equal_batch_bursts(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    offsets = [0, 10, 70, 71, 200, 260, 261, 400, 460, 1000, 1060]  # 60 s apart merges
    rows = [("c", f"h{i % 2}", base + dt.timedelta(seconds=s), i) for i, s in enumerate(offsets)]
    rows += [("d", "h", base + dt.timedelta(seconds=s), 100 + i) for i, s in enumerate([5, 500])]
    src = str(tmp_path / "in")
    feed = spark.createDataFrame(rows, SCHEMA).select("channel_id", "date")
    feed.write.parquet(src)
    ingest_stream.end_of_feed(feed, 60).write.mode("append").parquet(src)
    stream = spark.readStream.schema(feed.schema).parquet(src)
    q = (ingest_stream.stream_bursts(stream, 60, "0 seconds").writeStream
         .format("memory").queryName("bursts_t").outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    streamed = sorted((r.channel_id, r.burst_start.replace(tzinfo=None), r.messages)
                      for r in spark.table("bursts_t").collect())
    batch = temporal.burst_summary(spark.createDataFrame(rows, SCHEMA), 60, slices=3)
    assert streamed == sorted((r.channel_id, r.burst_start, r.messages) for r in batch.collect())


def test_stream_ingest_resumes(spark, tmp_path):
    schema = T.StructType([T.StructField("seq", T.LongType()),
                           T.StructField("channel_id", T.StringType()),
                           T.StructField("message_id", T.StringType()),
                           T.StructField("text", T.StringType())])
    arrivals = [
        [(1, "c", "1", "a"), (2, "c", "2", "a"), (3, "c", "2", "b")],
        [(4, "c", "3", "b"), (5, "c", "1", "z"), (6, "c", "4", "c")],
        [(7, "d", "1", "c"), (8, "d", "2", "new")],
    ]
    src, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))

    def to_messages(b):
        from sieveflow.sources.messages import normalize_messages, with_fingerprint
        return with_fingerprint(normalize_messages(
            b.withColumnRenamed("message_id", "id"), ingest_time="2024-01-01"))

    for rows in arrivals:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        q = ingest_stream.start_ingest_stream(
            spark, src, schema, state_path=state, output_path=out,
            checkpoint_location=str(tmp_path / "ckpt"), to_messages=to_messages,
            processed_at="2024-01-01")
        q.awaitTermination()
    res = ingest_stream.read_stream_output(spark, out)
    got = {r.seq: r.status for r in res.collect()}
    import hashlib
    flat = [(s, c, m, hashlib.sha256(t.encode()).hexdigest())
            for rows in arrivals for s, c, m, t in rows]
    assert got == sequential_fold(flat)
    assert res.select("batch_id").distinct().count() == 3


def test_split_invariance_replay_and_compaction(spark, tmp_path):
    import random
    from pyspark.sql import functions as F
    from sieveflow.sources.state_store import open_state
    from sieveflow.streaming.ingest_stream import ingest_batch
    rng = random.Random(5)
    rows = sorted((s, f"c{rng.randrange(3)}", str(rng.randrange(40)), f"h{rng.randrange(50)}")
                  for s in rng.sample(range(4000), 400))
    df = spark.createDataFrame(rows, "seq long, channel_id string, message_id string, "
                                     "content_hash string")
    state, out = str(tmp_path / "state"), str(tmp_path / "out")

    def to_messages(b):
        return (b.withColumn("channel_name", F.col("channel_id")).withColumn("text", F.lit(""))
                .withColumn("date", F.lit(None).cast("timestamp_ntz")))

    cuts = [0, 150, 260, 400]
    parts = [df.where((F.col("seq") >= rows[cuts[i]][0]) & (F.col("seq") <= rows[cuts[i + 1] - 1][0]))
             for i in range(3)]
    for i, part in enumerate(parts):
        ingest_batch(part, i, state_path=state, output_path=out, to_messages=to_messages,
                     processed_at="2024-01-01")
    ingest_batch(parts[1], 1, state_path=state, output_path=out, to_messages=to_messages,
                 processed_at="2024-01-01")          # replay
    got = {r.seq: r.status for r in spark.read.parquet(out).collect()}
    assert got == sequential_fold(rows)
    tables = open_state(spark, state)
    kept = sum(1 for v in got.values() if v == "new")
    assert tables.log().count() == kept
    tables.compact()
    assert tables.log().count() == kept and tables.state().distinct_hashes().count() == kept


def test_stream_sees_earlier_batches(spark, tmp_path):
    """foreachBatch runs in a cloned session: state written by one micro-batch
    must be visible to the next."""
    schema = T.StructType([T.StructField("seq", T.LongType()),
                           T.StructField("channel_id", T.StringType()),
                           T.StructField("message_id", T.StringType()),
                           T.StructField("text", T.StringType())])
    arrivals = [[(1, "c", "1", "a")], [(2, "c", "1", "b"), (3, "c", "2", "a")],
                [(4, "c", "3", "c")], [(5, "c", "3", "d")]]
    src, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))

    def to_messages(b):
        from sieveflow.sources.messages import normalize_messages, with_fingerprint
        return with_fingerprint(normalize_messages(
            b.withColumnRenamed("message_id", "id"), ingest_time="2024-01-01"))

    for rows in arrivals:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        ingest_stream.start_ingest_stream(
            spark, src, schema, state_path=state, output_path=out,
            checkpoint_location=str(tmp_path / "ckpt"), to_messages=to_messages,
            processed_at="2024-01-01").awaitTermination()
    got = {r.seq: r.status for r in ingest_stream.read_stream_output(spark, out).collect()}
    assert got == {1: "new", 2: "dup_id", 3: "dup_content", 4: "new", 5: "dup_id"}


def _to_messages(b):
    from sieveflow.sources.messages import normalize_messages, with_fingerprint
    return with_fingerprint(normalize_messages(
        b.withColumnRenamed("message_id", "id"), ingest_time="2024-01-01"))


def test_new_stream_on_an_old_state_goes_on(spark, tmp_path):
    """A checkpoint that is set back starts at micro-batch 0 again; the state
    must not take that for a replay."""
    schema = T.StructType([T.StructField("seq", T.LongType()),
                           T.StructField("channel_id", T.StringType()),
                           T.StructField("message_id", T.StringType()),
                           T.StructField("text", T.StringType())])
    for run, rows in enumerate([[(1, "c", "1", "a")], [(2, "c", "1", "b"), (3, "c", "2", "d")]]):
        src = str(tmp_path / f"in{run}")
        spark.createDataFrame(rows, schema).write.parquet(src)
        ingest_stream.start_ingest_stream(
            spark, src, schema, state_path=str(tmp_path / "state"), output_path=str(tmp_path / "out"),
            checkpoint_location=str(tmp_path / f"ckpt{run}"), to_messages=_to_messages,
            processed_at="2024-01-01").awaitTermination()
    got = {r.seq: r.status for r in ingest_stream.read_stream_output(spark, str(tmp_path / "out")).collect()}
    assert got == {1: "new", 2: "dup_id", 3: "new"}


def test_number_of_files_stays_flat(spark, tmp_path):
    from sieveflow.sources.state_store import open_state
    root, most = str(tmp_path / "state"), []
    schema = "seq long, channel_id string, message_id string, text string"
    for i in range(9):
        batch = spark.createDataFrame([(i, "c", str(i), f"t{i}")], schema)
        ingest_stream.ingest_batch(batch, i, state_path=root, output_path=str(tmp_path / "out"),
                                   to_messages=_to_messages, processed_at="2024-01-01", compact_every=3)
        most.append(sum(1 for t in ("tracking", "hashes") for _ in (tmp_path / "state" / t).rglob("*.parquet")))
    assert open_state(spark, root).log().count() == 9
    # a day with more than 8 files is rewritten as one
    assert max(most) <= 2 * 9 and most[8] == 2


def _plan(df) -> str:
    buf = __import__("io").StringIO()
    with __import__("contextlib").redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_history_is_not_shuffled(spark, tmp_path):
    """IDs and hashes: a small batch is broadcast, the history does not move."""
    from pyspark.sql import functions as F
    from sieveflow.operators.ingest import HASH_KEY, ID_KEY
    from sieveflow.session import materialize
    from sieveflow.sources.state_store import open_state, tracking_rows
    history = _to_messages(spark.range(500).select(
        F.col("id").alias("seq"), F.lit("c").alias("channel_id"),
        F.col("id").cast("string").alias("message_id"), F.col("id").cast("string").alias("text")))
    batch = materialize(history.where("seq % 5 = 0"), "batch")
    tables = open_state(spark, str(tmp_path / "state"))
    tables.append(tracking_rows(history, processed_at="2024-01-01"))
    for key in (ID_KEY, HASH_KEY):
        hits = tables.state().hits(batch, key)
        # an exchange, if any, is above the join: the distinct hits
        assert "Exchange hashpartitioning" not in _plan(hits).split("BroadcastHashJoin")[1]
        assert hits.count() == 100
