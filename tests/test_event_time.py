"""Event-time order, running statistics and keyed state on streams."""

import datetime as dt
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveflow.operators import running_stats, stats
from sieveflow.operators.ingest import IngestState, ingest
from sieveflow.plans import catalog
from sieveflow.streaming import ingest_stream, keyed, reorder
from sieveflow.streaming.reorder import ReorderBuffer
from tests.fold import sequential_fold

SCHEMA = T.StructType([T.StructField("seq", T.LongType()), T.StructField("channel_id", T.StringType()),
                       T.StructField("message_id", T.StringType()), T.StructField("content_hash", T.StringType()),
                       T.StructField("date", T.TimestampNTZType())])
START = dt.datetime(2024, 1, 1)


def to_messages(rows):
    return rows.withColumn("channel_name", F.col("channel_id")).withColumn("text", F.lit(""))


def feed(seed, n=240):
    rng = random.Random(seed)
    return [(i, f"c{rng.randrange(3)}", str(rng.randrange(25)), f"h{rng.randrange(40)}",
             START + dt.timedelta(seconds=rng.randrange(2000))) for i in range(n)]


def by_date(rows):
    """{seq: status} of the fold in order of (date, seq)."""
    order = sorted(rows, key=lambda r: (r[4], r[0]))
    got = sequential_fold([(i, r[1], r[2], r[3]) for i, r in enumerate(order)])
    return {order[i][0]: s for i, s in got.items()}


def arrive(rows, lateness, seed):
    """Rows in the order of an arrival at most ``lateness`` seconds after their date."""
    rng = random.Random(seed)
    return sorted(rows, key=lambda r: r[4] + dt.timedelta(seconds=rng.uniform(0, lateness)))


def stream(spark, tmp_path, arrivals, lateness):
    src = str(tmp_path / "in")
    args = dict(state_path=str(tmp_path / "state"), output_path=str(tmp_path / "out"),
                checkpoint_location=str(tmp_path / "ckpt"), to_messages=to_messages, processed_at="2024-01-01",
                lateness_seconds=lateness, buffer_path=str(tmp_path / "buffer"))
    for part in arrivals:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        ingest_stream.start_ingest_stream(spark, src, SCHEMA, **args).awaitTermination()
    ingest_stream.drain_stream(spark, SCHEMA, **args)
    out = ingest_stream.read_stream_output(spark, args["output_path"])
    return {r["seq"]["seq"]: r["status"] for r in out.collect()}, ReorderBuffer(spark, args["buffer_path"], lateness)


def test_shuffled_arrivals_give_the_answer_of_the_dates(spark, tmp_path):
    rows = feed(1)
    late = arrive(rows, 300, 2)
    got, buffer = stream(spark, tmp_path, [late[i:i + 60] for i in range(0, 240, 60)], 300)
    assert got == by_date(rows)
    assert buffer.marks().agg(F.sum("late_rows")).first()[0] == 0 and buffer.marks().count() == 5


def test_messages_beyond_the_lateness_are_counted_not_lost(spark, tmp_path):
    rows = sorted(feed(3, 120), key=lambda r: r[4])
    old = rows[:5]
    got, buffer = stream(spark, tmp_path, [rows[5:60], rows[60:], old], 10)
    assert got == by_date(rows[5:])
    late = buffer.late_rows(to_messages(spark.createDataFrame([], SCHEMA)).schema)
    assert sorted(r.seq for r in late.collect()) == sorted(r[0] for r in old)
    assert buffer.marks().agg(F.sum("late_rows")).first()[0] == 5


def test_release_again_gives_the_same_rows(spark, tmp_path):
    rows = [spark.createDataFrame(p, SCHEMA) for p in (feed(5, 50), feed(6, 50), feed(7, 50))]
    buffer = ReorderBuffer(spark, str(tmp_path), 500)

    def released(i, end=False):
        return sorted(tuple(r) for r in buffer.release(rows[i], i, end_of_feed=end).collect())

    first = [released(0), released(1)]
    assert released(1) == first[1] and first[0] and first[1]
    rest = released(2, end=True)
    assert rest == released(2, end=True)
    assert buffer.release(rows[0].limit(0), 3, end_of_feed=True).count() == 0
    late = buffer.late_rows(SCHEMA).count()
    assert len(first[0]) + len(first[1]) + len(rest) + late == 150


def test_running_statistics_equal_a_recount(spark, tmp_path):
    """After each of four arrivals, one of them run again with other rows."""
    rows = feed(8)
    arrivals = [rows[i:i + 60] for i in range(0, 240, 60)]
    path = {k: str(tmp_path / k) for k in ("state", "out", "stats")}

    def run(i, part):
        ingest_stream.ingest_batch(spark.createDataFrame(part, SCHEMA), i, state_path=path["state"],
                                   output_path=path["out"], to_messages=to_messages, processed_at="2024-01-01",
                                   stats_path=path["stats"])
        log = spark.read.parquet(path["out"])
        parts = running_stats.read_parts(spark, path["stats"])
        key = lambda df: sorted(map(str, df.collect()))
        assert key(running_stats.running_channel_stats(parts)) == key(stats.channel_stats(log))
        assert key(running_stats.running_daily(parts)) == key(stats.cumulative_daily(log).select(
            running_stats.running_daily(parts).columns))
        want = stats.tracker_statistics(log.where("status = 'new'"))
        assert key(running_stats.running_tracker_statistics(parts)) == key(
            want.select(running_stats.running_tracker_statistics(parts).columns))

    for i, part in enumerate(arrivals):
        run(i, part[:40] if i == 3 else part)
    run(3, arrivals[3])                                       # a replay, now with all its rows
    none = running_stats.read_parts(spark, str(tmp_path / "nothing"))
    assert running_stats.running_tracker_statistics(none).first().total_in_db == 0


def run_stream(spark, df, root):
    q = (df.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/ckpt")
         .trigger(availableNow=True).outputMode("append").start())
    q.awaitTermination()
    return q, spark.read.schema(df.schema).parquet(f"{root}/out")


def test_first_arrivals_and_expiry(spark, tmp_path):
    """With a horizon that covers the feed: the first of each key. With a short
    one, state behind the watermark is dropped and a key may come again."""
    for name, horizon, want in (("long", "10 days", ["1", "2", "3"]), ("short", "60 seconds", ["1", "1", "2", "3"])):
        root, src = str(tmp_path / name), str(tmp_path / name / "in")
        schema = SCHEMA
        with keyed.rocksdb(spark):
            for seq, (mid, at) in enumerate([("1", 0), ("1", 10), ("2", 600), ("3", 1200), ("1", 1300)]):
                spark.createDataFrame([(seq, "c", mid, "h", START + dt.timedelta(seconds=at))], schema) \
                    .write.mode("append").parquet(src)
                s = spark.readStream.schema(schema).parquet(src)
                q, out = run_stream(spark, keyed.first_arrivals(s, horizon).select("message_id"), root)
        assert sorted(r.message_id for r in out.collect()) == want
        state = q.lastProgress["stateOperators"][0]
        assert state["numRowsTotal"] == (3 if name == "long" else 2)
        assert "rocksdb" in str(state["customMetrics"]).lower()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_stream_reposts_equal_batch(spark, tmp_path):
    from sieveflow.operators.temporal import rapid_reposts
    rows = feed(9, 200) + [(1000, "c1", "x", "h1", START), (1001, "c1", "y", "h1", START)]
    df = spark.createDataFrame(rows, SCHEMA)
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    read = lambda: spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    _, out = run_stream(spark, keyed.stream_reposts(read(), read(), 120, "0 seconds").select("seq"), str(tmp_path))
    want = sorted(r.seq for r in rapid_reposts(df, 120).where("is_repost").collect())
    assert sorted(r.seq for r in out.collect()) == want and len(want) > 10


def test_texts_stay_where_they_are_when_nothing_is_live(spark):
    """Every message repeats a recorded one: its join with the few hits is no shuffle of the texts."""
    msgs = to_messages(spark.createDataFrame(feed(7), SCHEMA))
    state = IngestState(msgs.select("channel_id", "message_id"), msgs.select("content_hash"))
    res = ingest(msgs, state)
    plan = res.messages._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert {r["status"] for r in res.messages.collect()} == {"dup_id"}
    assert res.kept.count() == 0 and res.kept.columns == ["channel_id", "message_id", "content_hash", "seq"]


def test_the_buffer_deals_one_tasks_rows_out_to_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(reorder, "FILE_ROWS", 50)
    rows = spark.createDataFrame(feed(8), SCHEMA).coalesce(1)
    got = ReorderBuffer(spark, str(tmp_path), 500).release(rows, 0)
    waiting = spark.read.parquet(f"{tmp_path}/pending/after=0")
    assert got.count() + waiting.count() == 240
    per_file = spark.read.parquet(f"{tmp_path}/pool/batch=0").groupBy(F.input_file_name()).count().collect()
    assert len(per_file) >= 5 and max(r["count"] for r in per_file) <= 50


def test_arrivals_hold_each_row_once(spark, tmp_path, monkeypatch):
    """A file in order of time, repeated rows, rows without a time: in files of bounded rows."""
    monkeypatch.setattr(catalog, "FILE_ROWS", 20)
    rows = [(i, None if i % 50 == 7 else i // 2) for i in range(300)] * 2
    events = spark.createDataFrame(rows, "event_id long, at long").orderBy("at").coalesce(1)
    parts = catalog._arrivals(events, F.col("at"))
    assert len(parts) == catalog.STREAM_BATCHES
    step = 149 / catalog.STREAM_BATCHES + 1
    for i, part in enumerate(parts):
        want = sorted(r for r in rows if r[1] is not None and r[1] // step == i)
        assert sorted(map(tuple, part.collect())) == want
        assert part.columns == events.columns and len(part.inputFiles()) >= len(want) // 20


def test_an_arrival_without_rows(spark):
    parts = catalog._arrivals(spark.createDataFrame([(1, 0), (2, 1000)], "event_id long, at long"), F.col("at"))
    assert [p.count() for p in parts] == [1, 0, 0, 1]
