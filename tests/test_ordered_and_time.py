"""Sliced ordered scans against plain per-group windows, on data with one hot
group, and the time operators built on them."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from sieveflow.operators import ordered, selection, temporal

SCHEMA = "channel_id string, content_hash string, date timestamp_ntz, seq long"


def frame(spark, n=600, seed=3):
    import datetime as dt
    rng = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for s in range(n):
        ch = "hot" if rng.random() < 0.5 else f"c{rng.randrange(4)}"
        rows.append((ch, f"h{rng.randrange(6)}", base + dt.timedelta(seconds=rng.randrange(5000)),
                     s))
    return spark.createDataFrame(rows, SCHEMA)


def test_scan_rank_and_lag_equal_window(spark):
    df = frame(spark)
    got = ordered.ordered_scan(df, ["channel_id"], ["date", "seq"], lag=["date", "seq"],
                               slices=7)
    w = Window.partitionBy("channel_id").orderBy("date", "seq")
    want = df.select("seq", F.row_number().over(w).alias("rank"),
                     F.lag("date").over(w).alias("prev_date"),
                     F.lag("seq").over(w).alias("prev_seq"))
    a = {r.seq: (r["rank"], r.prev_date, r.prev_seq) for r in got.collect()}
    b = {r.seq: (r["rank"], r.prev_date, r.prev_seq) for r in want.collect()}
    assert a == b
    # the hot channel really was cut into several slices
    assert got.where("channel_id = 'hot'").select("_slice").distinct().count() > 1


def test_bursts_equal_plain_windows(spark):
    df = frame(spark)
    got = temporal.burst_ids(df, 30, slices=6)
    w = Window.partitionBy("channel_id").orderBy("date", "seq")
    gap = F.timestamp_diff("SECOND", F.lag("date").over(w), F.col("date"))
    start = F.when(F.lag("date").over(w).isNull() | (gap > 30), 1).otherwise(0)
    want = (df.withColumn("st", start)
            .withColumn("burst_id", F.sum("st").over(w.rowsBetween(Window.unboundedPreceding,
                                                                    Window.currentRow))))
    assert ({r.seq: r.burst_id for r in got.collect()}
            == {r.seq: r.burst_id for r in want.collect()})


def test_reposts_flag(spark):
    rows = [("c", "h", "2024-01-01 00:00:00", 1), ("c", "h", "2024-01-01 00:04:00", 2),
            ("c", "h", "2024-01-01 00:10:00", 3), ("d", "h", "2024-01-01 00:10:01", 4)]
    df = spark.createDataFrame(rows, "channel_id string, content_hash string, d string, seq long")
    df = df.withColumn("date", F.col("d").cast("timestamp_ntz")).drop("d")
    got = {r.seq: r.is_repost for r in temporal.rapid_reposts(df, 300, slices=2).collect()}
    assert got == {1: False, 2: True, 3: False, 4: False}


def test_batches_and_limit(spark):
    df = frame(spark, n=200)
    b = selection.message_batches(df, 7, slices=3)
    sizes = selection.batch_sizes(b).collect()
    assert all(r.messages <= 7 for r in sizes)
    top = selection.latest_n_per_channel(df, 5)
    assert top.groupBy("channel_id").count().where("count > 5").count() == 0
    from tests.test_catalog import plan_text
    assert "WindowGroupLimit" in plan_text(top)


def test_high_water_mark_and_after(spark):
    df = frame(spark, n=100).withColumn("message_id", F.col("seq").cast("string"))
    marks = selection.high_water_marks(df.where("seq < 50"))
    after = selection.after_mark(df, marks)
    m = {r.channel_id: (r.mark_date, r.mark_seq) for r in marks.collect()}
    for r in after.collect():
        if r.channel_id in m:
            assert (r.date, r.seq) > m[r.channel_id]
    n_after = sum(1 for r in df.collect()
                  if r.channel_id not in m or (r.date, r.seq) > m[r.channel_id])
    assert after.count() == n_after


def test_scan_with_struct_order(spark):
    rows = [(f"c{i % 2}", i // 7, i % 7) for i in range(70)]
    df = (spark.createDataFrame(rows, "channel_id string, a long, b long")
          .withColumn("seq", F.struct("a", "b")))
    got = ordered.ordered_scan(df, ["channel_id"], ["seq"], slices=5)
    w = Window.partitionBy("channel_id").orderBy("seq")
    want = df.withColumn("rank", F.row_number().over(w))
    key = lambda r: (r.channel_id, r.a, r.b)
    assert ({key(r): r["rank"] for r in got.collect()}
            == {key(r): r["rank"] for r in want.collect()})
