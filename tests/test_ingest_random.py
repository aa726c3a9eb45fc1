"""The parallel ingest against the sequential fold on small key domains (many
collisions), with and without prior state, with broadcast and shuffled joins."""

import random

import pytest
from pyspark.sql import functions as F

from sieveflow.operators.ingest import IngestState, ingest
from tests.fold import sequential_fold

SCHEMA = "seq long, channel_id string, message_id string, content_hash string"


def random_rows(rng, n, n_chan, n_ids, n_hashes):
    seqs = rng.sample(range(10 * n), n)
    return [(s, f"c{rng.randrange(n_chan)}", str(rng.randrange(n_ids)),
             f"h{rng.randrange(n_hashes)}") for s in seqs]


def run(spark, rows, state_ids=(), state_hashes=()):
    df = spark.createDataFrame(rows, SCHEMA)
    st = IngestState(spark.createDataFrame(list(state_ids), "channel_id string, message_id string"),
                     spark.createDataFrame([(h,) for h in state_hashes], "content_hash string"))
    res = ingest(df, st)
    return {r.seq: r.status for r in res.messages.select("seq", "status").collect()}, res.rounds


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_against_fold(spark, seed):
    rng = random.Random(seed)
    rows = random_rows(rng, 300, 3, 25, 40)
    got, rounds = run(spark, rows)
    assert got == sequential_fold(rows)
    assert rounds >= 1


@pytest.fixture(params=["broadcast", "shuffle"])
def joins(request, spark):
    """Small sides broadcast (as Spark does at this size) and shuffled alike."""
    if request.param == "shuffle":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_random_with_state_against_fold(spark, joins):
    rng = random.Random(4)
    rows = random_rows(rng, 250, 2, 30, 30)
    # one hot hash (a third of the rows share the empty text)
    rows += [(10_000 + i, "c0", str(500 + i), "h_empty") for i in range(150)]
    sid = {(f"c{rng.randrange(2)}", str(rng.randrange(30))) for _ in range(15)}
    sh = {f"h{rng.randrange(30)}" for _ in range(10)}
    got, _ = run(spark, rows, sid, sh)
    assert got == sequential_fold(rows, sid, sh)


def test_two_pass_counterexample(spark):
    rows = [(1, "c", "id1", "h1"), (2, "c", "id2", "h1"), (3, "c", "id2", "h2")]
    got, _ = run(spark, rows)
    assert got == {1: "new", 2: "dup_content", 3: "new"}


def test_chain_needs_many_rounds(spark):
    # each row shares its hash with the previous one and its id with the next one
    rows = []
    for i in range(1, 13):
        rows.append((i, "c", f"id{(i + 1) // 2}", f"h{i // 2}"))
    got, rounds = run(spark, rows)
    assert got == sequential_fold(rows)


def test_layers(spark):
    rows = [(1, "c", "1", "a"), (2, "c", "1", "b"), (3, "c", "2", "a"), (4, "c", "3", "c")]
    df = spark.createDataFrame(rows, SCHEMA)
    only_id = {r.seq: r.status for r in ingest(df, content_layer=False).messages.collect()}
    only_hash = {r.seq: r.status for r in ingest(df, id_layer=False).messages.collect()}
    none = {r.seq: r.status for r in
            ingest(df, id_layer=False, content_layer=False).messages.collect()}
    assert only_id == {1: "new", 2: "dup_id", 3: "new", 4: "new"}
    assert only_hash == {1: "new", 2: "new", 3: "dup_content", 4: "new"}
    assert set(none.values()) == {"new"}


def test_reasons_follow_status(spark):
    rows = [(1, "c", "1", "a"), (2, "c", "1", "b"), (3, "c", "2", "a")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r.seq: r.reason for r in ingest(df).messages.collect()}
    assert out[1] == "No duplicate detected"
    assert out[2] == "Message ID 1 already processed for channel c"
    assert out[3] == "Identical content already processed (hash: a...)"


def test_struct_order_channel_major(spark):
    from sieveflow.sources.channels import channel_list, in_channel_order
    rows = [(1, "a", "1", "x"), (2, "b", "1", "x"), (3, "b", "2", "y")]
    df = spark.createDataFrame(rows, SCHEMA)
    ordered = in_channel_order(df, channel_list(spark, "b,a"))
    got = {(r.channel_id, r.message_id): r.status for r in ingest(ordered).messages.collect()}
    # channel b runs first, so its copy of text x wins
    assert got == {("b", "1"): "new", ("b", "2"): "new", ("a", "1"): "dup_content"}


def test_channel_listed_twice(spark):
    from sieveflow.sources.channels import channel_list, in_channel_order
    rows = [(1, "a", "1", "x"), (2, "a", "2", "x"), (3, "a", "3", "y")]
    df = spark.createDataFrame(rows, SCHEMA)
    ordered = in_channel_order(df, channel_list(spark, "a,a"))
    got = sorted((r.channel_ordinal, r.message_id, r.status)
                 for r in ingest(ordered).messages.collect())
    assert got == [(0, "1", "new"), (0, "2", "dup_content"), (0, "3", "new"),
                   (1, "1", "dup_id"), (1, "2", "dup_content"), (1, "3", "dup_id")]


def test_events_fixture_counts(spark):
    from tests.conftest import SF_CHECK
    from sieveflow.sources.messages import events_feed
    res = ingest(events_feed(spark, SF_CHECK))
    got = {r.status: r["count"] for r in res.messages.groupBy("status").count().collect()}
    assert got == {"new": 500, "dup_id": 6201, "dup_content": 3299}
    assert res.rounds == 5


def test_split_invariance_and_replay(spark, tmp_state):
    """k batches with carried state == one batch; replaying a batch changes nothing."""
    from sieveflow.sources import state_store as ss
    from sieveflow.streaming.ingest_stream import ingest_batch
    rng = random.Random(11)
    rows = sorted(random_rows(rng, 400, 3, 40, 50))
    want = sequential_fold(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    out = tmp_state + "_out"
    cuts = [0, 100, 220, 400]

    def to_messages(b):
        return (b.withColumn("channel_name", F.col("channel_id"))
                .withColumn("text", F.lit("")).withColumn("date", F.lit(None).cast("timestamp_ntz")))

    for i in range(3):
        lo, hi = rows[cuts[i]][0], rows[cuts[i + 1] - 1][0]
        part = df.where((F.col("seq") >= lo) & (F.col("seq") <= hi))
        ingest_batch(part, i, state_path=tmp_state, output_path=out, to_messages=to_messages,
                     processed_at="2024-01-01")
    got = {r.seq: r.status for r in spark.read.parquet(out).collect()}
    assert got == want
    # replay batch 1: same state (batches < 1), same output
    lo, hi = rows[cuts[1]][0], rows[cuts[2] - 1][0]
    ingest_batch(df.where((F.col("seq") >= lo) & (F.col("seq") <= hi)), 1, state_path=tmp_state,
                 output_path=out, to_messages=to_messages, processed_at="2024-01-01")
    again = {r.seq: r.status for r in spark.read.parquet(out).collect()}
    assert again == want
    assert ss.read_log(spark, tmp_state).count() == sum(1 for v in want.values() if v == "new")


def test_layers_with_state(spark):
    rows = [(1, "c", "1", "a"), (2, "c", "2", "b"), (3, "c", "2", "a"), (4, "c", "3", "d")]
    df = spark.createDataFrame(rows, SCHEMA)
    st = IngestState(spark.createDataFrame([("c", "2")], "channel_id string, message_id string"),
                     spark.createDataFrame([("d",)], "content_hash string"))
    only_id = {r.seq: r.status for r in ingest(df, st, content_layer=False).messages.collect()}
    only_hash = {r.seq: r.status for r in ingest(df, st, id_layer=False).messages.collect()}
    assert only_id == {1: "new", 2: "dup_id", 3: "dup_id", 4: "new"}
    assert only_hash == {1: "new", 2: "new", 3: "dup_content", 4: "dup_content"}


def test_membership_against_sets(spark, joins):
    """J1-J4 against plain sets, the state being a union of two."""
    from sieveflow.operators import membership
    rng = random.Random(9)
    rows = random_rows(rng, 200, 2, 10, 8)
    df = spark.createDataFrame(rows, SCHEMA)

    def part(which):
        return IngestState(df.where(f"seq % 3 = 0 and seq % 2 = {which}").select("channel_id", "message_id"),
                           df.where(f"seq % 25 = {which}").select("content_hash"))

    st = part(0).union(part(1))
    ids = {(c, m) for s, c, m, _ in rows if s % 3 == 0}
    hashes = {h for s, _, _, h in rows if s % 25 < 2}
    by_id = sorted(s for s, c, m, _ in rows if (c, m) in ids)
    by_hash = sorted(s for s, _, _, h in rows if h in hashes)
    assert sorted(r.seq for r in membership.id_members(df, st).collect()) == by_id
    assert sorted(r.seq for r in membership.content_members(df, st).collect()) == by_hash
    assert (sorted(r.seq for r in membership.filter_against_state(df, st).collect())
            == sorted({r[0] for r in rows} - set(by_id) - set(by_hash)))
    got = {r.seq: r.status for r in membership.classify_against_state(df, st).collect()}
    assert got == {r[0]: "dup_id" if r[0] in by_id else "dup_content" if r[0] in by_hash else "new"
                   for r in rows}


def test_null_keys_fail_fast(spark):
    df = spark.createDataFrame([(1, "c", "1", None), (2, "c", "2", None)], SCHEMA)
    with pytest.raises(ValueError):
        ingest(df)


def test_empty_input(spark):
    df = spark.createDataFrame([], SCHEMA)
    res = ingest(df)
    assert res.rounds == 0 and res.messages.count() == 0
    from sieveflow.operators.stats import channel_stats, run_totals
    from sieveflow.sources.channels import channel_list
    stats = channel_stats(res.messages, channel_list(spark, "a,b"))
    assert [(r.channel_id, r.total_messages, r.duplicate_rate_text) for r in
            stats.orderBy("channel_ordinal").collect()] == [("a", 0, "0%"), ("b", 0, "0%")]
    assert run_totals(stats).first().duplicate_rate_text == "0%"


def test_round_tables_of_an_earlier_call_are_not_read(spark, tmp_path):
    chain = [(i, "c", f"id{(i + 1) // 2}", f"h{i // 2}") for i in range(1, 13)]
    short = [(1, "c", "id9", "h9"), (2, "c", "id9", "h8")]
    for rows in (chain, short):
        res = ingest(spark.createDataFrame(rows, SCHEMA), work_dir=str(tmp_path / "work"))
        assert {r.seq: r.status for r in res.messages.collect()} == sequential_fold(rows)
