"""Statistics, state store, sinks, routing, SQL datasets, the application run
and the streaming forms."""

import json

import pytest
from pyspark.sql import functions as F

from sieveflow.operators import routing, stats
from sieveflow.operators.ingest import IngestState, ingest
from sieveflow.plans.run import process_channels
from sieveflow.sources import datasets, export
from sieveflow.sources import snapshots, state_store as ss
from sieveflow.sources.channels import channel_list
from tests.conftest import SF_CHECK
from tests.helpers import msgs


def test_channel_list_like_python_split(spark):
    for s in ["a,b,c", "a,,b", "a,b,", " a , b", "a,a"]:
        got = [r.channel for r in channel_list(spark, s).orderBy("channel_ordinal").collect()]
        assert got == s.split(",")
    assert channel_list(spark, "").count() == 0
    assert channel_list(spark, None).count() == 0


def test_channel_stats_with_list(spark):
    rows = [("1", "a", "x"), ("2", "a", "x"), ("3", "b", "y")]
    res = ingest(msgs(spark, rows))
    out = stats.channel_stats(res.messages, channel_list(spark, "a,b,c"))
    got = {r.channel_id: (r.total_messages, r.new_messages, r.duplicates, r.duplicate_rate_text)
           for r in out.collect()}
    assert got == {"a": (2, 1, 1, "50.0%"), "b": (1, 1, 0, "0.0%"), "c": (0, 0, 0, "0%")}
    tot = stats.run_totals(out).first()
    assert (tot.channels_processed, tot.total_messages, tot.duplicates,
            tot.duplicate_rate_text) == (3, 3, 1, "33.3%")


def test_run_totals_empty(spark):
    empty = stats.channel_stats(ingest(msgs(spark, [("1", "a", "x")])).messages,
                                channel_list(spark, "zz"))
    tot = stats.run_totals(empty.where("false")).first()
    assert (tot.channels_processed, tot.total_messages, tot.duplicate_rate_text) == (0, 0, "0%")


def test_rollup_totals(spark):
    rows = [("1", "a", "x"), ("2", "a", "x"), ("3", "b", "y")]
    out = stats.stats_rollup(ingest(msgs(spark, rows)).messages)
    total = out.where("channel_id is null").first()
    assert (total.total_messages, total.duplicates) == (3, 1)


def test_model_lookup(spark):
    tasks = ["summary", "analysis", "quick", "code", "complex", "default", "other"]
    df = spark.createDataFrame([(t,) for t in tasks], "task string")
    got = {r.task: r.model for r in df.select("task", routing.model_for_task("task")
                                              .alias("model")).collect()}
    assert got == {"summary": "llama3.1:8b", "analysis": "deepseek-r1:32b",
                   "quick": "phi3:mini", "code": "codellama:34b",
                   "complex": "deepseek-r1:32b", "default": "llama3.1:8b",
                   "other": "llama3.1:8b"}


def test_routing_switches(spark):
    rows = [("1", "a", "short"), ("2", "a", "x" * 9000)]
    m = msgs(spark, rows)
    local = {r.message_id: r.provider for r in
             routing.route_messages(m, task=F.lit("quick")).collect()}
    assert local == {"1": "local", "2": "remote"}
    primary = routing.route_messages(m, task=F.lit("analysis"), local_ai_primary=True,
                                     fallback_enabled=False)
    assert {r.provider for r in primary.collect()} == {"local"}
    off = routing.route_messages(m, use_local_ai=False)
    assert {r.model for r in off.collect()} == {routing.REMOTE_MODEL}


def test_latest_per_key_last_write_wins(spark, tmp_state):
    m = msgs(spark, [("1", "a", "old"), ("2", "a", "b")])
    ss.append_batch(ss.tracking_rows(m, processed_at="2024-01-01"), tmp_state, 0)
    m2 = msgs(spark, [("1", "a", "new")])
    ss.append_batch(ss.tracking_rows(m2, processed_at="2024-01-02"), tmp_state, 1)
    log = ss.read_log(spark, tmp_state)
    latest = {r.message_id: r.content_hash for r in ss.latest_per_key(log).collect()}
    new_hash = m2.first().content_hash
    assert latest["1"] == new_hash and len(latest) == 2
    # the hash memory keeps the replaced row's hash (Q11)
    s = stats.tracker_statistics(log).first()
    assert (s.total_in_db, s.content_hashes) == (2, 3)
    # batches below 1 only: the state before the second write
    assert ss.read_log(spark, tmp_state, before_batch=1).count() == 2


def test_snapshot_roundtrip_and_reference_document(spark, tmp_path):
    m = msgs(spark, [("1", "a", "x"), ("2", "a", "y"), ("3", "b", "z")])
    st = IngestState(m.select("channel_id", "message_id"), m.select("content_hash"))
    out = snapshots.write_snapshot(st, str(tmp_path / "snap"), saved_at="2024-01-01T00:00:00",
                            version=3, chunk_rows=2)
    back = snapshots.read_snapshot(spark, out)
    assert sorted(tuple(r) for r in back.ids.collect()) == [("a", "1"), ("a", "2"), ("b", "3")]
    assert back.hashes.count() == 3
    # a single indented document as the reference writes it
    doc = {"processed_message_ids": {"c": ["9", "8"]}, "content_hashes": ["h1"],
           "last_message_ids": {}, "saved_at": "2024-01-01T00:00:00"}
    p = tmp_path / "state.json"
    p.write_text(json.dumps(doc, indent=2))
    ref = snapshots.read_snapshot(spark, str(p), multi_line=True)
    assert sorted(tuple(r) for r in ref.ids.collect()) == [("c", "8"), ("c", "9")]
    assert [r[0] for r in ref.hashes.collect()] == ["h1"]


def test_load_state_merges_snapshot(spark, tmp_state, tmp_path):
    ss.append_batch(ss.tracking_rows(msgs(spark, [("1", "a", "x")]), processed_at="2024-01-01"),
                    tmp_state, 0)
    snap = IngestState(spark.createDataFrame([("b", "7")], "channel_id string, message_id string"),
                       spark.createDataFrame([("hh",)], "content_hash string"))
    path = snapshots.write_snapshot(snap, str(tmp_path / "s"), saved_at="x")
    st = ss.load_state(spark, tmp_state, snapshot_path=path)
    assert st.distinct_ids().count() == 2 and st.distinct_hashes().count() == 2


def test_retention(spark):
    m = msgs(spark, [("1", "a", "x"), ("2", "a", "y")])
    log = ss.tracking_rows(m, processed_at=F.when(F.col("message_id") == "1",
                                                 F.lit("2024-01-01")).otherwise("2024-01-20"))
    kept, removed = ss.retention_split(log, "2024-01-25", 10)
    assert [r.message_id for r in kept.collect()] == ["2"]
    assert [r.message_id for r in removed.collect()] == ["1"]


def test_csv_and_json_sinks_keep_multiline_text(spark, tmp_path):
    m = msgs(spark, [("1", "a", 'line one\nline "two", with comma'), ("2", "b", "plain")])
    export.write_csv(m, str(tmp_path / "csv"))
    back = export.read_csv(spark, str(tmp_path / "csv"))
    assert sorted(r.text for r in back.collect()) == sorted(r.text for r in m.collect())
    export.write_json(m, str(tmp_path / "json"))
    j = export.read_json(spark, str(tmp_path / "json"), m.select(*export.EXPORT_COLUMNS).schema)
    assert sorted(r.text for r in j.collect()) == sorted(r.text for r in m.collect())


def test_sql_over_named_dataset(spark, tmp_path):
    path = f"{SF_CHECK}/documents.parquet"
    datasets.register_dataset(spark, "docs_t", path)
    one = datasets.execute_query(spark, "SELECT doc_id FROM docs_t WHERE n_chars > ? "
                                        "ORDER BY doc_id", (100,), fetch="one", dataset="docs_t")
    assert one.count() == 1
    with pytest.raises(ValueError):
        datasets.execute_query(spark, "SELECT 1", dataset="not_registered")


def test_process_channels_records_and_dry_run(spark, tmp_state):
    m = msgs(spark, [("1", "a", "x"), ("2", "a", "x"), ("3", "b", "y")])
    dry = process_channels(m, channels="a,b", state_path=tmp_state, dry_run=True,
                           processed_at="2024-01-01")
    assert dry.totals.first().new_messages == 2
    assert ss.read_log(spark, tmp_state).count() == 0
    run = process_channels(m, channels="a,b", state_path=tmp_state, processed_at="2024-01-01")
    assert (run.batch_id, run.totals.first().new_messages) == (0, 2)
    again = process_channels(m, channels="a,b", state_path=tmp_state, processed_at="2024-01-02")
    assert (again.batch_id, again.totals.first().new_messages) == (1, 0)
    # another run keeps what is recorded
    process_channels(msgs(spark, [("9", "a", "z")]), state_path=tmp_state, processed_at="2024-01-03")
    assert sorted(r.message_id for r in ss.read_log(spark, tmp_state).collect()) == ["1", "3", "9"]


def test_recorded_batch_is_replaced_by_a_replay_only(spark, tmp_state):
    first = msgs(spark, [("1", "a", "x"), ("2", "a", "y")])
    process_channels(first, state_path=tmp_state, processed_at="2024-01-01")
    other = msgs(spark, [("1", "a", "x"), ("3", "a", "q")])
    with pytest.raises(ValueError):
        process_channels(other, state_path=tmp_state, batch_id=0, processed_at="2024-01-01")
    run = process_channels(other, state_path=tmp_state, batch_id=0, replay=True,
                           processed_at="2024-01-01")
    assert run.totals.first().new_messages == 2
    assert sorted(r.message_id for r in ss.read_log(spark, tmp_state).collect()) == ["1", "3"]


def test_channels_of_a_feed_leave_nothing_out(spark):
    from sieveflow.sources.channels import channels_of
    m = msgs(spark, [(str(i), "big", f"t{i}") for i in range(1500)] + [("1", "", "x"), ("2", "odd", "y")])
    assert [tuple(r) for r in channels_of(m).orderBy("channel_ordinal").collect()] == [
        (0, ""), (1, "big"), (2, "odd")]
    run = process_channels(m, channels=channels_of(m), dry_run=True)
    assert {r.channel_id: r.total_messages for r in run.channel_stats.collect()} == {
        "": 1, "big": 1500, "odd": 1}


def test_snapshot_is_merged_and_written(spark, tmp_state, tmp_path):
    snap = str(tmp_path / "snapshots")
    process_channels(msgs(spark, [("1", "a", "x")]), state_path=tmp_state, snapshot_path=snap,
                     processed_at="2024-01-01")
    # a new state folder starts from the documents alone
    run = process_channels(msgs(spark, [("1", "a", "q"), ("2", "a", "x"), ("3", "a", "z")]),
                           state_path=str(tmp_path / "other"), snapshot_path=snap,
                           processed_at="2024-01-02", batch_id=1)
    assert {r.message_id: r.status for r in run.classified.collect()} == {
        "1": "dup_id", "2": "dup_content", "3": "new"}
    latest = snapshots.read_latest_snapshot(spark, snap)
    assert sorted(r.message_id for r in latest.distinct_ids().collect()) == ["1", "3"]


def test_state_goes_on_in_another_run(spark, tmp_state):
    ids = [(str(i), "a", f"t{i}") for i in range(200)]
    process_channels(msgs(spark, ids), state_path=tmp_state, processed_at="2024-01-01")
    assert ss.load_state(spark, tmp_state).distinct_ids().count() == 200
    again = process_channels(msgs(spark, [(i, c, t + " edited") for i, c, t in ids]),
                             state_path=tmp_state, processed_at="2024-01-02")
    assert again.totals.first().new_messages == 0


def test_last_write_with_channel_order(spark, tmp_state):
    from sieveflow.sources.channels import in_channel_order
    m = msgs(spark, [("1", "a", "first"), ("1", "a", "second")])
    rows = ss.tracking_rows(in_channel_order(m, channel_list(spark, "b,a")), processed_at="2024-01-01")
    assert {(r.mark_ordinal, r.mark_seq) for r in rows.collect()} == {(1, 1), (1, 2)}
    ss.append_batch(rows, tmp_state)
    latest = ss.latest_per_key(ss.read_log(spark, tmp_state)).first()
    assert latest.content_hash == m.where("seq = 2").first().content_hash


def test_empty_channel_survives_json(spark, tmp_path):
    m = msgs(spark, [("1", "", "x"), ("2", "a/b", "y"), ("3", None, "z")])
    export.write_json(m, str(tmp_path / "json"))
    back = export.read_json(spark, str(tmp_path / "json"), m.select(*export.EXPORT_COLUMNS).schema)
    assert sorted((r.channel_id, r.message_id) for r in back.collect()) == [
        ("", "1"), ("", "3"), ("a/b", "2")]


def test_sql_changes_nothing(spark):
    from pyspark.errors import ParseException
    spark.range(3).createOrReplaceTempView("keep_me")
    with pytest.raises(ParseException):
        datasets.execute_query(spark, "DROP VIEW keep_me", dataset="keep_me")
    with pytest.raises(ParseException):
        datasets.execute_query(spark, "SELECT 1); DROP VIEW keep_me --")
    assert datasets.execute_query(spark, "WITH a AS (SELECT * FROM keep_me) SELECT * FROM a -- all",
                                  fetch="all").count() == 3


def test_limit_per_channel_in_run(spark):
    m = msgs(spark, [(str(i), "a", f"t{i}") for i in range(10)])
    run = process_channels(m, limit_per_channel=3)
    assert run.totals.first().total_messages == 3


def test_value_and_user_mappings(spark):
    from sieveflow.sources.messages import events_by_user_feed, events_by_value_feed
    v = ingest(events_by_value_feed(spark, SF_CHECK))
    assert v.accepted().count() == 750
    u = ingest(events_by_user_feed(spark, SF_CHECK))
    assert u.accepted().count() == 150 and u.rounds == 6


def test_snapshot_keeps_marks(spark, tmp_path):
    from sieveflow.operators.selection import high_water_marks
    m = msgs(spark, [("1", "a", "x"), ("2", "a", "y"), ("3", "b", "z")])
    st = IngestState(m.select("channel_id", "message_id"), m.select("content_hash"))
    marks = high_water_marks(m).select("channel_id", F.col("last_message_id").alias("message_id"))
    out = snapshots.write_snapshot(st, str(tmp_path / "s"), saved_at="x", marks=marks)
    got = {r.channel_id: r.last_message_id for r in snapshots.read_marks(spark, out).collect()}
    assert got == {"a": "2", "b": "3"}


def test_process_channels_goes_on_from_its_state(spark, tmp_state):
    m = msgs(spark, [("1", "a", "x"), ("2", "a", "x"), ("3", "b", "y")])
    first = process_channels(m, channels="a,b", state_path=tmp_state,
                             processed_at="2024-01-01")
    assert first.totals.first().new_messages == 2
    m2 = msgs(spark, [("1", "a", "z"), ("9", "b", "y"), ("7", "c", "q")])
    second = process_channels(m2, channels="a,b,c", state_path=tmp_state,
                              processed_at="2024-01-02")
    got = {r.message_id: r.status for r in second.classified.collect()}
    assert got == {"1": "dup_id", "9": "dup_content", "7": "new"}
