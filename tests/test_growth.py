"""Bytes through the driver must not grow with the input."""

from pyspark.sql import functions as F

from sieveflow.operators.ingest import ID_KEY, ingest, keys_in_state
from sieveflow.session import _bytes, materialize, small_side


def test_large_key_tables_are_not_broadcast(spark):
    """Keys whose files are small, as their values repeat, but whose rows are many."""
    keys = spark.range(150_000).select(F.lit("c").alias("channel_id"), (F.col("id") % 300).cast("string").alias("message_id"),
                                       F.lit("0" * 64).alias("content_hash"))
    keys = materialize(keys, "growth")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    many, few = (keys_in_state(k, [keys.select(*ID_KEY)], ID_KEY) for k in (keys, materialize(keys.limit(100), "growth")))
    assert "BroadcastHashJoin" not in plan(many) and "SortMergeJoin" in plan(many)
    assert "BroadcastHashJoin" in plan(few)
    assert many.count() == 300
    assert small_side(keys, 1) is keys
    assert [_bytes(s) for s in ("10m", "10485760b", "64MB", "-1", "7")] == [10 << 20, 10 << 20, 64 << 20, -1, 7]


def test_ingest_with_large_tables_of_winners(spark):
    """Two rounds and a status join beyond the broadcast threshold."""
    msgs = materialize(spark.range(240_000).select(
        F.col("id").alias("seq"), F.lit("c").alias("channel_id"), F.floor(F.col("id") / 2).cast("string").alias("message_id"),
        F.col("id").cast("string").alias("content_hash")), "growth")
    res = ingest(msgs)
    assert {r.status: r["count"] for r in res.messages.groupBy("status").count().collect()} == {"new": 120_000, "dup_id": 120_000}
    assert "BroadcastHashJoin" not in res.messages._jdf.queryExecution().executedPlan().toString()
