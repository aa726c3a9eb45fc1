"""A hot key does not end up in one task: Spark splits its partition in the
joins of the ingest, which all have one row per key on the other side."""

import pytest
from pyspark.sql import functions as F

from sieveflow.operators.ingest import IngestState, ingest
from sieveflow.operators.membership import classify_against_state

CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}


@pytest.fixture()
def shuffled(spark):
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k in CONF:
        spark.conf.unset(k)


def _messages(spark):
    """A third of the rows under one ID key."""
    return spark.range(30_000, numPartitions=8).select(
        F.col("id").alias("seq"), F.lit("c").alias("channel_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("message_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("content_hash"))


def _largest_share(df):
    per_task = (df.withColumn("p", F.spark_partition_id()).where("message_id = 'hot' and status <> ''")
                .groupBy("p").count().collect())
    return max(r["count"] for r in per_task) / sum(r["count"] for r in per_task)


def test_hot_id_is_split_in_the_ingest(shuffled):
    res = ingest(_messages(shuffled))
    assert {r.status: r["count"] for r in res.messages.groupBy("status").count().collect()} == {
        "new": 20_001, "dup_id": 9_999}
    assert _largest_share(res.messages) < 0.6


def test_hot_id_is_split_in_the_membership_check(shuffled):
    m = _messages(shuffled)
    known = m.where("seq < 3000")
    out = classify_against_state(m, IngestState(known.select("channel_id", "message_id"),
                                                known.select("content_hash")))
    assert out.where("status = 'dup_id'").count() == 12_000
    assert _largest_share(out) < 0.6
