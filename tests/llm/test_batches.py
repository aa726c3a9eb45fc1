"""Bytes handed to a Python worker at a time do not grow with the texts."""

import corpus_pipeline
import pyarrow as pa
import pytest
from llm_helpers import docs_of
from pyspark.sql import functions as F

from sieveflow.llm import tokenfile
from sieveflow.session import BATCH_BYTES, bound_batches, bounded_batches

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture()
def default_bound(spark):
    spark.conf.unset(KEY)
    yield spark.conf.get(KEY)
    spark.conf.unset(KEY)


def _long_texts(spark, n=1500):
    docs = docs_of(spark, [(i, f"word{i}", "web") for i in range(n)]).coalesce(1)
    return docs.withColumn("text", F.repeat(F.concat("text", F.lit(" ")), 1200))


def _sizes():
    """Rows of the bytes of each batch, in the column n_tokens."""
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict(
                {"part": [0], "doc_id": [0], "tie": [0], "n_tokens": [b.nbytes], "ids": [[]]},
                schema=pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("tie", pa.int64()),
                                  ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))]))
    return sizes


def test_token_files_take_bounded_batches(spark, tmp_path, monkeypatch, default_bound):
    monkeypatch.setattr(tokenfile, "_encoded", lambda tokenizer, end_id: _sizes())
    tokenfile.write_token_files(_long_texts(spark), f"{tmp_path}/f", parts=1)
    got = [r.n_tokens for r in tokenfile.read_token_files(spark, f"{tmp_path}/f").collect()]
    assert sum(got) > 2.5 * BATCH_BYTES and max(got) < 1.25 * BATCH_BYTES
    assert spark.conf.get(KEY) == default_bound


@pytest.mark.parametrize("stage", ["language_id", "simhash_dedup", "secret_scan"])
def test_stages_take_bounded_batches(spark, stage, default_bound):
    docs = _long_texts(spark)
    dict(corpus_pipeline.STAGES)[stage](spark, docs.limit(20), "")
    rows = docs.mapInArrow(_sizes(), "part int, doc_id long, tie long, n_tokens long, ids array<int>")
    got = [r.n_tokens for r in rows.collect()]
    assert sum(got) > 2.5 * BATCH_BYTES and max(got) < 1.25 * BATCH_BYTES


def test_a_smaller_bound_stays(spark, default_bound):
    spark.conf.set(KEY, "1m")
    bound_batches(spark)
    assert spark.conf.get(KEY) == "1m"
    with bounded_batches(spark, 1000):
        assert spark.conf.get(KEY) == "1000b"
    assert spark.conf.get(KEY) == "1m"
