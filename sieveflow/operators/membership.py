"""Membership of a batch of messages in the decision state.

These check without marking (Q9): repeats inside the batch survive when the
state does not know them. The batch's distinct keys are written once, as a
narrow table; the state is semi-joined with them once per key type
(:func:`~sieveflow.operators.ingest.keys_in_state`: the history does not move, and
of a recorded state only the key ranges of the batch are read),
and the wide batch rows join the written hits, one row per key, last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import DUP_CONTENT, DUP_ID, NEW, reason_text
from ..session import materialize
from .ingest import HASH_KEY, ID_KEY, IngestState


def _hits(batch: DataFrame, state: IngestState, keys: list[list[str]]) -> list[DataFrame]:
    """For each key type the batch's keys that the state holds, written."""
    cols = [c for k in keys for c in k]
    mine = materialize(batch.select(*cols).distinct(), "batch-keys")
    return [materialize(state.hits(mine, k), "state-hits") for k in keys]


def id_members(batch: DataFrame, state: IngestState, *, negate: bool = False) -> DataFrame:
    """Messages whose (channel_id, message_id) is in the state."""
    ids, = _hits(batch, state, [ID_KEY])
    return batch.join(ids, ID_KEY, "left_anti" if negate else "left_semi")


def content_members(batch: DataFrame, state: IngestState, *, negate: bool = False) -> DataFrame:
    """Messages whose content hash is in the state (any channel, Q5)."""
    hashes, = _hits(batch, state, [HASH_KEY])
    return batch.join(hashes, HASH_KEY, "left_anti" if negate else "left_semi")


def classify_against_state(batch: DataFrame, state: IngestState) -> DataFrame:
    """``is_duplicate`` and ``reason`` for every message, the ID check
    first (Q7), nothing marked."""
    ids, hashes = _hits(batch, state, [ID_KEY, HASH_KEY])
    j = (batch.join(ids.withColumn("_id_hit", F.lit(True)), ID_KEY, "left")
         .join(hashes.withColumn("_hash_hit", F.lit(True)), HASH_KEY, "left"))
    status = (F.when(F.col("_id_hit").isNotNull(), F.lit(DUP_ID))
              .when(F.col("_hash_hit").isNotNull(), F.lit(DUP_CONTENT))
              .otherwise(F.lit(NEW)))
    return (j.withColumn("status", status).drop("_id_hit", "_hash_hit")
            .withColumn("is_duplicate", F.col("status") != F.lit(NEW))
            .withColumn("reason", reason_text("status")))


def filter_against_state(batch: DataFrame, state: IngestState) -> DataFrame:
    """Messages whose ID key and hash are both unknown to the state."""
    ids, hashes = _hits(batch, state, [ID_KEY, HASH_KEY])
    return batch.join(ids, ID_KEY, "left_anti").join(hashes, HASH_KEY, "left_anti")
