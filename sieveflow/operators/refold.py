"""D11 with J5, and late corrections: the ingest's answer after messages were
removed or inserted, from the part of the feed that the change touches.

A message is kept iff no earlier kept message shares its ID or its hash; this
rule has one solution only. So the kept set of before stays right wherever
neither end of a message saw a change. The refold starts at the *touched* keys:
those of removed kept messages and of inserted ones (a removed duplicate touches
nothing). It folds the messages at touched keys, together with the kept
messages at their other ends, and compares: a message that is kept now and was
not, or the other way round, touches its keys too. When a pass touches no
further key, every message satisfies the rule again.

Reads: semi joins of the feed with the touched keys. Cost follows the change,
not the feed: a pass folds what lies at touched keys (``ingest``), and passes
go as far as changes spread.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .ingest import HASH_KEY, ID_KEY, ingest


@dataclass
class Refold:
    """``kept``: the kept messages after the change (keys and seq). ``admitted``
    and ``dropped``: those that are kept now and were not, and the reverse among
    messages that are still there. ``folded``: messages that the last pass read."""
    kept: DataFrame
    admitted: DataFrame
    dropped: DataFrame
    folded: int
    passes: int


def _touched(edges: DataFrame) -> DataFrame:
    """(end, a, b): the ID and hash keys of some messages."""
    none = F.lit("")
    ids = F.struct(F.lit(0).alias("end"), F.col("channel_id").alias("a"), F.col("message_id").alias("b"))
    hashes = F.struct(F.lit(1).alias("end"), F.col("content_hash").alias("a"), none.alias("b"))
    return edges.select(F.explode(F.array(ids, hashes)).alias("k")).select("k.*").distinct()


def _at(rows: DataFrame, keys: DataFrame, seq: str) -> DataFrame:
    """The rows at one of the keys, each once."""
    ids = keys.where("end = 0").select(F.col("a").alias("channel_id"), F.col("b").alias("message_id"))
    hashes = keys.where("end = 1").select(F.col("a").alias("content_hash"))
    return (rows.join(ids, ID_KEY, "left_semi").unionByName(rows.join(hashes, HASH_KEY, "left_semi"))
            .dropDuplicates([seq]))


def refold(messages: DataFrame, kept: DataFrame, *, removed: DataFrame | None = None,
           inserted: DataFrame | None = None, seq: str = "seq", work_dir: str | None = None) -> Refold:
    """The kept messages of ``messages`` less ``removed`` plus ``inserted``.

    ``kept`` is the answer for ``messages`` (``IngestResult.kept``); ``removed``
    holds values of ``seq``; ``inserted`` messages have ``seq`` values of their
    own, anywhere in the order."""
    cols = [*ID_KEY, *HASH_KEY, seq]
    work = work_dir or scratch_path(messages.sparkSession, "refold")
    now, before = messages.select(*cols), kept.select(*cols)
    touched = before.limit(0)
    if removed is not None:
        gone = materialize(removed.select(seq).distinct(), "", f"{work}/removed")
        touched = before.join(gone, seq, "left_semi")
        now, before = now.join(gone, seq, "left_anti"), before.join(gone, seq, "left_anti")
    if inserted is not None:
        late = materialize(inserted.select(*cols), "", f"{work}/inserted")
        now, touched = now.unionByName(late), touched.unionByName(late)
    before = materialize(before, "", f"{work}/before")
    keys, passes = materialize(_touched(touched), "", f"{work}/touched-0"), 0
    while True:
        passes += 1
        at = materialize(_at(now, keys, seq), "", f"{work}/at-{passes}")
        # with what is kept at their other ends
        part = materialize(at.unionByName(_at(before, _touched(at), seq)).dropDuplicates([seq]), "",
                           f"{work}/part-{passes}")
        new = ingest(part, seq=seq, work_dir=f"{work}/ingest-{passes}").kept.select(*cols)
        was = materialize(before.join(part.select(seq), seq, "left_semi"), "", f"{work}/was-{passes}")
        admitted = materialize(new.join(was.select(seq), seq, "left_anti").select(*cols), "", f"{work}/admitted-{passes}")
        dropped = materialize(was.join(new.select(seq), seq, "left_anti").select(*cols), "", f"{work}/dropped-{passes}")
        more = materialize(_touched(admitted.unionByName(dropped)).join(keys, ["end", "a", "b"], "left_anti"), "",
                           f"{work}/more-{passes}")
        if more.isEmpty():
            break
        keys = materialize(keys.unionByName(more.select(*keys.columns)), "", f"{work}/touched-{passes}")
    after = before.join(dropped.select(seq), seq, "left_anti").unionByName(admitted.select(*before.columns))
    return Refold(after, admitted, dropped, part.count(), passes)
