"""Ordered ingest ("check, then mark") over two keys, in parallel.

Sequential meaning: walk the messages in ``seq`` order; keep a message iff
neither its ID key ``(channel_id, message_id)`` nor its content hash is in the
state or in an earlier *kept* message. Dropped messages are not recorded.
The kept set is the lexicographically first maximal matching of the bipartite
graph whose edges are the messages, and it is computed in rounds of
"locally first" edges (Blelloch, Fineman, Shun, SPAA 2012):

1. collapse messages with equal (ID, hash) to their first ``seq`` (only that
   one can win) and drop those whose ID or hash is already in the state (the
   state is read once per key type: the batch's keys it holds are written as
   a batch-sized table);
2. a live edge wins when it holds the smallest ``seq`` of its ID *and* of its
   hash: one ``min(struct)`` aggregation over both ends of the edges (combined
   map-side, so hot keys are no problem), then the edges that come out twice;
3. remove every live edge that shares an ID or a hash with a winner (two anti
   joins), write the rest to the shared checkpoint folder, repeat until nothing
   is live. The smallest live ``seq`` always wins, so every round makes
   progress; with unique IDs one round suffices.

Reasons follow from the kept set alone: a dropped message is ``dup_id`` when
the state has its ID or a kept message with the same ID came earlier,
otherwise ``dup_content``. Kept messages are unique per ID, so this is one
join on the ID key.

One side of a join always is a written table with one row per key (state hits,
winners, kept keys): Spark broadcasts it when its rows are few (``small_side``:
repeated values make files far smaller than the rows in them), and otherwise
AQE splits the partitions of a hot key on the other side, which such a join
permits. The recorded history is only ever the streamed side of a
semi join with the batch's keys (:func:`keys_in_state`): a small batch is
broadcast to it, and of a recorded state only the key ranges of the batch are
read (``key_ranges``).

Long chains (a message that hangs on the one before, and so on) would take a
round a link. When a round leaves most edges live, the next one follows chains
by pointer jumping (``chains``): a chain is decided in the logarithm of its length.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import DUP_CONTENT, DUP_ID, NEW, reason_text
from ..session import materialize, scratch_path, small_side
from .chains import kept_on_chains
from .key_ranges import key_ranges

ID_KEY = ["channel_id", "message_id"]
HASH_KEY = ["content_hash"]
#: a round that leaves more than this share of the edges live is followed by
#: one along the chains
SLOW = 0.75


@dataclass
class IngestState:
    """Decision state: the recorded ID keys and content hashes.

    ``ids``: (channel_id, message_id); ``hashes``: (content_hash), repeats
    allowed. ``others`` are further states it is the union of: they are kept
    apart so that each is looked up in its own layout. ``sorted_files``: both
    are read from files sorted by key, so lookups can skip parts of them.
    """
    ids: DataFrame
    hashes: DataFrame
    known_empty: bool = False   # a first run: the state joins can be skipped
    others: tuple["IngestState", ...] = ()
    sorted_files: bool = False

    @staticmethod
    def empty(spark: SparkSession) -> "IngestState":
        s = T.StructType([T.StructField("channel_id", T.StringType()),
                          T.StructField("message_id", T.StringType())])
        h = T.StructType([T.StructField("content_hash", T.StringType())])
        return IngestState(spark.createDataFrame([], s), spark.createDataFrame([], h), True)

    def id_parts(self) -> list[DataFrame]:
        return [p for s in (self, *self.others) for p in ([s.ids] if s is self else s.id_parts())]

    def hash_parts(self) -> list[DataFrame]:
        return [p for s in (self, *self.others)
                for p in ([usable_hashes(s.hashes)] if s is self else s.hash_parts())]

    def distinct_ids(self) -> DataFrame:
        return _union([p.select(*ID_KEY) for p in self.id_parts()]).distinct()

    def distinct_hashes(self) -> DataFrame:
        return _union(self.hash_parts()).distinct()

    def union(self, other: "IngestState") -> "IngestState":
        if self.known_empty:
            return other
        if other.known_empty:
            return self
        return IngestState(self.ids, self.hashes, False, (*self.others, other), self.sorted_files)

    def hits(self, batch_keys: DataFrame, key: list[str]) -> DataFrame:
        """The keys of ``batch_keys`` (a written table) that the state also
        holds, one row per key."""
        found = [keys_in_state(batch_keys, [s.ids if key is ID_KEY else usable_hashes(s.hashes)], key,
                               sorted_files=s.sorted_files) for s in self._all()]
        return found[0] if len(found) == 1 else _union(found).distinct()

    def _all(self) -> list["IngestState"]:
        return [self, *[s for o in self.others for s in o._all()]]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def usable_hashes(hashes: DataFrame) -> DataFrame:
    """The hashes that take part in content checks."""
    return hashes.select(*HASH_KEY).where("content_hash is not null and content_hash <> ''")


def keys_in_state(batch_keys: DataFrame, state_parts: list[DataFrame], key: list[str], *,
                  sorted_files: bool = False) -> DataFrame:
    """The keys of ``batch_keys`` (a written table) that the state also holds,
    one row per key.

    The history is the left side of a semi join and joined on its stored
    columns as they are: with few batch keys they are broadcast and the history
    is scanned once without moving. From ``sorted_files`` only the pages are
    read that the batch's key ranges touch. Only the few hits are made distinct."""
    near = key_ranges(batch_keys, key) if sorted_files else F.lit(True)
    keys = small_side(batch_keys.select(*key))
    return _union([part.select(*key).where(near).join(keys, key, "left_semi")
                   for part in state_parts]).distinct()


@dataclass
class IngestResult:
    """Messages with ``status`` / ``is_duplicate`` / ``reason``, plus the
    number of rounds the matching took."""
    messages: DataFrame
    rounds: int
    kept: DataFrame = field(repr=False, default=None)

    def accepted(self) -> DataFrame:
        """The messages to keep."""
        return self.messages.where(F.col("status") == NEW)

    def duplicates(self) -> DataFrame:
        """Dropped messages with their reason."""
        return self.messages.where(F.col("status") != NEW)


def _write(df: DataFrame, path: str) -> DataFrame:
    """Cut lineage: write to the shared folder, read back (survives the loss
    of any executor, unlike a local checkpoint)."""
    return materialize(df, "", path)


def ingest(messages: DataFrame, state: IngestState | None = None, *,
           seq: str = "seq", id_layer: bool = True, content_layer: bool = True,
           work_dir: str | None = None, max_rounds: int | None = None) -> IngestResult:
    """Classify every message as ``new``, ``dup_id`` or ``dup_content``.

    ``messages`` needs ``channel_id, message_id, content_hash`` and a unique,
    orderable ``seq``. ``state`` holds what earlier runs recorded.
    ``id_layer`` / ``content_layer`` switch the two checks (D2); with one
    layer the answer is the first message per key, no rounds needed. The
    round tables go to a fresh folder below ``work_dir`` (default: the shared
    checkpoint folder) at every call.
    """
    spark = messages.sparkSession
    state = state or IngestState.empty(spark)
    work = f"{work_dir or scratch_path(spark, 'ingest')}/attempt-{uuid.uuid4().hex[:12]}"

    if not id_layer and not content_layer:
        out = messages.withColumn("status", F.lit(NEW))
        return IngestResult(_finish(out), 0)
    if not content_layer or not id_layer:
        key = ID_KEY if id_layer else HASH_KEY
        dup = DUP_ID if id_layer else DUP_CONTENT
        return _single_layer(messages, None if state.known_empty else state, key, dup, seq, work)

    # -- 1. collapse equal (ID, hash) pairs: the only pass over the texts ------
    pairs = _write(messages.groupBy(*ID_KEY, *HASH_KEY).agg(F.min(seq).alias(seq)),
                   f"{work}/pairs")
    live, ids_hit = pairs, None
    if not state.known_empty:
        # state keys this batch touches (batch-sized, one row per key)
        ids_hit = _write(state.hits(pairs, ID_KEY), f"{work}/ids_in_state")
        hashes_hit = _write(state.hits(pairs, HASH_KEY), f"{work}/hashes_in_state")
        live = _write(live.join(small_side(ids_hit), ID_KEY, "left_anti")
                      .join(small_side(hashes_hit), HASH_KEY, "left_anti"), f"{work}/live/round=0")

    # -- 2./3. rounds of locally first edges -----------------------------------
    kept_rounds: list[str] = []
    rounds, slow, n_live = 0, False, live.count()
    while n_live > 0:
        if max_rounds is not None and rounds >= max_rounds:
            raise RuntimeError(f"ingest did not converge in {max_rounds} rounds")
        path, jumps = f"{work}/kept/round={len(kept_rounds)}", 0
        if slow:
            winners, jumps = _first_on_chains(live, seq, f"{work}/chains/round={len(kept_rounds)}")
        else:
            winners = _locally_first(live, seq)
        winners = _write(winners, path)
        kept_rounds.append(path)
        n_won = winners.count()
        live = _write(live.join(small_side(winners.select(*ID_KEY), n_won), ID_KEY, "left_anti")
                      .join(small_side(winners.select(*HASH_KEY), n_won), HASH_KEY, "left_anti"),
                      f"{work}/live/round={len(kept_rounds)}")
        rounds += 1 + jumps
        before, n_live = n_live, live.count()
        slow = n_live > SLOW * before
        if n_live >= before:
            # the first live pair always wins unless a key is null
            raise ValueError("ingest made no progress: channel_id, message_id and "
                             "content_hash must not be null")

    kept_schema = T.StructType([T.StructField("channel_id", T.StringType()),
                                T.StructField("message_id", T.StringType()),
                                T.StructField("content_hash", T.StringType()),
                                T.StructField(seq, messages.schema[seq].dataType)])
    # exactly the rounds written by this call; when nothing was live, a table that
    # Spark knows to be empty: with one of unknown size the join below shuffles all texts
    kept = (spark.read.schema(kept_schema).parquet(*kept_rounds) if kept_rounds
            else pairs.select(*kept_schema.names).limit(0))

    # -- 4. statuses: one join on the ID key ------------------------------------
    right = kept.select(*ID_KEY, F.col(seq).alias("_kseq"), F.lit(False).alias("_in_state"))
    if ids_hit is not None:
        right = right.unionByName(ids_hit.select(
            *ID_KEY, F.lit(None).cast(kept_schema[seq].dataType).alias("_kseq"),
            F.lit(True).alias("_in_state")))
    j = messages.join(small_side(right), ID_KEY, "left")
    status = (F.when(F.col("_kseq") == F.col(seq), F.lit(NEW))
              .when(F.coalesce(F.col("_in_state"), F.lit(False)) | (F.col("_kseq") < F.col(seq)),
                    F.lit(DUP_ID))
              .otherwise(F.lit(DUP_CONTENT)))
    out = j.withColumn("status", status).drop("_kseq", "_in_state")
    return IngestResult(_finish(out), rounds, kept)


def _ends() -> Column:
    """The two ends of an edge, the ID and the hash."""
    id_end = F.struct(F.lit(0).alias("end"), F.col("channel_id").alias("a"), F.col("message_id").alias("b"))
    hash_end = F.struct(F.lit(1).alias("end"), F.col("content_hash").alias("a"), F.lit("").alias("b"))
    return F.explode(F.array(id_end, hash_end)).alias("end")


def _first_on_chains(live: DataFrame, seq: str, path: str) -> tuple[DataFrame, int]:
    """The edges that are kept for certain when chains are followed, and the
    rounds that took."""
    rows = live.dropna(subset=[*ID_KEY, *HASH_KEY])
    kept, jumps = kept_on_chains(rows.select(_ends(), F.col(seq).alias("s")), path)
    return rows.join(small_side(kept.withColumnRenamed("s", seq)), seq, "left_semi").select(*ID_KEY, *HASH_KEY, seq), jumps


def _locally_first(live: DataFrame, seq: str) -> DataFrame:
    """The edges that come first at both of their ends."""
    edge = F.struct(F.col(seq).alias("s"), *ID_KEY, *HASH_KEY)
    first = (live.select(_ends(), edge.alias("edge"))
             .groupBy("end").agg(F.min("edge").alias("edge")))
    return (first.groupBy("edge").agg(F.count(F.lit(1)).alias("ends")).where("ends = 2")
            .select("edge.channel_id", "edge.message_id", "edge.content_hash",
                    F.col("edge.s").alias(seq))
            .dropna(subset=[*ID_KEY, *HASH_KEY]))     # an end that is null meets no other


def _single_layer(messages: DataFrame, state: IngestState | None, key: list[str], dup: str,
                  seq: str, work: str) -> IngestResult:
    """D2 with one layer: the first message per key not in the state wins."""
    right = _write(messages.groupBy(*key).agg(F.min(seq).alias("_kseq")), f"{work}/first")
    if state is not None:
        hit = state.hits(right, key).withColumn("_in_state", F.lit(True))
        hit = small_side(_write(hit, f"{work}/in_state"))
        right = _write(right.join(hit, key, "left"), f"{work}/first_and_state")
    else:
        right = right.withColumn("_in_state", F.lit(None).cast("boolean"))
    j = messages.join(small_side(right), key, "left")
    status = (F.when(F.col("_in_state").isNull() & (F.col("_kseq") == F.col(seq)), F.lit(NEW))
              .otherwise(F.lit(dup)))
    out = j.withColumn("status", status).drop("_kseq", "_in_state")
    return IngestResult(_finish(out), 1)


def _finish(df: DataFrame) -> DataFrame:
    return (df.withColumn("is_duplicate", F.col("status") != F.lit(NEW))
            .withColumn("reason", reason_text("status")))
