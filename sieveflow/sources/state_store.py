"""Durable decision state on plain Parquet files.

Layout below a state folder (a shared path on the cluster):

``tracking/day=D/``       tracking rows (M3) by the day they were processed
                          (K7, K8, U2), each file sorted by ID key.
``hashes/day=D/``         their content hashes once more, sorted by hash.
``batches/batch_id=N/``   one row for each batch that is done.
``begun/batch_id=N/``     a mark while batch N is written. Its rows do not count
                          until the mark is gone, so readers never see half a batch.
``metadata/``             (key, value, updated_at) rows, latest per key (K9, K10).

The tracking log is append-only: the hash memory therefore keeps the hashes of
replaced rows (Q11), and "INSERT OR REPLACE" is a read view (W1). Both tables
are ordinary partitioned Parquet: a batch appends files, a replay or a retention
rewrites the days it touches by Spark's dynamic partition overwrite, and whole
days that expire are deleted folders. Sorted files with small pages and Bloom
filters let a lookup skip what its keys cannot hit (``operators/key_ranges``).
A state has one writer at a time, and upkeep (retention, compaction, replay)
replaces files: a query planned before must be planned anew after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import DEFAULT_STATUS, TRACKER_VERSION, iso_datetime
from ..operators.ingest import HASH_KEY, ID_KEY, IngestState
from ..session import folder_bytes, folders, make_folder, materialize, read_or_empty, remove
from .snapshots import read_latest_snapshot

# ---------------------------------------------------------------------------
# Columns of the tracking and metadata tables (mark_* are ours).
# ---------------------------------------------------------------------------
TRACKING_SCHEMA = T.StructType([
    T.StructField("message_id", T.StringType(), False),
    T.StructField("channel_id", T.StringType(), False),
    T.StructField("channel_name", T.StringType()),
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("content_hash", T.StringType()),
    T.StructField("processed_at", T.TimestampNTZType(), False),
    T.StructField("processing_status", T.StringType()),
    T.StructField("ai_processed", T.BooleanType()),
    T.StructField("storage_path", T.StringType()),
    T.StructField("mark_ordinal", T.LongType()),
    T.StructField("mark_seq", T.LongType()),
])
LOG_SCHEMA = T.StructType(TRACKING_SCHEMA.fields + [T.StructField("batch_id", T.LongType())])
_DAY = T.StructField("day", T.DateType())
_STORED_SCHEMA = T.StructType([*LOG_SCHEMA.fields, _DAY])
_HASHES_SCHEMA = T.StructType([*[LOG_SCHEMA[c] for c in ("content_hash", "processed_at", "batch_id")], _DAY])
BATCH_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),          # stream or run that wrote the batch
    T.StructField("source_batch", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])

METADATA_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), False),
    T.StructField("value", T.StringType()),
    T.StructField("updated_at", T.TimestampNTZType()),
    T.StructField("written_at", T.TimestampType()),
])

# ---------------------------------------------------------------------------


def _ts(value):
    if value is None:
        return F.localtimestamp()
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


# -- P5 / K7 / K8 -------------------------------------------------------------

def tracking_rows(messages: DataFrame, processed_at=None, status: str = DEFAULT_STATUS,
                  ai_processed: bool = False, storage_path: str | None = None,
                  seq: str = "seq") -> DataFrame:
    """P5: project messages onto the tracking record (M3). The arrival order is
    kept as ``(mark_ordinal, mark_seq)``: a whole number is the second of them,
    a pair of whole numbers (channel order) both."""
    mark_ordinal, mark_seq = _mark_order(messages, seq)
    return messages.select(
        F.col("message_id"), F.col("channel_id"), F.col("channel_name"),
        F.col("date").cast("timestamp_ntz").alias("date"), F.col("content_hash"),
        _ts(processed_at).alias("processed_at"),
        F.lit(status).alias("processing_status"),
        F.lit(bool(ai_processed)).alias("ai_processed"),
        F.lit(storage_path).cast("string").alias("storage_path"),
        mark_ordinal.alias("mark_ordinal"), mark_seq.alias("mark_seq"))


def _mark_order(messages: DataFrame, seq: str) -> tuple[Column, Column]:
    none = F.lit(None).cast("long")
    kind = messages.schema[seq].dataType if seq in messages.columns else None
    if isinstance(kind, T.IntegralType):
        return none, F.col(seq).cast("long")
    if (isinstance(kind, T.StructType) and len(kind) == 2
            and all(isinstance(f.dataType, T.IntegralType) for f in kind)):
        return tuple(F.col(f"{seq}.`{f.name}`").cast("long") for f in kind)
    return none, none


def tracking_rows_as_text(rows: DataFrame) -> DataFrame:
    """The tracking record as the reference stores it: ISO-8601 dates (F8),
    the AI flag as 0/1 (F9)."""
    return rows.select(
        "message_id", "channel_id", "channel_name",
        iso_datetime("date").alias("date"), "content_hash",
        iso_datetime("processed_at").alias("processed_at"), "processing_status",
        F.col("ai_processed").cast("int").alias("ai_processed"), "storage_path")


# -- the log ------------------------------------------------------------------

# small pages, so that a page's key range is narrow; Bloom filters for single keys
_SORTED = {"parquet.page.row.count.limit": "1024", "parquet.bloom.filter.adaptive.enabled": "true",
           "parquet.bloom.filter.enabled#message_id": "true", "parquet.bloom.filter.enabled#content_hash": "true"}


#: bytes of the log beyond which a lookup first works out key ranges (three
#: small jobs); less is read whole in the time they take
RANGES_ABOVE = 64 << 20


class FolderState:
    """The recorded state in a folder."""

    #: (folder, stored columns, sort key)
    TABLES = (("tracking", _STORED_SCHEMA, ID_KEY), ("hashes", _HASHES_SCHEMA, HASH_KEY))

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # batches

    def batches(self, spark: SparkSession | None = None) -> DataFrame:
        """(source, source_batch, batch_id), a row for each batch that is done."""
        rows = read_or_empty(spark or self.spark, f"{self.root}/batches", BATCH_SCHEMA)
        cut = self._begun(spark or self.spark)
        return rows.where(~F.col("batch_id").isin(cut)) if cut else rows

    def _begun(self, spark: SparkSession) -> list[int]:
        """The batch that is being written, or was cut: seldom any."""
        return [int(f.split("=")[1]) for f in folders(spark, f"{self.root}/begun")]

    def next_batch(self, source: str | None = None, source_batch: int | None = None) -> tuple[int, bool]:
        """(batch id, whether it was recorded before). A stream's micro-batch
        keeps the id it was recorded under; anything else, a batch that was cut
        before it was done too, gets the next one."""
        mine = F.col("source").eqNullSafe(source) & F.col("source_batch").eqNullSafe(source_batch)
        row = self.batches().agg(F.max("batch_id").alias("last"),
                                 F.max(F.when(mine, F.col("batch_id"))).alias("mine")).first()
        if source is not None and row["mine"] is not None:
            return row["mine"], True
        return (-1 if row["last"] is None else row["last"]) + 1, False

    def append(self, rows: DataFrame, batch_id: int | None = None, *, replay: bool = False,
               source: str | None = None, source_batch: int | None = None) -> int:
        """Record a batch of tracking rows; returns its id (the next
        one by default). A batch that is recorded already is replaced only by
        a ``replay``."""
        batch_id = self.next_batch()[0] if batch_id is None else int(batch_id)
        recorded = not self.batches().where(F.col("batch_id") == batch_id).isEmpty()
        if recorded and not replay:
            raise ValueError(f"batch {batch_id} is recorded already; replay=True replaces it")
        batch = F.lit(batch_id).cast("long").alias("batch_id")
        # written once, read by both tables, before the batch it may replace goes
        rows = materialize(rows.select(*TRACKING_SCHEMA.names, batch, F.to_date("processed_at").alias("day")), "record")
        again = recorded or batch_id in self._begun(self.spark)
        mark = f"{self.root}/begun/batch_id={batch_id}"
        make_folder(self.spark, mark)
        if again:
            self._rewrite(F.col("batch_id") == batch_id)
        for name, schema, key in self.TABLES:
            self._write(rows.select(*schema.names), name, key, "append")
        (self.spark.createDataFrame([(source, source_batch)], T.StructType(BATCH_SCHEMA.fields[:-1]))
         .coalesce(1).write.mode("overwrite").parquet(f"{self.root}/batches/batch_id={batch_id}"))
        remove(self.spark, mark)
        return batch_id

    # the tables

    def _write(self, rows: DataFrame, name: str, key: list[str], mode: str) -> None:
        if name == "hashes":
            rows = rows.where("content_hash is not null and content_hash <> ''")
        (rows.repartitionByRange("day", *key).sortWithinPartitions("day", *key).write.mode(mode)
         .options(**_SORTED).option("partitionOverwriteMode", "dynamic").partitionBy("day")
         .parquet(f"{self.root}/{name}"))

    def _rewrite(self, gone: Column, days: list | None = None) -> None:
        """Rewrites ``days`` (default: those with such rows) without the rows
        that are ``gone``; all other days keep their files."""
        for name, schema, key in self.TABLES:
            stored = read_or_empty(self.spark, f"{self.root}/{name}", schema)
            # dates: as many as the calendar has, not the data
            touched = [r["day"] for r in stored.where(gone).select("day").distinct().collect()] if days is None else days
            if not touched:
                continue
            kept = materialize(stored.where(F.col("day").isin(touched) & ~gone), "kept-rows")
            left = {r["day"] for r in kept.select("day").distinct().collect()}
            if left:
                self._write(kept, name, key, "overwrite")
            for day in set(touched) - left:
                remove(self.spark, f"{self.root}/{name}/day={day}")

    # reading

    def _rows(self, which: int, before_batch: int | None, spark: SparkSession) -> DataFrame:
        name, schema, _ = self.TABLES[which]
        rows = read_or_empty(spark, f"{self.root}/{name}", schema)
        if cut := self._begun(spark):
            rows = rows.where(~F.col("batch_id").isin(cut))
        return rows if before_batch is None else rows.where(F.col("batch_id") < int(before_batch))

    def log(self, before_batch: int | None = None, spark: SparkSession | None = None) -> DataFrame:
        """The tracking log, optionally only batches below ``before_batch``."""
        return self._rows(0, before_batch, spark or self.spark).select(*LOG_SCHEMA.names)

    def state(self, before_batch: int | None = None, spark: SparkSession | None = None) -> IngestState:
        """The recorded keys, as they are stored (not made distinct)."""
        spark = spark or self.spark
        size = folder_bytes(spark, f"{self.root}/tracking")
        if not size:
            return IngestState.empty(spark)
        return IngestState(self._rows(0, before_batch, spark).select(*ID_KEY),
                           self._rows(1, before_batch, spark).select(*HASH_KEY), sorted_files=size > RANGES_ABOVE)

    # upkeep

    def retain(self, as_of, days: int) -> DataFrame:
        """Drops the rows processed more than ``days`` days before
        ``as_of``; returns one row ``(kept_rows, removed_rows)``. Days before
        the limit are deleted folders, the limit's own day is rewritten if it
        holds such rows, later days are not touched; metadata stays."""
        keep = _is_kept(as_of, days)
        counts = materialize(self.log().agg(F.count_if(keep).alias("kept_rows"), F.count_if(~keep).alias("removed_rows")),
                             "retention")
        limit = self.spark.range(1).select(F.to_date(_limit(as_of, days)).alias("day")).first()["day"]
        for name, _, _ in self.TABLES:
            for folder in folders(self.spark, f"{self.root}/{name}"):
                if folder.startswith("day=") and folder < f"day={limit}":
                    remove(self.spark, f"{self.root}/{name}/{folder}")
        if not self.log().where((F.col("processed_at") >= F.lit(limit)) & ~keep).isEmpty():
            self._rewrite(~keep, [limit])
        return counts

    def compact(self, max_files: int = 8) -> None:
        """Rewrites the days that have more than ``max_files`` files as few, sorted ones."""
        for name, schema, key in self.TABLES:
            path = f"{self.root}/{name}"
            many = [d[len("day="):] for d in folders(self.spark, path) if d.startswith("day=")
                    and sum(f.endswith(".parquet") for f in folders(self.spark, f"{path}/{d}")) > max_files]
            if many:
                rows = read_or_empty(self.spark, path, schema).where(F.col("day").isin(many))
                self._write(materialize(rows, "compact"), name, key, "overwrite")


def open_state(spark: SparkSession, root: str, updated_at=None) -> FolderState:
    """The state in ``root``; when there is none it is created and the
    tracker version recorded in its metadata."""
    if not folders(spark, f"{root.rstrip('/')}/metadata"):
        put_metadata(spark, root, {"tracker_version": TRACKER_VERSION}, updated_at)
    return FolderState(spark, root)


def append_batch(rows: DataFrame, state_path: str, batch_id: int | None = None, *,
                 replay: bool = False) -> int:
    """Record a batch of tracking rows (see :meth:`FolderState.append`)."""
    return open_state(rows.sparkSession, state_path).append(rows, batch_id, replay=replay)


def read_log(spark: SparkSession, state_path: str, before_batch: int | None = None) -> DataFrame:
    """The committed rows of the tracking log, optionally only batches below
    ``before_batch``."""
    return open_state(spark, state_path).log(before_batch)


# -- K1 / K2 / U1 ---------------------------------------------------------------

def id_state(log: DataFrame) -> DataFrame:
    """K1: SELECT DISTINCT channel_id, message_id."""
    return log.select(*ID_KEY).distinct()


def hash_state(log: DataFrame) -> DataFrame:
    """K2 + P9: distinct non-null, non-empty content hashes."""
    return (log.select(*HASH_KEY)
            .where("content_hash is not null and content_hash <> ''").distinct())


def load_state(spark: SparkSession, state_path: str, before_batch: int | None = None,
               snapshot_path: str | None = None) -> IngestState:
    """state = tracking log (batches < ``before_batch``) and the latest JSON
    snapshot below ``snapshot_path``, set semantics."""
    st = open_state(spark, state_path).state(before_batch)
    return st.union(read_latest_snapshot(spark, snapshot_path)) if snapshot_path else st


# -- W1 / K10 --------------------------------------------------------------------

def latest_per_key(log: DataFrame, key: list[str] | None = None,
                   order: list[str] | None = None) -> DataFrame:
    """The "INSERT OR REPLACE" view -- the last write per key wins.

    ``max_by`` over a struct: a partial aggregation, so a hot key is combined
    before the shuffle instead of being sorted in one task."""
    key = key or ID_KEY
    order = order or [c for c in ("processed_at", "batch_id", "mark_ordinal", "mark_seq")
                      if c in log.columns]
    rest = [c for c in log.columns if c not in key]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return log.groupBy(*key).agg(best).select(*key, *[F.col(f"_row.{c}").alias(c)
                                                       for c in rest])


def put_metadata(spark: SparkSession, state_path: str, values: dict[str, str],
                 updated_at=None) -> None:
    """Upsert metadata entries (append; latest per key wins)."""
    rows = spark.createDataFrame(list(values.items()), "key string, value string").coalesce(1)
    (rows.select("key", "value", _ts(updated_at).alias("updated_at"),
                 F.current_timestamp().alias("written_at"))
     .write.mode("append").parquet(f"{state_path}/metadata"))


def read_metadata(spark: SparkSession, state_path: str) -> DataFrame:
    """(key, value, updated_at), the last write of each key, and what the
    batches tell: ``last_batch_id`` (when a batch is recorded)."""
    m = read_or_empty(spark, f"{state_path}/metadata", METADATA_SCHEMA)
    last = (FolderState(spark, state_path).batches().groupBy(F.lit("last_batch_id").alias("key"))
            .agg(F.max("batch_id").alias("n")).where("n is not null")
            .select("key", F.col("n").cast("string").alias("value"), F.lit(None).cast("timestamp_ntz").alias("updated_at")))
    return (latest_per_key(m, ["key"], ["written_at"]).drop("written_at")
            .where("key <> 'last_batch_id'").unionByName(last))


# -- D11 -----------------------------------------------------------------------------

def _limit(as_of, days: int) -> Column:
    return _ts(as_of) - F.make_interval(days=F.lit(int(days)))


def _is_kept(as_of, days: int) -> Column:
    return F.col("processed_at") >= _limit(as_of, days)


def retention_split(log: DataFrame, as_of, days: int) -> tuple[DataFrame, DataFrame]:
    """(kept, removed) tracking rows for a retention of ``days`` days
    before ``as_of``. Removing rows re-admits their messages."""
    keep = _is_kept(as_of, days)
    return log.where(keep), log.where(~keep)


def apply_retention(spark: SparkSession, state_path: str, as_of, days: int) -> DataFrame:
    """D11 on a recorded state (see :meth:`FolderState.retain`)."""
    return open_state(spark, state_path).retain(as_of, days)
