"""Message source contract (K0) and the key / text normalisation.

A message feed is any DataFrame whose columns follow the loose contract of the
reference: ``id``, ``channel_id``, ``channel`` / ``channel_name``,
``text`` / ``message``, ``date``; any of them may be missing. ``seq`` is the
arrival order: DataFrames have no order, so it must be an explicit, unique,
orderable column (a number or a struct of numbers).

The normalised message has the fixed columns ``MESSAGE_COLUMNS``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import content_hash, first_nonempty, key_text

MESSAGE_COLUMNS = ["channel_id", "message_id", "channel_name", "text", "date", "seq"]

# Fixed ingest time of the fixture feeds whose rows carry no date (documents,
# conversations), so that results are deterministic.
FIXTURE_INGEST_TIME = "2024-02-01 00:00:00"


def _lit_ts(value) -> Column:
    if value is None:
        return F.localtimestamp()
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def _as_ts(c: Column) -> Column:
    """A date given as text is parsed; unparsable text counts as missing
    (the reference keeps it as text, a typed column cannot)."""
    return c.try_cast("timestamp_ntz")


def normalize_messages(df: DataFrame, *, ingest_time=None, id: str = "id",
                       channel_id: str = "channel_id", channel: str = "channel",
                       channel_name: str = "channel_name", text: str = "text",
                       message: str = "message", date: str = "date",
                       seq: str = "seq", keep: tuple[str, ...] = ()) -> DataFrame:
    """Project a loose message feed onto the fixed message columns.

    P1 keys: cast to string, missing -> ''.   P2 text: ``text`` if non-empty,
    else ``message``, else ''.   P3 name: ``channel`` if non-empty, else
    ``channel_name``, else ''.   P4 date: the row's date, else ``ingest_time``.
    """
    cols = set(df.columns)

    def opt(name: str | None) -> Column:
        return F.col(name) if name and name in cols else F.lit(None)

    return df.select(
        key_text(opt(channel_id)).alias("channel_id"),
        key_text(opt(id)).alias("message_id"),
        first_nonempty(opt(channel).cast("string"),
                       opt(channel_name).cast("string")).alias("channel_name"),
        first_nonempty(opt(text).cast("string"),
                       opt(message).cast("string")).alias("text"),
        F.coalesce(_as_ts(opt(date)), _lit_ts(ingest_time)).alias("date"),
        opt(seq).alias("seq"),
        *keep,
    )


def with_fingerprint(messages: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``content_hash`` = sha256(strip(lower(text)))."""
    return messages.withColumn("content_hash", content_hash(text_col))


# ---------------------------------------------------------------------------
# Mappings of the driver tables onto the message contract (see FIXTURES.md).
# ---------------------------------------------------------------------------

def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents_feed(spark: SparkSession, sf_dir: str,
                   ingest_time=FIXTURE_INGEST_TIME) -> DataFrame:
    """D: channel = source, id = doc_id, arrival order = doc_id."""
    d = _table(spark, sf_dir, "documents")
    raw = d.select(F.col("doc_id").alias("id"), F.col("source").alias("channel_id"),
                   F.col("source").alias("channel"), "text",
                   F.col("doc_id").alias("seq"))
    return with_fingerprint(normalize_messages(raw, ingest_time=ingest_time))


def since_filter(raw: DataFrame, date_col: str, as_of, days: int) -> DataFrame:
    """D1 on a stored date column, before normalisation, so that the parquet
    scan receives it (``PushedFilters``) and skips row groups; rows without a
    date are kept (they get the ingest time)."""
    cutoff = F.lit(str(as_of)).cast("timestamp_ntz") - F.make_interval(days=F.lit(int(days)))
    c = F.col(date_col)
    return raw.where(c.isNull() | (c >= cutoff))


def events_feed(spark: SparkSession, sf_dir: str, since: tuple | None = None) -> DataFrame:
    """E: channel = event_type, id = user_id, text = event_type || props,
    date = ts, arrival order = event_id. ``since=(as_of, days)`` applies D1
    at the scan."""
    e = _table(spark, sf_dir, "events")
    if since is not None:
        e = since_filter(e, "ts", *since)
    return event_messages(e)


def event_messages(events: DataFrame) -> DataFrame:
    """Mapping E on rows of the events table."""
    raw = events.select(F.col("user_id").alias("id"), F.col("event_type").alias("channel_id"),
                        F.col("event_type").alias("channel"),
                        F.concat("event_type", "props").alias("text"),
                        F.col("ts").alias("date"), F.col("event_id").alias("seq"))
    return with_fingerprint(normalize_messages(raw))


def events_by_value_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V: as E, but the text is the event value."""
    e = _table(spark, sf_dir, "events")
    raw = e.select(F.col("user_id").alias("id"), F.col("event_type").alias("channel_id"),
                   F.col("event_type").alias("channel"),
                   F.col("value").cast("string").alias("text"),
                   F.col("ts").alias("date"), F.col("event_id").alias("seq"))
    return with_fingerprint(normalize_messages(raw))


def events_by_user_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U: one channel, id = user_id, text = integer part of the value."""
    e = _table(spark, sf_dir, "events")
    raw = e.select(F.col("user_id").alias("id"), F.lit("events").alias("channel_id"),
                   F.lit("events").alias("channel"),
                   F.col("value").cast("bigint").cast("string").alias("text"),
                   F.col("ts").alias("date"), F.col("event_id").alias("seq"))
    return with_fingerprint(normalize_messages(raw))


def conversations_feed(spark: SparkSession, sf_dir: str,
                       ingest_time=FIXTURE_INGEST_TIME) -> DataFrame:
    """C: channel = role, id = conv_id/turn, arrival order = (conv_id, turn)."""
    c = _table(spark, sf_dir, "conversations")
    raw = c.select(F.concat_ws("/", "conv_id", "turn").alias("id"),
                   F.col("role").alias("channel_id"), F.col("role").alias("channel"),
                   "text", F.struct("conv_id", "turn").alias("seq"))
    return with_fingerprint(normalize_messages(raw, ingest_time=ingest_time))
