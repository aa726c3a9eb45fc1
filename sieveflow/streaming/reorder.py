"""Event-time order across micro-batches.

A feed delivers messages somewhat out of order. The reorder buffer holds them
back until the watermark (the latest event time seen, less the allowed lateness)
has passed them: a micro-batch releases every buffered message older than the
watermark, in event-time order, so the released messages of all micro-batches
follow one another as a single feed sorted by (date, seq) would, whatever the
arrivals were. A message older than what was released already came too late: it
is written to ``late/`` and counted, not ingested.

``pending/after=N``, ``late/batch=N`` and ``marks/batch=N`` are plain tables of
micro-batch N. A micro-batch that runs again reads what N - 1 left and writes the
same tables again. Each micro-batch reads and writes the messages of the
lateness span only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import FILE_ROWS, folders, read_or_empty, remove

_MARKS = T.StructType([T.StructField("watermark", T.LongType()), T.StructField("late_rows", T.LongType()),
                       T.StructField("batch", T.LongType())])


def event_order(messages: DataFrame, date_col: str = "date", seq: str = "seq") -> DataFrame:
    """``seq`` becomes ``struct(micros, seq)``: arrival order by event time."""
    return messages.withColumn(seq, F.struct(_micros(date_col).alias("micros"), F.col(seq).alias("seq")))


def _micros(date_col: str):
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"),
                            F.col(date_col).cast("timestamp_ntz"))


def _write(messages: DataFrame, path: str) -> None:
    """In files of bounded rows: what one task wrote is read by several."""
    messages.write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS).parquet(path)


class ReorderBuffer:
    """Messages of a feed between their arrival and their release."""

    def __init__(self, spark: SparkSession, root: str, lateness_seconds: float, date_col: str = "date"):
        self.spark, self.root, self.date_col = spark, root.rstrip("/"), date_col
        self.lateness = int(lateness_seconds * 1_000_000)

    def marks(self, spark: SparkSession | None = None) -> DataFrame:
        """(watermark, late_rows, batch), one row per micro-batch."""
        return read_or_empty(spark or self.spark, f"{self.root}/marks", _MARKS)

    def late_rows(self, schema: T.StructType) -> DataFrame:
        """The messages that came too late."""
        return read_or_empty(self.spark, f"{self.root}/late", schema)

    def release(self, messages: DataFrame, batch: int, *, end_of_feed: bool = False) -> DataFrame:
        """The messages that micro-batch ``batch`` sets free: those buffered or
        new ones that the watermark has passed, or all at the end of the feed."""
        spark = messages.sparkSession
        before = (self.marks(spark).where(F.col("batch") < batch)
                  .agg(F.max_by("watermark", "batch").alias("mark"), F.max("batch").alias("batch")).first())
        micros = _micros(self.date_col)
        held = messages.limit(0)
        if before["batch"] is not None:
            held = read_or_empty(spark, f"{self.root}/pending/after={before['batch']}", messages.schema)
        passed = F.lit(False) if before["mark"] is None else micros < F.lit(before["mark"])
        late_path = f"{self.root}/late/batch={batch}"
        messages.where(passed).write.mode("overwrite").parquet(late_path)
        pool_path = f"{self.root}/pool/batch={batch}"
        _write(messages.where(~passed).unionByName(held), pool_path)
        pool = spark.read.schema(messages.schema).parquet(pool_path)
        top = pool.agg(F.max(micros)).first()[0]
        marks = [m for m in (before["mark"], None if top is None else top - self.lateness) if m is not None]
        mark = max(marks, default=None)
        if end_of_feed and top is not None:
            mark = top + 1
        free = F.lit(False) if mark is None else micros < F.lit(mark)
        _write(pool.where(~free), f"{self.root}/pending/after={batch}")
        late = spark.read.schema(messages.schema).parquet(late_path).count()
        (spark.createDataFrame([(mark, late)], T.StructType(_MARKS.fields[:2])).coalesce(1)
         .write.mode("overwrite").parquet(f"{self.root}/marks/batch={batch}"))
        # the tables before those a replay of this micro-batch would read
        if before["batch"] is not None:
            for name in ("pool", "pending"):
                for folder in folders(spark, f"{self.root}/{name}"):
                    if "=" in folder and int(folder.split("=")[1]) < before["batch"]:
                        remove(spark, f"{self.root}/{name}/{folder}")
        return pool.where(free)
