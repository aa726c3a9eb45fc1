"""JSON state documents: written (K11), read back (K3), dated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ingest import ID_KEY, IngestState
from ..session import folders, materialize

# The columns of the JSON state document.
SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("processed_message_ids",
                  T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
    T.StructField("content_hashes", T.ArrayType(T.StringType())),
    T.StructField("last_message_ids", T.MapType(T.StringType(), T.StringType())),
    T.StructField("saved_at", T.StringType()),
])


def snapshot_documents(state: IngestState, saved_at: str, marks: DataFrame | None = None,
                       chunk_rows: int = 100_000, total_ids: int | None = None,
                       total_hashes: int | None = None) -> DataFrame:
    """K11 as DataFrame: JSON state documents (M10), each holding a bounded
    chunk of the state, so no channel's ID list is gathered in one task.

    IDs are chunked by ``pmod(xxhash64(id), K)`` with K = ids / chunk_rows, so
    every (channel, chunk) group holds about ``chunk_rows`` IDs or fewer,
    however large the channel."""
    # four readers: two counts and two sets of documents
    ids = materialize(state.distinct_ids(), "snapshot-ids")
    hashes = materialize(state.distinct_hashes(), "snapshot-hashes")
    n_ids = total_ids if total_ids is not None else ids.count()
    n_hashes = total_hashes if total_hashes is not None else hashes.count()
    k_ids = max(1, -(-n_ids // chunk_rows))
    k_hashes = max(1, -(-n_hashes // chunk_rows))
    empty_ids = F.create_map().cast(SNAPSHOT_SCHEMA["processed_message_ids"].dataType)
    empty_hashes = F.array().cast(T.ArrayType(T.StringType()))
    empty_marks = F.create_map().cast(SNAPSHOT_SCHEMA["last_message_ids"].dataType)
    id_docs = (ids.withColumn("_c", F.pmod(F.xxhash64(*ID_KEY), F.lit(k_ids)))
               .groupBy("channel_id", "_c")
               .agg(F.array_sort(F.collect_list("message_id")).alias("_ids"))
               .select(F.create_map("channel_id", "_ids").alias("processed_message_ids"),
                       empty_hashes.alias("content_hashes"),
                       empty_marks.alias("last_message_ids")))
    hash_docs = (hashes.withColumn("_c", F.pmod(F.xxhash64("content_hash"), F.lit(k_hashes)))
                 .groupBy("_c")
                 .agg(F.array_sort(F.collect_list("content_hash")).alias("_h"))
                 .select(empty_ids.alias("processed_message_ids"),
                         F.col("_h").alias("content_hashes"),
                         empty_marks.alias("last_message_ids")))
    docs = id_docs.unionByName(hash_docs)
    if marks is not None:
        docs = docs.unionByName(marks.select(
            empty_ids.alias("processed_message_ids"), empty_hashes.alias("content_hashes"),
            F.create_map("channel_id", "message_id").alias("last_message_ids")))
    return docs.withColumn("saved_at", F.lit(saved_at))


def write_snapshot(state: IngestState, path: str, saved_at: str, *, version: int | None = None,
                   marks: DataFrame | None = None, chunk_rows: int = 100_000) -> str:
    """K11 (and D15 when ``version`` is given): write the state documents as
    JSON lines. Returns the folder written."""
    out = path if version is None else f"{path}/version={int(version)}"
    snapshot_documents(state, saved_at, marks, chunk_rows).write.mode("overwrite").json(out)
    return out


def read_marks(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """D12 from state documents: ``(channel_id, last_message_id)``."""
    docs = spark.read.schema(SNAPSHOT_SCHEMA).option("multiLine", multi_line).json(path)
    return docs.select(F.explode("last_message_ids").alias("channel_id", "last_message_id"))


def read_snapshot(spark: SparkSession, path: str, multi_line: bool = False) -> IngestState:
    """K3: read state documents (our JSON lines, or the reference's single
    indented document with ``multi_line=True``) and flatten them."""
    docs = spark.read.schema(SNAPSHOT_SCHEMA).option("multiLine", multi_line).json(path)
    ids = (docs.select(F.explode("processed_message_ids").alias("channel_id", "_ids"))
           .select("channel_id", F.explode("_ids").alias("message_id")))
    hashes = docs.select(F.explode("content_hashes").alias("content_hash"))
    return IngestState(ids, hashes)


def read_latest_snapshot(spark: SparkSession, path: str) -> IngestState:
    """The highest version below ``path``, or the documents right in it;
    no snapshot: an empty state."""
    names = folders(spark, path)
    versions = [int(n.split("=")[1]) for n in names if n.startswith("version=")]
    if not names:
        return IngestState.empty(spark)
    return read_snapshot(spark, f"{path}/version={max(versions)}" if versions else path)
