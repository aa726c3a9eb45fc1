"""Operator 10: token ids in ORC files.

Layout of a token folder: ORC files of ``(part, doc_id, n_tokens, ids)`` rows,
in ascending document order within a file and from part to part. ORC stores
the ids with its integer run-length encoding, keeps minima and maxima per
stripe and row group (row index, every ``ROW_INDEX`` rows) and a Bloom filter
of the document ids, so readers split files by stripe and a filter on
``doc_id`` skips files, stripes and row groups by metadata alone.

Scale. One range shuffle of the rows by document id orders them (a hash of the
text breaks ties, so many rows under one id or under null still spread);
encoding runs after it, inside the writing tasks, so ids never cross the
network before they are in their file. Texts and ids reach the workers in
batches bounded by bytes (``bounded_batches``). Positions are prefix sums over two
levels: a window inside each part and sums over the parts, of which there are
as many as shuffle partitions. Nothing is gathered whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sieveflow.llm.tokens import encoder, slices
from sieveflow.session import bounded_batches, materialize, scratch_path

STRIPE_BYTES = 32 << 20
ROW_INDEX = 5_000
#: about how many bytes of text one written part holds
PART_BYTES = 48 << 20
#: bytes of text whose ids a worker holds at a time
SLICE_BYTES = 2 << 20
#: bytes that a row counts beside its text
ROW_BYTES = 16


def _encoded(tokenizer: str, end_id: int | None):
    """Rows (doc_id, tie, _text, part) to rows (part, doc_id, tie, n_tokens,
    ids): a record batch for each slice of texts, so a worker holds the ids of
    one slice."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, True)
        for batch in batches:
            at = 0
            for texts in slices(batch["_text"], SLICE_BYTES):
                ids = _with_end(*enc.encode(texts), end_id)
                rows = batch.slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [rows["part"], rows["doc_id"], rows["tie"], pc.list_value_length(ids).cast(pa.int64()), ids],
                    ["part", "doc_id", "tie", "n_tokens", "ids"])
                # what the slice took goes back to the system, not to the next batch only
                pa.default_memory_pool().release_unused()

    return encode


def _with_end(ids: np.ndarray, lens: np.ndarray, end_id: int | None) -> pa.Array:
    ends = np.cumsum(lens)
    if end_id is not None:
        ids = np.insert(ids, ends, end_id)
        ends = ends + np.arange(1, len(ends) + 1)
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()),
                                    pa.array(ids, pa.int32()))


def ids_crc32(ids: str | Column) -> Column:
    """CRC-32 of the ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("long")
    def crc(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            flat = batch.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes()
            at = np.asarray(batch.offsets)
            at = ((at - at[0]) * 4).tolist() if len(at) else [0]
            yield pa.array([zlib.crc32(flat[a:b]) for a, b in zip(at, at[1:])], pa.int64())

    return crc(F.col(ids) if isinstance(ids, str) else ids)


def write_token_files(docs: DataFrame, path: str, tokenizer: str = "word_bpe_49k.json",
                      end_id: int | None = 1, id_col: str = "doc_id", text_col: str = "text",
                      parts: int | None = None) -> None:
    """Writes the ids of every row of ``docs`` to ORC files in ``path``.

    Rows are in ascending order of ``id_col`` (null first; rows with one id in
    the order of a hash of their texts). A null or empty text has the end id
    only. Further columns of ``docs`` are not read. No rows: files without rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    if parts is None:
        size = docs.agg(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)) + ROW_BYTES)).first()[0] or 0
        parts = max(1, -(-size // PART_BYTES))
    tie = F.xxhash64("_text")
    ordered = (rows.withColumn("_tie", tie)
               .repartitionByRange(parts, F.col("doc_id"), F.col("_tie"))
               .sortWithinPartitions("doc_id", "_tie"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = (ordered.select(F.spark_partition_id().alias("part"), "doc_id", F.col("_tie").alias("tie"), "_text")
           .mapInArrow(_encoded(tokenizer, end_id), f"part int, doc_id {kind}, tie long, n_tokens long, ids array<int>"))
    with bounded_batches(docs.sparkSession):
        (out.write.mode("errorifexists")
         .option("compression", "zstd")
         .option("orc.stripe.size", STRIPE_BYTES)
         .option("orc.row.index.stride", ROW_INDEX)
         .option("orc.bloom.filter.columns", "doc_id")
         .option("orc.bloom.filter.fpp", 0.01)
         .orc(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(part, doc_id, tie, n_tokens, ids) rows of a token folder, in parallel by
    stripe; a filter on ``doc_id`` is pushed down to the files' metadata."""
    return spark.read.schema("part int, doc_id long, tie long, n_tokens long, ids array<int>").orc(path)


def token_positions(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every row of a token folder;
    ``start`` counts the ids of all rows before it."""
    with bounded_batches(files.sparkSession):
        sums = materialize(
            files.select("part", "doc_id", "tie", "n_tokens", ids_crc32("ids").alias("ids_crc32")), "tokens")
    per_part = sums.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    # one row for each written part
    before = per_part.select(
        F.col("part").alias("_part"),
        (F.sum("_n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n"))
        .alias("_before"))
    order = (Window.partitionBy("part").orderBy("doc_id", "tie", "ids_crc32")
             .rowsBetween(Window.unboundedPreceding, 0))
    return (sums.withColumn("_upto", F.sum("n_tokens").over(order))
            .join(before, F.col("part") == F.col("_part"))
            .select("doc_id", (F.col("_before") + F.col("_upto") - F.col("n_tokens")).alias("start"),
                    "n_tokens", "ids_crc32"))


def token_table(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int | None = 1,
                id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Writes ``docs`` as token files (in ``path``, else below the checkpoint
    folder) and returns :func:`token_positions` of what the files hold."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-files")
    write_token_files(docs, path, tokenizer, end_id, id_col, text_col)
    return token_positions(read_token_files(spark, path)).withColumnRenamed("doc_id", id_col)
