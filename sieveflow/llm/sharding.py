"""Operator 3: shards of near-equal size by sampled splitters.

1. Rows get a sort key: a hash of the text (copies lie side by side), then a
   hash of the id, whose last bits also tell wholly equal rows apart. The
   narrow keyed table (no text) is written once.
2. A size-weighted sample of the keys gives quantile boundaries of many more
   ranges than shards. A key is cut at its first row only, unless it fills
   several quantiles.
3. Rows are range-partitioned by the boundaries and the ranges' sizes summed
   exactly. Ranges over twice the wanted size are subdivided by a sample of
   their own until none is left.
4. Running sums inside each range plus the sums of the ranges before it place
   every row on one line of bytes from 0 to the total; shard i takes the i-th
   equal part. A group of equal texts goes where its middle lies, whole, as
   long as it is small against a shard; larger groups are cut.

The law held is ``bytes``: a shard's size differs from the mean by at most one
text plus ``GROUP_SHARE`` of a shard. Sampling decides only how evenly the
work is spread, never the result.

Scale: ranges grow with the rows (``RANGE_ROWS`` each), so no window task
grows; the driver holds the boundaries and one number per range, 24 bytes per
``RANGE_ROWS`` rows. Text is read once and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveflow.session import materialize

#: rows that one range is to hold, and ranges per shard at least
RANGE_ROWS = 250_000
RANGES_PER_SHARD = 8
#: expected sample points for each range
POINTS_PER_RANGE = 32
#: groups of equal texts up to this share of a shard stay whole
GROUP_SHARE = 0.01

_LOW = (1 << 20) - 1


def keyed_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, size, crc, k1, k2): the narrow table that is sorted and cut."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    k2 = (F.xxhash64(F.col(id_col)).bitwiseAND(F.lit(~_LOW))
          .bitwiseOR(F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit(_LOW))))
    return docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("crc"), F.xxhash64(text).alias("k1"), k2.alias("k2"))


def _sample(rows: DataFrame, per_byte: float) -> list[tuple[int, int]]:
    """Keys drawn in proportion to size: a row of size s is drawn
    floor(s * per_byte + u) times, u a uniform hash of its key."""
    u = F.pmod(F.xxhash64("k1", "k2", F.lit(3)), F.lit(1 << 40)) / float(1 << 40)
    times = F.floor(F.col("size") * F.lit(per_byte) + u).cast("int")
    drawn = rows.select("k1", "k2", times.alias("n")).where("n > 0")
    return sorted((r["k1"], r["k2"]) for r in drawn.collect() for _ in range(r["n"]))


_FIRST = -(1 << 63)


def _boundaries(points: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """n - 1 quantiles of sorted points; a key's first boundary is its first row."""
    picks = [points[len(points) * i // n] for i in range(1, n)] if points else []
    out, last = [], None
    for k1, k2 in picks:
        out.append((k1, _FIRST if k1 != last else k2))
        last = k1
    return sorted(set(out))


def _range_of(bounds: list[tuple[int, int]]) -> Column:
    """Number of boundaries at or below the key (k1, k2)."""
    s1 = np.array([b[0] for b in bounds], np.int64)
    s2 = np.array([b[1] for b in bounds], np.int64)

    @F.arrow_udf("int")
    def numbered(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b in batches:
            k1, k2 = a.to_numpy(), b.to_numpy()
            low, high = np.searchsorted(s1, k1, "left"), np.searchsorted(s1, k1, "right")
            out = low.copy()
            for i in np.flatnonzero(high > low):  # keys that are boundaries themselves
                out[i] += np.searchsorted(s2[low[i]:high[i]], k2[i], "right")
            yield pa.array(out.astype(np.int32))

    return numbered(F.col("k1"), F.col("k2")) if bounds else F.lit(0)


def assign_shards(docs: DataFrame, shards: int = 24, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(``id_col``, size, text_crc32, law, shard, slot, grown_shard), one row
    per row of ``docs``.

    Size is the text's UTF-8 bytes plus 8 (a null text counts as empty);
    shards differ in bytes by little (see the module); slots of a shard run
    from 0 without gaps. ``grown_shard`` is null: this is not the ``key`` law.
    Copies share a shard unless they outweigh ``GROUP_SHARE`` of one; wholly
    equal rows and null ids are rows like any other. Further columns are not
    read. No rows: an empty result.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    rows = materialize(keyed_rows(docs, id_col, text_col), "sharding")
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = max(shards * RANGES_PER_SHARD, -(-n // RANGE_ROWS))
    wanted = max(1, -(-total // ranges))
    bounds = _boundaries(_sample(rows, ranges * POINTS_PER_RANGE / total), ranges) if n else []
    while True:
        placed = rows.withColumn("range", _range_of(bounds))
        sums = {r["range"]: r for r in placed.groupBy("range").agg(
            F.sum("size").alias("bytes"), F.count("*").alias("rows"),
            F.min(F.struct("k1", "k2")).alias("first"), F.max(F.struct("k1", "k2")).alias("last")).collect()}
        over = [k for k, r in sums.items() if r["bytes"] > 2 * wanted and r["rows"] > 1 and r["first"] != r["last"]]
        if not over:
            break
        more = []
        for k, points in _points_by_range(placed, over, POINTS_PER_RANGE / wanted).items():
            parts = max(2, -(-sums[k]["bytes"] // wanted))
            more += _boundaries(points, parts)
        new = sorted(set(bounds) | set(more))
        if len(new) == len(bounds):   # single texts larger than a range
            break
        bounds = new
    placed = rows.withColumn("range", _range_of(bounds))
    order = sorted(sums)
    before_bytes = np.concatenate(([0], np.cumsum([sums[k]["bytes"] for k in order], dtype=np.int64)))
    before_rows = np.concatenate(([0], np.cumsum([sums[k]["rows"] for k in order], dtype=np.int64)))
    spark = docs.sparkSession
    # one row for each range
    offsets = spark.createDataFrame(
        [(int(k), int(b), int(r)) for k, b, r in zip(order, before_bytes, before_rows)],
        "range int, before_bytes long, before_rows long")
    line = Window.partitionBy("range").orderBy("k1", "k2", "id", "size", "crc")
    upto = line.rowsBetween(Window.unboundedPreceding, 0)
    group = Window.partitionBy("range", "k1")
    at = (placed.withColumn("n", F.row_number().over(line))
          .withColumn("end", F.sum("size").over(upto))
          .withColumn("g_start", F.min(F.col("end") - F.col("size")).over(group))
          .withColumn("g_size", F.sum("size").over(group))
          .join(offsets, "range"))
    whole = F.col("g_size") <= F.lit(int(total / shards * GROUP_SHARE))
    # twice the middle of the group or of the row
    middle = F.when(whole, F.col("before_bytes") * 2 + F.col("g_start") * 2 + F.col("g_size")) \
        .otherwise(F.col("before_bytes") * 2 + F.col("end") * 2 - F.col("size"))
    shard = F.expr(f"int(least({shards - 1}, (middle * {shards}) div {2 * max(total, 1)}))")
    done = materialize(at.withColumn("middle", middle).select(
        "id", "size", "crc", shard.alias("shard"),
        (F.col("before_rows") + F.col("n") - 1).alias("row")), "sharding")
    first = done.groupBy("shard").agg(F.min("row").alias("first"))   # a row for each shard
    return done.join(first, "shard").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", (F.col("row") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def _points_by_range(placed: DataFrame, ranges: list[int], per_byte: float) -> dict[int, list]:
    """Sample points of each of ``ranges``."""
    some = placed.where(F.col("range").isin(ranges))
    u = F.pmod(F.xxhash64("k1", "k2", F.lit(5)), F.lit(1 << 40)) / float(1 << 40)
    drawn = some.select("range", "k1", "k2",
                        F.floor(F.col("size") * F.lit(per_byte) + u).cast("int").alias("n")).where("n > 0")
    out: dict[int, list] = {}
    for r in drawn.collect():
        out.setdefault(r["range"], []).extend([(r["k1"], r["k2"])] * r["n"])
    return {k: sorted(v) for k, v in out.items()}
