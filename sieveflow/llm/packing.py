"""Operator 8: packing by optimal length buckets.

Texts are cut into sequences of at most ``max_len`` units (nothing is lost: a
long text gives several). A unit is a word, or each ``UNIT_CHARS`` characters
begun of a longer one, so text without white space is cut too and a sequence
holds at most ``max_len`` * ``UNIT_CHARS`` characters besides white space. These
are no tokens: with ``tokenizer`` a unit is a token of operator 7. The global
histogram of the lengths has at most ``max_len`` + 1 rows; a dynamic program over it chooses the ``buckets`` upper
lengths that pad least in total. Inside a bucket sequences follow each other
in the order of a hash, and every run of ``budget // bucket length`` of them is
a batch of at most ``budget`` padded units.

Scale: one partial aggregation for the histogram, which is all that the driver
sees. The position in a bucket is a two-level running count: within 4,096 hash
ranges of the bucket and over the ranges' sums, so a bucket with a third of
all rows is spread over 4,096 groups.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveflow.llm.tokens import token_count
from sieveflow.session import materialize

MAX_LEN, BUCKETS, BUDGET = 2_048, 8, 16_384
#: characters of a word (at most 4 bytes each) that count as one unit
UNIT_CHARS = 64
_RANGE_DIGITS = 3


def best_buckets(histogram: dict[int, int], buckets: int) -> list[int]:
    """Upper lengths of at most ``buckets`` buckets with the least padding in
    all; of equal plans the one whose earlier buckets end sooner, from the last
    bucket on."""
    lens = np.array(sorted(histogram), np.int64)
    if not len(lens):
        return []
    count = np.concatenate(([0], np.cumsum([histogram[int(v)] for v in lens])))
    k, m = min(buckets, len(lens)), len(lens)
    # padded units when the first i lengths are in b buckets
    far = np.iinfo(np.int64).max // 4
    best = np.full(m + 1, far)
    best[0] = 0
    came = np.zeros((k + 1, m + 1), np.int64)
    for b in range(1, k + 1):
        now = np.full(m + 1, far)
        for i in range(b, m + 1):
            cost = best[b - 1:i] + lens[i - 1] * (count[i] - count[b - 1:i])
            j = int(cost.argmin())
            now[i], came[b, i] = cost[j], j + b - 1
        best = now
    out, i = [], m
    for b in range(k, 0, -1):
        out.append(int(lens[i - 1]))
        i = came[b, i]
    return out[::-1]


def unit_count(text: str) -> Column:
    """Words of a text (null: 0); a word of over ``UNIT_CHARS`` characters
    counts once for each ``UNIT_CHARS`` begun."""
    unit = rf"[^\x20\x09-\x0D]{{1,{UNIT_CHARS}}}"
    return F.coalesce(F.regexp_count(F.col(text), F.lit(unit)), F.lit(0)).cast("long")


def sequences(docs: DataFrame, id_col: str, text_col: str, max_len: int,
              tokenizer: str | None = None) -> DataFrame:
    """(id, piece, start, length, h): the sequences of every row; a text
    without units gives one of length 0."""
    units = unit_count(text_col) if tokenizer is None else token_count(text_col, tokenizer)
    words = docs.select(F.col(id_col).alias("id"), units.alias("words"),
                        F.coalesce(F.md5(F.col(text_col).cast("binary")), F.lit("")).alias("digest"))
    last = F.greatest(F.ceil(F.col("words") / max_len) - 1, F.lit(0))
    cut = words.select("id", "words", "digest", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    key = F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("piece").cast("string"), "digest")
    start = F.col("piece") * max_len
    return cut.select("id", "piece", start.alias("start"),
                      F.least(F.col("words") - start, F.lit(max_len)).cast("long").alias("length"),
                      F.md5(key.cast("binary")).alias("h"))


def _bucket(bounds: list[int]) -> Column:
    out = F.lit(len(bounds) - 1)
    for i in range(len(bounds) - 2, -1, -1):
        out = F.when(F.col("length") <= bounds[i], F.lit(i)).otherwise(out)
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_len: int = MAX_LEN,
         buckets: int = BUCKETS, budget: int = BUDGET, tokenizer: str | None = None) -> DataFrame:
    """(``id_col``, piece, start, length, bucket, bucket_len, batch, slot), one
    row per sequence.

    ``start`` and ``length`` are units of the text: words, cut every
    ``UNIT_CHARS`` characters, or with ``tokenizer`` (see ``count_tokens``) the
    text's token ids; ``batch`` counts from 0 within the bucket and ``slot`` within the batch. All batches of a bucket
    are full but the last. Null and empty texts give one sequence of length 0;
    null ids and repeated rows are rows like any other (wholly equal ones take
    neighbouring places). No rows: an empty result. Other columns are not read.
    """
    if max_len < 1 or buckets < 1 or budget < max_len:
        raise ValueError("max_len and buckets must be positive and a batch must hold max_len")
    seqs = materialize(sequences(docs, id_col, text_col, max_len, tokenizer), "packing")
    histogram = {r["length"]: r["n"] for r in seqs.groupBy("length").agg(F.count("*").alias("n")).collect()}
    bounds = best_buckets(histogram, buckets) or [max_len]
    ranged = (seqs.withColumn("bucket", _bucket(bounds))
              .withColumn("range", F.substring("h", 1, _RANGE_DIGITS)))
    sums = ranged.groupBy("bucket", "range").agg(F.count("*").alias("n"))
    line = Window.partitionBy("bucket").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    before = sums.select(F.col("bucket").alias("b"), F.col("range").alias("r"),
                         (F.sum("n").over(line) - F.col("n")).alias("before"))
    order = Window.partitionBy("bucket", "range").orderBy("h", "id", "piece")
    at = (ranged.withColumn("n", F.row_number().over(order))
          .join(before, (F.col("bucket") == F.col("b")) & (F.col("range") == F.col("r")))
          .withColumn("at", F.col("before") + F.col("n") - 1))
    bucket_len = F.element_at(F.array(*[F.lit(int(b)) for b in bounds]), F.col("bucket") + 1).cast("long")
    fits = F.floor(F.lit(budget) / F.greatest(bucket_len, F.lit(1)))
    return at.select(F.col("id").alias(id_col), "piece", "start", "length", "bucket",
                     bucket_len.alias("bucket_len"), F.floor(F.col("at") / fits).cast("long").alias("batch"),
                     (F.col("at") % fits).cast("long").alias("slot"))
