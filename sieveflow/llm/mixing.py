"""Operator 5: mixing sources to target weights by hash-threshold histograms.

Every row has a 60-bit hash of its id and text. A source's budget beyond whole
passes over it is filled with the rows whose hash lies below a threshold. The
threshold is found without a sort: sizes are summed by source and the hash's
first 12 bits, the bucket in which the running sum crosses the budget is the
only one refined by the next 12 bits, and so on; five nested rounds reach the
single hash value. Selecting is then a filter.

Scale: a round is one partial aggregation to at most 4,096 rows per source and
reads about 1/4096 of the round before; the sources' table (one row for each)
is the only thing joined to the rows, and Spark broadcasts it by its size. A
hot source is combined map-side. The hash makes reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveflow.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: weights of the sources in code-point order, repeating
WEIGHTS = (5, 2, 1)
#: budget as a share of all sizes, and the most a source gives, in times its size
SHARE, MOST = 1.5, 2
HASH_BITS, ROUND_BITS = 60, 12


def word_count(text: str) -> Column:
    """Words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(id_col: str, text: str) -> Column:
    """60-bit hash of the id and the text."""
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"),
                   F.coalesce(F.md5(F.col(text).cast("binary")), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def _source_key(source: str) -> Column:
    return F.when(F.col(source).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source).cast("string")))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(key, source_size, target, passes, rest) of every source in ``sizes``
    (key, source, size): ``passes`` whole passes over it and ``rest`` words.

    Sources are filled in the order of cap by weight: those below the common
    level stop at their cap and leave the excess to the others by weight.
    """
    per = materialize(sizes.groupBy("key", "source").agg(F.sum("size").alias("source_size")), "mixing")
    # windows over one row for each source
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    table = per.withColumn("w", weight).withColumn("cap", F.col("source_size") * float(most))
    every = Window.partitionBy()
    line = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    upto = line.rowsBetween(Window.unboundedPreceding, 0)
    after = line.rowsBetween(0, Window.unboundedFollowing)
    table = (table.withColumn("budget", F.sum("source_size").over(every) * F.lit(share))
             .withColumn("level", (F.col("budget") - (F.sum("cap").over(upto) - F.col("cap")))
                         / F.sum("w").over(after))
             .withColumn("capped", F.col("cap") <= F.col("level") * F.col("w"))
             .withColumn("free_level", F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("w"), F.col("level"))))
                         .over(every)["level"])
             .withColumn("target", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("free_level") * F.col("w"))))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    return (table.withColumn("passes", F.least(passes, F.lit(most)).cast("long"))
            .withColumn("rest", F.greatest(F.col("target") - F.col("passes") * F.col("source_size"), F.lit(0.0)))
            .select("key", "source_size", "target", "passes", "rest"))


def source_thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with ``below``: rows of the source whose hash is below it
    are taken once more than ``passes``; they sum up as near to ``rest`` as
    whole hash values allow."""
    state = targets.select("key", "rest", F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("sum"))
    rows = sizes.where("size > 0").select("key", "h", "size")
    bits = HASH_BITS
    while bits > 0:
        bits -= ROUND_BITS
        wide = 1 << (bits + ROUND_BITS)
        inside = (rows.join(state, "key")
                  .where((F.col("h") >= F.col("low")) & (F.col("h") < F.col("low") + F.lit(wide))))
        if bits + ROUND_BITS < HASH_BITS:
            rows = materialize(inside.select("key", "h", "size"), "mixing")
            inside = rows.join(state, "key")
        bucket = F.shiftright(F.col("h") - F.col("low"), bits)
        sums = inside.groupBy("key", "rest", "low", "sum", bucket.alias("bucket")).agg(F.sum("size").alias("g"))
        line = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        cross = (sums.withColumn("upto", F.col("sum") + F.sum("g").over(line))
                 .where(F.col("upto") > F.col("rest"))
                 .groupBy("key", "rest").agg(
                     F.min(F.struct("bucket", "low", F.col("upto").alias("upto"), "g")).alias("c")))
        state = materialize(cross.select(
            "key", "rest", (F.col("c.low") + F.col("c.bucket") * F.lit(1 << bits)).alias("low"),
            (F.col("c.upto") - F.col("c.g")).alias("sum"), F.col("c.g").alias("g")), "mixing")
        last = state
        state = state.drop("g")
    # the single value at the crossing comes in when that is nearer
    nearer = F.col("sum") * 2 + F.col("g") <= F.col("rest") * 2
    below = last.select("key", (F.col("low") + nearer.cast("long")).alias("below"))
    return (targets.join(below, "key", "left")
            .withColumn("below", F.coalesce("below", F.lit(0).cast("long"))))


def _planned(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights, share, most):
    sizes = materialize(docs.select(
        F.col(id_col).alias("id"), _source_key(source_col).alias("key"),
        F.col(source_col).cast("string").alias("source"), word_count(text_col).alias("size"),
        row_hash(id_col, text_col).alias("h")), "mixing")
    targets = materialize(source_targets(sizes, weights, share, most), "mixing")
    return sizes, materialize(source_thresholds(sizes, targets), "mixing")


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(``id_col``, size, source_size, target, taken), one row per row of ``docs``.

    ``taken`` is 0 to ``most`` times the size. Null sources form a source of
    their own (last in order); a null or empty text has size 0 and is never
    taken. Wholly equal rows share one hash and are taken together: of a
    source's budget only such a tie can stay open or be passed by its half. No
    rows: an empty result. Further columns are not read.
    """
    sizes, plan = _planned(docs, id_col, text_col, source_col, weights, share, most)
    times = F.col("passes") + (F.col("h") < F.col("below")).cast("long")
    return sizes.drop("source").join(plan, "key").select(
        F.col("id").alias(id_col), "size", "source_size", "target",
        (F.col("size") * F.least(times, F.lit(most).cast("long"))).alias("taken"))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The mix itself: ``docs`` with each row as often as it is taken (a row
    without words never). Columns are unchanged; see :func:`mix_plan`."""
    _, plan = _planned(docs, id_col, text_col, source_col, weights, share, most)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                       _source_key(source_col).alias("key"), word_count(text_col).alias("_size"),
                       row_hash(id_col, text_col).alias("_h"))
    times = F.least(F.col("passes") + (F.col("_h") < F.col("below")).cast("long"), F.lit(most).cast("long"))
    taken = (rows.join(plan, "key").withColumn("_times", F.when(F.col("_size") > 0, times).otherwise(F.lit(0)))
             .where("_times > 0"))
    again = F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))
    return taken.select("_doc", again.alias("_again")).select("_doc.*")
