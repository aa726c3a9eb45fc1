"""J1/J2 against a long history: read only what the batch's keys can hit.

The state's key tables are sorted Parquet files. From the keys of a batch a
small set of ranges is derived that holds them all, and pushed to the scan as
an ordinary filter: Parquet skips files, row groups and pages whose minimum and
maximum (or, for a single key, Bloom filter) exclude them. The ranges follow
the keys' common prefixes, so keys that lie together, such as the next message
ids of some channels, give narrow ranges however far apart these channels are.
Evenly spread keys (hashes of a large batch) exclude little, and the scan then
reads what it would have read anyway.

The filter decides nothing: each range holds whole keys of the batch, and the
rows that pass are joined with the keys as before.
"""

from __future__ import annotations

from os.path import commonprefix

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ranges asked for, at most about as many reach the driver
MAX_RANGES = 64
#: characters beyond the prefix common to all keys that are tried
_FURTHER = (1, 2, 4, 7, 12, 20)


def _either(parts: list[Column]) -> Column:
    """A balanced OR: a chain would be as deep as it is long."""
    if len(parts) == 1:
        return parts[0]
    mid = len(parts) // 2
    return _either(parts[:mid]) | _either(parts[mid:])


def _between(key: list[str], low: tuple, high: tuple) -> Column:
    """low <= (key columns) <= high in order of the columns, written so that
    each comparison is of one column with one value."""
    c, lo, hi = F.col(key[0]), F.lit(low[0]), F.lit(high[0])
    if len(key) == 1:
        return c == lo if low[0] == high[0] else (c >= lo) & (c <= hi)
    if low[0] == high[0]:
        return (c == lo) & _between(key[1:], low[1:], high[1:])
    rest = F.col(key[1])
    return (((c == lo) & (rest >= F.lit(low[1]))) | ((c == hi) & (rest <= F.lit(high[1])))
            | ((c > lo) & (c < hi)))


def key_ranges(keys: DataFrame, key: list[str], max_ranges: int = MAX_RANGES) -> Column:
    """A condition on the ``key`` columns (one or two strings) that every row
    of ``keys``, a written table, satisfies, made of about ``max_ranges`` ranges."""
    rows = keys.select(*key).dropna()
    text = F.concat_ws("\0", *key)
    ends = rows.agg(F.min(text).alias("low"), F.max(text).alias("high")).first()
    if ends["low"] is None:
        return F.lit(False)
    common = len(commonprefix([ends["low"], ends["high"]]))
    counts = rows.agg(*[F.approx_count_distinct(F.substring(text, 1, common + n)).alias(f"n{n}")
                        for n in _FURTHER]).first()
    length = common + max((n for n in _FURTHER if counts[f"n{n}"] <= max_ranges), default=0)
    spot = F.struct(*key)
    ranges = (rows.groupBy(F.substring(text, 1, length).alias("prefix"))
              .agg(F.min(spot).alias("low"), F.max(spot).alias("high")).collect())
    return _either([_between(key, tuple(r["low"]), tuple(r["high"])) for r in ranges])
