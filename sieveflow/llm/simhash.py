"""Operator 2: SimHash near-duplicates through deletion-variant signatures.

Fingerprint: the text, A-Z lower-cased, is cut into words (runs of bytes
other than space and 0x09-0x0D); every run of ``shingle`` words, repeats
included and joined by one space, is hashed with XXH64 (seed 42). A bit of
the fingerprint is 1 when it is set in over half of the hashes.

Links at ``distance`` d or fewer bits: the 64 bits are cut into only
``d // 2 + 1`` segments, so some segment of a linked pair differs by at most
one bit. Each fingerprint is indexed under every segment with one bit
position left out (64 signatures in all, whatever the segment count); linked
fingerprints share a signature, found by an equality shuffle and verified on
all 64 bits.

Scale. Copies collapse before the index: it holds *distinct* fingerprints.
Inside a signature's group the links are not emitted as pairs: a breadth-first
search over the group's numpy array emits a spanning forest, so a group of m
fingerprints yields at most m - 1 edges and needs O(m) memory of 8 bytes.
Groups stay small: with 64-bit fingerprints and ~20 fixed bits a group expects
N / 2^20 chance members, and a dense cluster of near copies holds at most the
few 10^5 fingerprints that lie within a ball of radius 4 over the 44 free bits,
however many documents carry them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveflow.llm.components import connected_components
from sieveflow.session import materialize

BITS = 64
#: shingle hashes whose bits are counted at a time
_COUNT_BLOCK = 1 << 15


def fingerprint_of(text: str | None, shingle: int) -> int:
    """The fingerprint of one text as an unsigned integer (null, no word: 0)."""
    import xxhash

    if not text:
        return 0
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    data = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(data, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for k in range(0, n, _COUNT_BLOCK):
        stop = min(n, k + _COUNT_BLOCK)
        h = np.array([digest(data[s:e], 42) for s, e in zip(
            starts[k:stop].tolist(), ends[k + shingle - 1:stop + shingle - 1].tolist())], dtype=np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def simhash(text: str | Column, shingle: int = 4) -> Column:
    """Column of the 64-bit fingerprint of ``text`` as a (signed) long."""

    @F.arrow_udf("long")
    def fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = np.fromiter((fingerprint_of(t.as_py(), shingle) for t in batch),
                              np.uint64, len(batch))
            yield pa.array(out.view(np.int64))

    return fingerprints(F.col(text) if isinstance(text, str) else text)


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of the segments for links at ``distance`` bits."""
    if not 0 <= distance < BITS:
        raise ValueError("distance must be from 0 to 63")
    n = distance // 2 + 1
    cuts = [round(i * BITS / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def signatures(fp: str | Column, distance: int) -> Column:
    """Array of the 64 one-wildcard segment signatures of a fingerprint:
    number of the wildcard bit, then the segment with that bit cleared."""
    fp = F.col(fp) if isinstance(fp, str) else fp
    out = []
    for first, width in segments(distance):
        # a signature is one long: the wildcard's number above, the segment below
        if width > 56:
            out += [F.xxhash64(F.lit(first + p), fp.bitwiseAND(F.lit(~(1 << p) if p < 63 else (1 << 63) - 1)))
                    for p in range(width)]
            continue
        seg = F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1))
        out += [seg.bitwiseAND(F.lit(((1 << width) - 1) ^ (1 << p)))
                .bitwiseXOR(F.lit((first + p) << 57))
                for p in range(width)]
    return F.array(*out)


def _forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Spanning forest of one group's links (fps distinct, uint64)."""
    left, edges = fps, []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= distance
            if near.any():
                found = left[near]
                left = left[~near]
                edges += [(int(x), int(y)) for y in found]
                queue.extend(found)
    return edges


def _links_of_sorted(keys: np.ndarray, fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal keys."""
    cut = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    starts = np.concatenate(([0], cut))
    sizes = np.diff(np.concatenate((starts, [len(keys)])))
    two = starts[sizes == 2]
    a, b = fps[two], fps[two + 1]
    near = np.bitwise_count(a ^ b) <= distance
    a, b = [a[near]], [b[near]]
    for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        if edges := _forest(fps[s:s + n], distance):
            pairs = np.array(edges, dtype=np.uint64)
            a.append(pairs[:, 0])
            b.append(pairs[:, 1])
    return np.concatenate(a), np.concatenate(b)


def fingerprint_links(fps: DataFrame, fp: str, distance: int) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of the distinct
    fingerprints in ``fps`` that differ by at most ``distance`` bits."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, vals = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            keys = np.concatenate((keys, batch.column(0).to_numpy()))
            vals = np.concatenate((vals, batch.column(1).to_numpy().view(np.uint64)))
            # the last run may go on in the next batch
            whole = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if whole:
                a, b = _links_of_sorted(keys[:whole], vals[:whole], distance)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])
                keys, vals = keys[whole:].copy(), vals[whole:].copy()
        if len(keys):
            a, b = _links_of_sorted(keys, vals, distance)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    index = fps.select(F.explode(signatures(fp, distance)).alias("_sig"), F.col(fp).alias("_fp"))
    grouped = index.repartition("_sig").sortWithinPartitions("_sig")
    return grouped.mapInArrow(links, "a long, b long").distinct()


def _prints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(_id, _fp, _h) of every row, written once; _h is a hash of the text."""
    return materialize(
        docs.select(F.col(id_col).alias("_id"), simhash(F.col(text_col), shingle).alias("_fp"),
                    F.xxhash64(F.col(text_col)).alias("_h")), "simhash")


def _with_roots(least: DataFrame, distance: int) -> DataFrame:
    """``least`` (one row for each distinct ``_fp``) with the component ``_comp``."""
    edges = fingerprint_links(least.select("_fp"), "_fp", distance)
    comps = connected_components(edges).select(
        F.col("node").alias("_fp"), F.col("component").alias("_comp"))
    return (least.join(comps, "_fp", "left")
            .withColumn("_comp", F.coalesce("_comp", "_fp")))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 4, distance: int = 4) -> DataFrame:
    """(``id_col``, fingerprint, component_id), one row per row of ``docs``.

    ``fingerprint`` is 16 lowercase hex digits; ``component_id`` the smallest
    id reachable through links of at most ``distance`` differing bits, the
    row's own included. Texts that are null or have no word get fingerprint
    zero and link like any other; repeated rows give repeated rows; a null id
    is returned and never is the smallest (a component of null ids only has a
    null component). Other columns of ``docs`` are not read, whatever their
    names. No rows: an empty result.
    """
    prints = _prints(docs, id_col, text_col, shingle)
    least = materialize(prints.groupBy("_fp").agg(F.min("_id").alias("_min")), "simhash")
    roots = materialize(_with_roots(least, distance), "simhash")
    ids = roots.groupBy("_comp").agg(F.min("_min").alias("component_id"))
    by_print = roots.join(ids, "_comp").select("_fp", "component_id")
    return (prints.join(by_print, "_fp")
            .select(F.col("_id").alias(id_col),
                    F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id"))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shingle: int = 4, distance: int = 4) -> DataFrame:
    """``docs`` with one row kept of each near-duplicate component.

    The row with the smallest id stays (null ids come last); of rows that
    share that id, the one whose text has the smallest XXH64; of wholly equal
    rows, one. All columns of ``docs`` come back unchanged, whatever their
    names; no rows: an empty result.
    """
    cols = docs.columns
    prints = _prints(docs, id_col, text_col, shingle)
    row = F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id").alias("id"), F.col("_h").alias("h"))
    least = materialize(prints.groupBy("_fp").agg(F.min(row).alias("_row")), "simhash")
    keep = (_with_roots(least, distance).groupBy("_comp").agg(F.min("_row").alias("_row"))
            .select(F.col("_row.id").alias("_id"), F.col("_row.h").alias("_h")))
    # the key of a survivor may be carried by several wholly equal texts under one id
    times = prints.groupBy("_id", "_h").agg(F.count("*").alias("_times"))
    keep = materialize(
        keep.join(times.select(F.col("_id").alias("_i"), F.col("_h").alias("_g"), "_times"),
                  F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_h") == F.col("_g")))
        .select("_i", "_g", "_times"), "simhash")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_doc"),
                       F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_h"))
    on = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_h") == F.col("_g"))
    single = rows.join(keep.where("_times = 1"), on, "left_semi")
    repeated = (rows.join(keep.where("_times > 1"), on, "left_semi")
                .groupBy("_id", "_h").agg(F.first("_doc").alias("_doc")))
    return single.select("_doc.*").union(repeated.select("_doc.*"))
