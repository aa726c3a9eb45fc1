"""Operator 13: groups of spelling variants, by dynamic programming over a
sorted word list.

The vocabulary is counted by Spark, sorted, and cut into contiguous blocks. In
a block the words stand in order, so words with a common prefix are one range,
and the longest common prefixes (LCP) of neighbours say where ranges end. A
search walks these ranges depth by depth with the three cells of the edit
matrix's row that can be 0 or 1; the row of a prefix is computed once for all
words of its range, and a range whose row exceeds one edit is left whole.

Two words at one edit agree on the first ``h`` code points or on the last
``length - h``, whatever ``h`` is. So each word searches the list of words and
the list of reversed words, in each only the range that shares its first (last)
half; a pair with an equal first half counts in the first list only. An
equality join on these halves tells which blocks hold the range.

Scale: blocks hold about ``BLOCK_WORDS`` words however common a prefix is; a
block that many words visit is worked on in several groups of ``VISITS``
visits. No pair leaves a task: a task returns, for each visitor, the count of
its near words and the best of them.

Nulls and ties: a null text has no words, a null id counts as an empty string;
an empty table gives an empty result. Repeated rows count as often as they
occur. Of near words that occur equally often the first in code-point order is
the form. Words may be of any length: from ``DEPTH`` code points on, the few
words left in a range are compared one by one. Only ``doc_id`` and ``text`` are
read, so further columns, whatever their names, have no influence.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveflow.session import materialize

#: words of a block of the sorted list
BLOCK_WORDS = 32_768
#: searches of a task
VISITS = 65_536
#: searches that walk the list at a time (memory of a task)
_STEP = 8_192
#: code points that are walked in ranges
DEPTH = 64

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LAST = chr(0x10FFFF)


def observed_words(docs: DataFrame, min_length: int = 7, typo_every: int = 31, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(word): the runs of letters of every text in lower case, one row per
    occurrence, of at least ``min_length`` code points. Where the checksum of
    ``id:run`` is a multiple of ``typo_every`` one code point is left out."""
    run = F.translate("run", UPPER, LOWER)
    rows = (docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
                        F.explode(F.regexp_extract_all(
                            F.col(f"`{text_col}`"), F.lit(r"[A-Za-zÀ-ÿ]{%d,}" % min_length),
                            F.lit(0))).alias("run"))
            .select("id", run.alias("run"))
            .withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % typo_every == 0, cut).otherwise(F.col("run"))
    return rows.select(word.alias("word")).where(F.length("word") >= min_length)


def vocabulary(words: DataFrame, min_count: int = 2) -> DataFrame:
    """(word, n) of the words that occur ``min_count`` times, written."""
    return materialize(words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count),
                       "spelling-vocabulary")


class SortedWords:
    """A sorted list of distinct words, walked by common prefixes."""

    def __init__(self, words: list[str]):
        self.words = words
        self.flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.length = np.array([len(w) for w in words], np.int64)
        self.at = np.cumsum(self.length) - self.length
        self.lcp = self._common()

    def _common(self) -> np.ndarray:
        """Code points that a word shares with the one before, up to DEPTH."""
        lcp = np.zeros(len(self.words), np.int16)
        same = np.arange(1, len(self.words))
        for d in range(DEPTH):
            same = same[np.minimum(self.length[same], self.length[same - 1]) > d]
            same = same[self.flat[self.at[same] + d] == self.flat[self.at[same - 1] + d]]
            if not len(same):
                break
            lcp[same] = d + 1
        lcp[:1] = -1
        return lcp

    def near(self, queries: list[str], halves: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) positions of words at exactly one edit that share the
        first ``halves`` code points of the query."""
        found = [self._walk(queries[i:i + _STEP], halves[i:i + _STEP], i) for i in range(0, len(queries), _STEP)]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found))

    def _walk(self, queries, halves, first):
        q = SortedQueries(queries)
        begin = np.array([bisect_left(self.words, w[:h]) for w, h in zip(queries, halves)], np.int64)
        end = np.array([bisect_left(self.words, w[:h] + _LAST) for w, h in zip(queries, halves)], np.int64)
        start = np.minimum(np.array(halves, np.int64), DEPTH)
        hits_q, hits_w = [], []
        # a state: query, range of the list, and the row's cells at the query's
        # columns depth - 1, depth and depth + 1
        none = np.empty(0, np.int64)
        who, lo, hi = none, none, none
        left, mid, right = (np.empty(0, np.int8) for _ in range(3))
        for d in range(int(start.min(initial=DEPTH)), DEPTH + 1):
            new = np.flatnonzero((start == d) & (end > begin))
            one, zero = np.ones(len(new), np.int8), np.zeros(len(new), np.int8)
            who, lo, hi = np.append(who, new), np.append(lo, begin[new]), np.append(hi, end[new])
            left, mid, right = np.append(left, one), np.append(mid, zero), np.append(right, one)
            if d == DEPTH or not len(who):
                if d == DEPTH:
                    break
                continue
            # the word that ends here comes first in its range
            ends = self.length[lo] == d
            over = q.length[who] - d
            cell = np.where(over == -1, left, np.where(over == 0, mid, np.where(over == 1, right, 2)))
            hit = ends & (cell == 1)
            hits_q.append(who[hit])
            hits_w.append(lo[hit])
            lo = lo + ends
            # ranges by the next code point
            borders = np.flatnonzero(self.lcp <= d)
            a, b = np.searchsorted(borders, lo), np.searchsorted(borders, hi)
            n = np.where(hi > lo, b - a, 0)
            state = np.repeat(np.arange(len(who)), n)
            spot = np.arange(len(state)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)
            lo = borders[spot]
            hi = np.minimum(np.append(borders, len(self.words))[spot + 1], hi[state])
            who, left, mid, right = who[state], left[state], mid[state], right[state]
            c = self.flat[self.at[lo] + d]
            # the next row, at columns d, d + 1 and d + 2
            low = np.minimum(left + (c != q.char(who, d - 1)), mid + 1)
            centre = np.minimum(np.minimum(mid + (c != q.char(who, d)), right + 1), low + 1)
            high = np.minimum(right + (c != q.char(who, d + 1)), centre + 1)
            centre = np.where(q.length[who] < d + 1, 2, centre)
            high = np.where(q.length[who] < d + 2, 2, high)
            live = np.minimum(np.minimum(low, centre), high) <= 1
            who, lo, hi = who[live], lo[live], hi[live]
            left, mid, right = (np.minimum(x[live], 2).astype(np.int8) for x in (low, centre, high))
        for i, x, y in zip(who, lo, hi):
            same = [j for j in range(x, y) if self.words[j][:halves[i]] == queries[i][:halves[i]]
                    and one_edit(queries[i], self.words[j])]
            hits_q.append(np.full(len(same), i, np.int64))
            hits_w.append(np.array(same, np.int64))
        if not hits_q:
            return none, none
        return np.concatenate(hits_q) + first, np.concatenate(hits_w)


class SortedQueries:
    """The code points of the words that are searched for."""

    def __init__(self, words: list[str]):
        self.flat = np.append(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), np.uint32(0))
        self.length = np.array([len(w) for w in words], np.int64)
        self.at = np.cumsum(self.length) - self.length

    def char(self, who: np.ndarray, d: int) -> np.ndarray:
        """Code point d of the queries; 0, which no word holds, beyond the end."""
        inside = self.length[who] > d
        return np.where(inside, self.flat[np.where(inside, self.at[who] + d, 0)], 0)


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one code point is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i:] == b[i + 1:] if len(a) < len(b) else a[i + 1:] == b[i + 1:]


def _search(key, listed: pa.Table, visits: pa.Table) -> pa.Table:
    """For each visiting word the count of its near words in this block that
    its list counts, and the best of them."""
    backwards = bool(key[0].as_py())
    listed = listed.sort_by("text")
    words, counts = listed["text"].to_pylist(), listed["n"].to_numpy()
    queries = visits["text"].to_pylist()
    halves = [_half(len(w), backwards) for w in queries]
    row, near = SortedWords(words).near(queries, halves)
    if backwards:
        # pairs with an equal first half were found in the list of words
        keep = np.fromiter((words[j][-k:] != queries[i][-k:] for i, j, k in
                            ((i, j, _half(len(queries[i]), False)) for i, j in zip(row, near))), bool, len(row))
        row, near = row[keep], near[keep]
    shown = [w[::-1] for w in words] if backwards else words
    rank = np.empty(len(words), np.int64)
    rank[np.array(sorted(range(len(words)), key=shown.__getitem__), np.int64)] = np.arange(len(words))
    order = np.lexsort((rank[near], -counts[near], row))
    row, near = row[order], near[order]
    head = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.empty(0, np.int64)
    return pa.table({
        "word": pa.array([queries[i][::-1] if backwards else queries[i] for i in row[head]], pa.string()),
        "n_near": pa.array(np.diff(np.append(head, len(row))), pa.int64()),
        "best": pa.array([shown[j] for j in near[head]], pa.string()),
        "best_n": pa.array(counts[near[head]], pa.int64())})


def _half(length, backwards):
    """Code points of a word that its near words share at the start, or, in the
    list of reversed words, at the end. Plain numbers or columns."""
    first = F.floor(length / 2).cast("int") if hasattr(length, "cast") else length // 2
    return length - first if backwards else first


def near_words(vocab: DataFrame, block_words: int = BLOCK_WORDS, visits: int = VISITS) -> DataFrame:
    """(word, n_near, best, best_n), partial rows: for words of ``vocab``
    (word, n) with near words their count and the best of them, by block."""
    blocks = max(1, -(-2 * vocab.count() // block_words))
    listed = materialize(
        vocab.select("n", F.explode(F.array(F.struct(F.lit(0).alias("dir"), F.col("word").alias("text")),
                                            F.struct(F.lit(1).alias("dir"), F.reverse("word").alias("text")))).alias("x"))
        .select("x.dir", "x.text", "n").repartitionByRange(blocks, "dir", "text")
        .withColumn("block", F.spark_partition_id()), "spelling-list")
    size = F.length("text")

    def half(length):
        return F.when(F.col("dir") == 0, _half(length, False)).otherwise(_half(length, True))

    # where words shared with a search of a length one less, equal or one more lie
    held = (listed.select("dir", "block", F.explode(F.array_distinct(F.array(
                *[F.substring("text", F.lit(1), half(size + d)) for d in (-1, 0, 1)]))).alias("key")).distinct())
    visit = materialize(
        listed.select("dir", "text", F.substring("text", F.lit(1), half(size)).alias("key"))
        .join(held, ["dir", "key"]).select("dir", "block", "text"), "spelling-visits")
    groups = visit.groupBy("dir", "block").agg(F.ceil(F.count("*") / visits).cast("int").alias("groups"))
    groups = materialize(groups, "spelling-groups")
    left = (listed.join(groups, ["dir", "block"])
            .select("dir", "block", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"), "text", "n"))
    right = (visit.join(groups, ["dir", "block"])
             .select("dir", "block", F.pmod(F.xxhash64("text"), "groups").cast("int").alias("part"), "text"))
    by = ["dir", "block", "part"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(
        _search, "word string, n_near long, best string, best_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last form that is reached from each word of ``forms``
    (word, form). Counts grow tenfold from form to form, so chains are short;
    each round doubles the steps taken."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = materialize(now.join(step, "root", "left")
                          .select("word", F.coalesce("further", "root").alias("root"),
                                  F.col("further").isNotNull().alias("moved")), "spelling-roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def spelling_groups(docs: DataFrame, min_length: int = 7, min_count: int = 2, factor: int = 10,
                    typo_every: int = 31, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs``: ``form``
    is the near word that occurs most, if at least ``factor`` times as often."""
    vocab = vocabulary(observed_words(docs, min_length, typo_every, id_col, text_col), min_count)
    none = F.lit(None)
    rows = (vocab.select("word", "n", F.lit(0).cast("long").alias("n_near"), none.cast("string").alias("best"),
                         none.cast("long").alias("best_n"))
            .unionByName(near_words(vocab).withColumn("n", none.cast("long"))))
    best = F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("order"), F.col("best").alias("word")))
    one = rows.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min(best).alias("best"))
    taken = -F.col("best.order") >= factor * F.col("n")
    table = materialize(one.select("word", F.when(taken, F.col("best.word")).alias("form"), "n", "n_near",
                                   F.when(taken, -F.col("best.order")).alias("form_n")), "spelling-forms")
    root = roots(table.where("form is not null").select("word", "form"))
    return (table.join(root, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
