"""Operators 3, 5 and 8: shards, mixes and packed batches."""

import itertools
import random
from collections import Counter, defaultdict

import duckdb
import pytest
from llm_helpers import WORD, crc, docs_of
from sieveflow.llm import sharding
from sieveflow.llm.mixing import mix_documents, mix_plan
from sieveflow.llm.oracle import ORACLE_SQL, _op8
from sieveflow.llm.packing import best_buckets, pack
from sieveflow.llm.sharding import assign_shards
from sieveflow.llm.tokens import tokenizer_path


def rows_of(n=900, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text = " ".join(rng.choice(["alpha", "beta", "Gamma", "d"]) for _ in range(rng.choice([1, 5, 30, 200])))
        if i % 3 == 0:
            text = "a copy that a third of all rows hold"
        out.append((i, text, rng.choice(["a", "a", "a", "b", "c", "é", "Z", None])))
    return out + [(None, None, None), (None, "", "a"), (3, "repeated row", "b"), (3, "repeated row", "b"),
                  (9_999, "long " * 3_000, "long")]


# shards

def check_shards(rows, got, shards):
    assert len(got) == len(rows)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=str) == \
        sorted(((i, len((t or "").encode()) + 8, crc((t or "").encode())) for i, t, _ in rows), key=str)
    slots, size = defaultdict(list), Counter()
    for r in got:
        assert r["law"] == "bytes" and 0 <= r["shard"] < shards and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
        size[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return size


@pytest.mark.parametrize("points", [32, 1])
def test_shards_are_near_equal(spark, monkeypatch, points):
    monkeypatch.setattr(sharding, "POINTS_PER_RANGE", points)   # 1: ranges come out overfull
    rows = rows_of()
    size = check_shards(rows, assign_shards(docs_of(spark, rows, extra=True), 7).collect(), 7)
    mean = sum(size.values()) / 7
    longest = max(len((t or "").encode()) + 8 for _, t, _ in rows)
    assert all(abs(size[s] - mean) <= longest + 0.01 * mean for s in range(7))


def test_shards_do_not_depend_on_the_sample(spark, monkeypatch):
    df = docs_of(spark, [r for r in rows_of() if r[0] not in (None, 3)])
    key = lambda df: sorted((r["doc_id"], r["shard"], r["slot"]) for r in df.collect())
    one = key(assign_shards(df, 5))
    monkeypatch.setattr(sharding, "RANGES_PER_SHARD", 31)
    assert key(assign_shards(df.repartition(11), 5)) == one


def test_small_groups_stay_whole(spark):
    rows = [(i, f"text {i // 2} " * 10, "s") for i in range(3_000)]
    where = defaultdict(set)
    for r in assign_shards(docs_of(spark, rows), 4).collect():
        where[r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for s in where.values())


def test_shards_of_few_equal_or_no_rows(spark):
    same = [(1, "same", "s")] * 50
    assert max(check_shards(same, assign_shards(docs_of(spark, same), 5).collect(), 5).values()) == 10 * 12
    one = [(1, None, "s")]
    check_shards(one, assign_shards(docs_of(spark, one), 24).collect(), 24)
    assert assign_shards(docs_of(spark, one).limit(0), 24).count() == 0


def test_boundaries_cut_a_key_that_fills_several_quantiles():
    points = sorted([(1, i) for i in range(10)] + [(2, i) for i in range(80)] + [(3, i) for i in range(10)])
    got = sharding._boundaries(points, 10)
    assert got[0] == (2, -(1 << 63)) and sum(b[0] == 2 for b in got) > 5 and got == sorted(got)


# mixes

def duck(spark_rows, sql):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar, n_chars bigint)")
    con.executemany("insert into documents values (?, ?, 'en', ?, 0)", spark_rows)
    got = con.execute(sql)
    return [d[0] for d in got.description], got.fetchall()


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left, free = {}, 1.5 * sum(sizes.values()), set(order)
    while True:
        unit = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * unit > 2 * sizes[s]}
        if not over:
            return {**target, **{s: weight[s] * unit for s in free}}
        for s in over:
            target[s] = 2 * sizes[s]
            left -= target[s]
        free -= over


def test_mix_equals_sql_and_meets_its_targets(spark):
    rows = [r for r in rows_of() if r[0] != 3]
    df = docs_of(spark, rows, extra=True)
    got = mix_plan(df).collect()
    cols, want = duck(rows, ORACLE_SQL["op5_source_mix"])
    norm = lambda r: (str(r[0]), r[1], r[2], round(r[3], 6), r[4])
    assert sorted(norm([r[c] for c in cols]) for r in got) == sorted(map(norm, want))
    words = {i: len(WORD.findall(t or "")) for i, t, _ in rows}
    sizes, longest = Counter(), Counter()
    for i, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
        longest[s] = max(longest[s], len(WORD.findall(t or "")))
    targets = brute_targets(sizes)
    source = {i: s for i, _, s in rows}
    taken = Counter()
    for r in got:
        assert r["taken"] % max(1, r["size"]) == 0 and 0 <= r["taken"] <= 2 * r["size"]
        if r["doc_id"] is not None:
            assert r["size"] == words[r["doc_id"]]
            assert abs(r["target"] - targets[source[r["doc_id"]]]) < 1e-6
            taken[source[r["doc_id"]]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= longest[s]


def test_mixed_documents_are_the_plan(spark):
    rows = rows_of()
    df = docs_of(spark, rows, extra=True)
    out = mix_documents(df)
    assert out.columns == df.columns
    got = Counter((r["doc_id"], r["text"]) for r in out.collect())
    plan = Counter()
    for r in mix_plan(df).collect():
        plan[r["doc_id"], r["size"]] += r["taken"] // max(1, r["size"])
    assert Counter({(i, len(WORD.findall(t or ""))): n for (i, t), n in got.items()}) == +plan
    assert mix_documents(df.repartition(3)).count() == out.count()


def test_mix_of_no_or_empty_rows(spark):
    df = docs_of(spark, [(1, None, None), (2, "", "a")])
    assert [r["taken"] for r in mix_plan(df).collect()] == [0, 0] and mix_documents(df).count() == 0
    assert mix_plan(df.limit(0)).count() == 0


# packing

def test_best_buckets_pad_least():
    rng = random.Random(5)
    for _ in range(60):
        hist = {rng.randint(0, 30): rng.randint(1, 9) for _ in range(rng.randint(1, 9))}
        k = rng.randint(1, 4)

        def pad(bounds, hist=hist):
            return sum((min(b for b in bounds if b >= n) - n) * c for n, c in hist.items())

        got = best_buckets(hist, k)
        lens = sorted(hist)
        least = min(pad([*c, lens[-1]]) for c in itertools.combinations(lens[:-1], min(k, len(lens)) - 1))
        assert len(got) == min(k, len(lens)) and pad(got) == least
    assert best_buckets({}, 4) == []


def test_pack_equals_sql(spark):
    rows = [r for r in rows_of() if r[0] != 3]
    df = docs_of(spark, rows, extra=True)
    got = pack(df, max_len=64, buckets=4, budget=256).collect()
    cols, want = duck(rows, _op8(64, 4, 256))
    assert sorted((tuple(r[c] for c in cols) for r in got), key=str) == sorted(want, key=str)


def test_pack_loses_nothing_and_keeps_the_budget(spark):
    rows = rows_of()
    got = pack(docs_of(spark, rows), max_len=64, buckets=4, budget=256).collect()
    words, batches = Counter(), defaultdict(list)
    for r in got:
        words[r["doc_id"]] += r["length"]
        assert r["length"] <= r["bucket_len"] <= 64
        batches[r["bucket"], r["batch"]].append((r["slot"], r["bucket_len"]))
    want = Counter()
    for i, t, _ in rows:
        want[i] += len(WORD.findall(t or ""))
    assert words == want
    last = {b: max(n for c, n in batches if c == b) for b, _ in batches}
    for (b, n), slots in batches.items():
        assert sorted(s for s, _ in slots) == list(range(len(slots)))
        full = 256 // max(1, slots[0][1])
        assert len(slots) == full or n == last[b] and len(slots) < full


def test_pack_of_no_or_empty_rows(spark):
    df = docs_of(spark, [(1, None, "s"), (2, "", "s")])
    assert [r["length"] for r in pack(df).collect()] == [0, 0]
    assert pack(df.limit(0)).count() == 0


def test_pack_cuts_text_without_white_space(spark):
    rows = [(1, "漢" * 20_000, "s"), (2, "a few words", "s"), (3, "x" * 64 + " " + "y" * 65, "s")]
    got = pack(docs_of(spark, rows), max_len=64, buckets=4, budget=256).collect()
    pieces = sorted((r["piece"], r["start"], r["length"]) for r in got if r["doc_id"] == 1)
    assert pieces == [(k, 64 * k, min(64, 313 - 64 * k)) for k in range(5)]
    assert {r["doc_id"]: r["length"] for r in got if r["doc_id"] > 1} == {2: 3, 3: 3}


def test_pack_in_tokens_round_trip(spark):
    from tokenizers import Tokenizer

    name = "byte_bpe_50k.json"
    tok = Tokenizer.from_file(tokenizer_path(name))
    rows = [(1, "漢字かな" * 300, "s"), (2, "a few words of text", "s"), (3, None, "s"), (4, "", "s"),
            (5, "QUJDREVGR0g" * 200, "s"), (6, "words " * 500, "s")]
    got = pack(docs_of(spark, rows, extra=True), max_len=64, buckets=4, budget=256, tokenizer=name).collect()
    batches = Counter()
    for r in got:
        assert r["length"] <= r["bucket_len"] <= 64
        batches[r["bucket"], r["batch"]] += r["bucket_len"]
    assert max(batches.values()) <= 256
    for i, text, _ in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids
        cut = sorted((r["start"], r["length"]) for r in got if r["doc_id"] == i)
        back = [t for s, n in cut for t in ids[s:s + n]]
        assert back == ids and sum(n for _, n in cut) == len(ids)
        assert tok.decode(back, skip_special_tokens=False) == (text or "")
