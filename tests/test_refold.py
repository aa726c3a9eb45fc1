"""The refold after removals and insertions against a full fold."""

import random

import pytest

from sieveflow.operators.ingest import ingest
from sieveflow.operators.refold import refold
from tests.fold import sequential_fold

SCHEMA = "seq long, channel_id string, message_id string, content_hash string"


def kept_of(rows):
    return sorted(s for s, v in sequential_fold(rows).items() if v == "new")


@pytest.mark.parametrize("seed", range(3))
def test_refold_equals_a_full_fold(spark, seed):
    rng = random.Random(seed)
    # many small groups of messages that share keys, and one large one
    rows = [(s, f"c{g}", f"m{rng.randrange(5)}", f"{g}h{rng.randrange(5)}")
            for s, g in ((s, rng.choice([0, *range(1, 40)])) for s in range(0, 1200, 2))]
    rows += [(s, "big", f"m{rng.randrange(30)}", f"bh{rng.randrange(40)}") for s in range(1, 400, 4)]
    df = spark.createDataFrame(rows, SCHEMA)
    first = ingest(df)
    gone = set(rng.sample([r[0] for r in rows], 12))
    late = [(1001 + 4 * k + 2 * (k % 2), f"c{rng.randrange(1, 40)}", f"m{rng.randrange(5)}", f"{rng.randrange(40)}h1")
            for k in range(4)]
    late = [(s + 10_000 if any(s == r[0] for r in rows) else s, *x) for s, *x in late] + [(3 if seed else -5, "big", "m1", "bh2")]
    left = [r for r in rows if r[0] not in gone]
    removed = spark.createDataFrame([(s,) for s in gone], "seq long")
    got = refold(df, first.kept, removed=removed)
    assert sorted(r.seq for r in got.kept.collect()) == kept_of(left)
    both = refold(df, first.kept, removed=removed, inserted=spark.createDataFrame(late, SCHEMA))
    want = kept_of(left + late)
    assert sorted(r.seq for r in both.kept.collect()) == want
    was = set(kept_of(rows)) - gone
    assert sorted(r.seq for r in both.admitted.collect()) == sorted(set(want) - was)
    assert sorted(r.seq for r in both.dropped.collect()) == sorted(was - set(want))
    # groups that the change does not touch are not read
    assert both.folded < 0.7 * len(rows)


def test_refold_of_nothing(spark):
    rows = [(1, "c", "1", "a"), (2, "c", "1", "b"), (3, "c", "2", "a"), (4, "c", "2", "b")]
    df = spark.createDataFrame(rows, SCHEMA)
    first = ingest(df)
    same = refold(df, first.kept, removed=spark.createDataFrame([(2,)], "seq long"))     # a duplicate goes
    assert sorted(r.seq for r in same.kept.collect()) == [1, 4] and same.folded == 0
    # without the first, the second and third come in and the last one goes
    all_new = refold(df, first.kept, removed=spark.createDataFrame([(1,)], "seq long"))
    assert sorted(r.seq for r in all_new.kept.collect()) == [2, 3]
    assert [r.seq for r in all_new.dropped.collect()] == [4]
