"""Water-filling against a loop, closeness to targets, repeatability, corner cases."""

import random

import pytest
from pyspark.sql import functions as F

from rowsmith.llm import mixing


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Clamp and share the excess again until none is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), {}
    while True:
        left = total - sum(capped.values())
        free = [s for s in names if s not in capped]
        want = {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
        over = {s: most * sizes[s] for s in free if want[s] > most * sizes[s]}
        if not over:
            return capped | want
        capped |= over


def mixed(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, n long")
    return mixing.mix(df, F.col("n")).select("doc_id", "source", "mix.*").collect()


def test_targets_and_taken(spark):
    rng = random.Random(17)
    rows = [(i, rng.choice(["a", "b", "Z", "é", "\U0001F600", None]), rng.randrange(0, 400)) for i in range(3000)]
    rows += [(5000 + i, "hot", rng.randrange(0, 400)) for i in range(2000)] + [(9000, "tiny", 3)]
    got = mixed(spark, rows)
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    right = targets(sizes)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(right[r.source]) and 0 <= r.repeats <= 2
        taken[r.source] = taken.get(r.source, 0) + r.size * r.repeats
    for s, n in taken.items():
        # The cut is the one nearest to the target, so it is off by half a document at most.
        assert abs(n - right[s]) <= max(x for _, t, x in rows if t == s) / 2 + 1e-6
    assert sorted(got, key=str) == sorted(mixed(spark, rows[::-1]), key=str)


def test_corner_cases(spark):
    got = mixed(spark, [(1, "a", 0), (2, "a", 0), (3, None, 10), (3, None, 10), (None, None, 5), (4, "b", 100)])
    assert all(r.repeats == 0 for r in got if r.source == "a") and len(got) == 6
    equal = {r.repeats for r in got if r.doc_id == 3}
    assert len(equal) == 1
    assert mixed(spark, []) == []


def test_rows_are_repeated_with_their_columns(spark):
    df = spark.createDataFrame([(i, "s", 10, "k", 1) for i in range(40)], "doc_id long, source string, size int, _source string, target int")
    out = mixing.mix(df, F.col("size"))
    assert out.columns == [*df.columns, "mix"]
    again = mixing.repeat(out)
    assert again.columns == df.columns and again.count() == 60
