"""Ordered diffs: applying the hunks gives the new text, scripts are short, moves are found."""

import random

import pytest
from pyspark.sql import functions as F

from rowsmith.operators import diffs


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


def applied(old, found, new):
    out, at = [], 0
    for start, count, new_start, new_count in found:
        out += old[at:start] + new[new_start : new_start + new_count]
        at = start + count
    return out + old[at:]


def test_random_texts_of_few_lines():
    rng = random.Random(1)
    for _ in range(600):
        old = [rng.choice("abcdef") for _ in range(rng.randrange(0, 14))]
        new = [rng.choice("abcdef") for _ in range(rng.randrange(0, 14))]
        found = diffs.matches(old, new)
        assert all(old[i] == new[j] for i, j in found)
        assert all(i < k and j < l for (i, j), (k, l) in zip(found, found[1:]))
        assert applied(old, diffs.hunks_of(old, new), new) == new


def test_without_anchors_the_script_is_a_shortest_one():
    rng = random.Random(2)
    for _ in range(600):
        # Every line at least twice, so no line is an anchor and nothing is trimmed at the ends.
        old = ["<"] + [rng.choice("xy") for _ in range(rng.randrange(2, 20))] + ["u"]
        new = ["v"] + [rng.choice("xy") for _ in range(rng.randrange(2, 20))] + [">"]
        assert len(list(diffs._shortest(old, new))) == longest_common(old, new)


def test_long_texts_beyond_the_steps(monkeypatch):
    monkeypatch.setattr(diffs, "STEPS", 12)
    rng = random.Random(3)
    for _ in range(60):
        old = [rng.choice("xyz") for _ in range(150)]
        new = [rng.choice("xyz") for _ in range(130)]
        found = list(diffs._shortest(old, new))
        assert all(old[i] == new[j] for i, j in found) and all(i < k and j < l for (i, j), (k, l) in zip(found, found[1:]))
        assert applied(old, diffs.hunks_of(old, new), new) == new


def test_anchors_keep_functions_together():
    old = ["void a() {", "  x", "}", "", "void c() {", "  z", "}"]
    new = ["void a() {", "  x", "}", "", "void b() {", "  y", "}", "", "void c() {", "  z", "}"]
    assert diffs.hunks_of(old, new) == [(4, 0, 4, 4)]


def test_a_hundred_thousand_lines():
    old = [f"line {k}" for k in range(100_000)]
    new = old[:50_000] + ["new"] + old[50_001:] + old[:10]
    assert diffs.hunks_of(old, new) == [(50_000, 1, 50_000, 1), (100_000, 0, 100_000, 10)]
    assert diffs.hunks_of(["same"] * 30_000, ["same"] * 20_000) == [(20_000, 10_000, 20_000, 0)]


def frames(spark, pairs):
    old = [(k, a) for k, (a, _) in enumerate(pairs) if a != "-"]
    new = [(k, b) for k, (_, b) in enumerate(pairs) if b != "-"]
    return spark.createDataFrame(old, "id int, text string"), spark.createDataFrame(new, "id int, text string")


def test_patching_gives_the_new_text(spark):
    rng = random.Random(6)
    text = lambda: "\n".join(rng.choice(["a", "b", "", "longer line", "é"]) for _ in range(rng.randrange(0, 12)))
    pairs = [(text(), text()) for _ in range(150)] + [("", "x"), ("x\ny", ""), (None, "n"), ("gone", None), ("-", "only new\ntwo"), ("only old", "-"), ("a\r\nb", "a\nb")]
    old, new = frames(spark, pairs)
    found = diffs.hunks(old, new, ("id",))
    got = {r.id: r.text for r in diffs.patch(old, found, ("id",)).collect()}
    unify = lambda t: (t or "").replace("\r\n", "\n")
    # One empty line and no line at all are both the empty text.
    assert got == {k: "" if b in (None, "-") else unify(b) for k, (_, b) in enumerate(pairs)}


def test_moves(spark):
    old, new = frames(spark, [("one\ntwo\nthree\nfour\nfive", "two\nthree\nfour\nfive\none"), ("a\na\nb", "b\nc")])
    found = diffs.hunks(old, new, ("id",))
    assert [tuple(r) for r in diffs.moves(found, ("id",)).collect()] == [(0, "one", 0, 4)]
    assert [(r.old_start, r.old_count, r.new_start, r.new_count) for r in found.where("id = 0").orderBy("hunk_no").collect()] == [(0, 1, 0, 0), (5, 0, 4, 1)]


def test_empty_table(spark):
    old, new = frames(spark, [("a", "b")])
    assert diffs.hunks(old.limit(0), new.limit(0), ("id",)).count() == 0
    assert diffs.hunks(old, old, ("id",)).count() == 0


@pytest.mark.parametrize("keys", [("id", "part")])
def test_two_keys(spark, keys):
    old, new = (df.withColumn("part", F.lit("p")) for df in frames(spark, [("a\nb", "b\nc")]))
    found = diffs.hunks(old, new, keys)
    assert found.columns[:2] == ["id", "part"] and diffs.patch(old, found, keys).first().text == "b\nc"
