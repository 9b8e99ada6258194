"""Chosen-path near-dedup against all pairs, large groups, and corner cases."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowsmith.llm import chosenpath


def shingles(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if 0 < len(words) < 4:
        return {tuple(words)}
    return {tuple(words[i : i + 4]) for i in range(len(words) - 3)}


def brute(rows):
    """(doc_id, n_shingles, component_id, kept) by comparing every pair."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    holders = {}
    for k, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(k)
    for i, s in enumerate(sets):
        for j in {j for g in s for j in holders[g] if j > i}:
            shared = len(s & sets[j])
            if 100 * shared >= 80 * (len(s) + len(sets[j]) - shared):
                root[find(j)] = find(i)
    least = {}
    for k, (d, _) in enumerate(rows):
        if d is not None:
            least[find(k)] = min(least.get(find(k), d), d)
    out = []
    for k, (d, _) in enumerate(rows):
        component = least.get(find(k)) if sets[k] else d
        out.append((d, len(sets[k]), component, d == component))
    return sorted(out, key=repr)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed=5, hot=150):
    """A large group of near copies, families in chains, passages that unlike texts share, and loners."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(2000)]
    draw = lambda n: [rng.choice(vocab) for _ in range(n)]
    base = draw(150)
    rows = [(i, edited(rng, base, rng.randrange(0, 9))) for i in range(hot)]
    rows += [(1000 + i, " ".join(base)) for i in range(30)]
    for g in range(25):
        own = draw(rng.randrange(20, 300))
        for k in range(5):
            own = edited(rng, own, rng.randrange(0, 4)).split(" ")
            rows.append((2000 + 10 * g + k, " ".join(own)))
    passage = draw(60)
    rows += [(4000 + i, " ".join(draw(rng.randrange(5, 60)) + passage + draw(rng.randrange(5, 60)))) for i in range(150)]
    rows += [(6000 + i, " ".join(draw(80))) for i in range(60)]
    rng.shuffle(rows)
    return rows


def result(spark, rows, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return sorted((tuple(r) for r in chosenpath.components(df, **how).collect()), key=repr)


@pytest.mark.parametrize("block_grams", [1_500_000, 6_000])
def test_against_all_pairs(spark, block_grams):
    rows = corpus()
    assert result(spark, rows, block_grams=block_grams) == brute(rows)


def test_corner_cases(spark):
    long = " ".join(f"t{i}" for i in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one\ttwo"), (6, "two one"), (7, "one two three four"), (8, "ONE two  three four"),
        (9, "É a b c"), (10, "é a b c"), (11, "z " * 5_000), (12, "z " * 9_000), (13, long), (14, long + " end"), (15, long[:100_000]),
        (20, "a b c d e f g h"), (20, "q r s t u v w x"), (21, "a b c d e f g h"), (22, "Q R S T U V W X"),
        (None, "lonely text without any id"), (None, "lonely text without any id"), (None, "a b c d e f g h"), (None, None),
    ]
    assert result(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert result(spark, []) == []


def test_one_column_more_does_not_matter(spark):
    df = spark.createDataFrame([(1, "a b c d e", 4, "x"), (2, "a b c d e", 5, "y")], "doc_id long, text string, node long, h string")
    made = chosenpath.components(df)
    assert made.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(tuple(r) for r in made.collect()) == [(1, 2, 1, True), (2, 2, 1, False)]


def test_trees_reach_the_recall():
    at = chosenpath.meeting(0.8)
    assert abs(1 - at - (1 - 0.8 * at) ** 2) < 1e-9
    trees = chosenpath.trees_for(0.8, 0.9999)
    assert (1 - at) ** trees <= 1e-4 < (1 - at) ** (trees - 1)


def test_pairs_at_the_threshold_meet_in_the_trees(spark):
    # Sets of 180 shingles of which 160 are common: 160 / 200 = 0.8 exactly.
    rng = random.Random(4)
    rows = []
    for g in range(300):
        common = [f"c{g}x{i}" for i in range(163)]
        for k in range(2):
            rows.append((2 * g + k, " ".join(common + [f"o{g}y{k}z{i}" for i in range(20)])))
    got = result(spark, rows)
    assert sum(r[2] == r[0] - r[0] % 2 for r in got) >= 0.999 * len(got)


def test_a_group_of_near_copies_costs_a_pass_not_its_square(spark):
    rng = random.Random(6)
    base = [f"w{i}" for i in range(100)]
    rows = [(i, edited(rng, base, 1)) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    signed = chosenpath.records(df, 4, "doc_id", "text")
    nodes = signed.withColumnRenamed("doc", "node").withColumn("first", F.col("node")).withColumn("label", F.col("node"))
    nodes = nodes.select("h", "first", "grams", "sig", "node", "label")
    nodes = chosenpath.materialise(nodes, "nodes")
    met = chosenpath.materialise(chosenpath.nodes_to_compare(nodes, [0], "t"), "met")
    units = chosenpath.units_of(met, True, 20_000)
    members, blocks = met.count(), met.where("size > 20000").select("group", F.ceil(F.col("size") / 20_000).alias("b")).distinct().agg(F.sum("b")).first()[0]
    assert units.count() <= members + blocks
    one = nodes.withColumn("label", F.lit(0).cast("long"))
    assert chosenpath.nodes_to_compare(one, [1, 2, 3], "u").count() == 0


def test_unit_links_components_once():
    a, b, c = np.arange(10), np.arange(1, 11), np.arange(100, 110)
    found = chosenpath.verify_unit(np.array([3, 5, 9, 11]), np.array([3, 5, 9, 3]), np.zeros(4, int), [a, b, c, a + 0], False, 80)
    assert found == [(3, 5)]
    assert chosenpath.verify_unit(np.array([3, 5]), np.array([3, 5]), np.array([1, 1]), [a, b], True, 80) == []
