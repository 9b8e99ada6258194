"""N-gram Jaccard join against all pairs, and its corner cases."""

import random
import re

import pytest

from rowsmith.llm import ngramjoin


def grams(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows, threshold=0.8):
    """{doc_id: (class, copies, links)} by comparing every pair of different texts."""
    texts = sorted({t or "" for _, t in rows})
    sets = [grams(t) for t in texts]
    root, links = list(range(len(texts))), [0] * len(texts)

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    holders = {}
    for k, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(k)
    for i, s in enumerate(sets):
        near = {j for g in s for j in holders[g] if j > i}
        for j in near:
            if len(s & sets[j]) >= threshold * len(s | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                root[find(j)] = find(i)
    place = {t: k for k, t in enumerate(texts)}
    first, copies = {}, {}
    for d, t in rows:
        k = place[t or ""]
        top = find(k)
        first[top] = min(first.get(top, d), d)
        copies[k] = copies.get(k, 0) + 1
    return sorted((d, first[find(place[t or ""])], copies[place[t or ""]], links[place[t or ""]]) for d, t in rows)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def result(spark, rows, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(tuple(r) for r in ngramjoin.join(df, **how).collect())


def test_band_plan_reaches_the_recall():
    bands, rows = ngramjoin.band_plan(0.8, 0.999, 256)
    assert bands * rows <= 256 and 1 - (1 - 0.8**rows) ** bands >= 0.999
    wider = 1 - (1 - 0.8 ** (rows + 1)) ** (256 // (rows + 1))
    assert wider < 0.999


@pytest.mark.parametrize("block_grams", [1_500_000, 4_000])
def test_against_all_pairs(spark, block_grams):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(2000)]
    rows = []
    hot = [rng.choice(vocab) for _ in range(150)]
    rows += [(i, edited(rng, hot, rng.randrange(0, 9))) for i in range(120)]
    rows += [(1000 + i, " ".join(hot)) for i in range(30)]
    for g in range(15):
        base = [rng.choice(vocab) for _ in range(rng.randrange(40, 300))]
        rows += [(2000 + 10 * g + k, edited(rng, base, rng.randrange(0, 4))) for k in range(4)]
    rows += [(3000 + i, " ".join(rng.choice(vocab) for _ in range(80))) for i in range(40)]
    rng.shuffle(rows)
    mine, right = result(spark, rows, block_grams=block_grams), brute(rows)
    # Classes are right as a whole; a link exactly at the threshold is found with the stated recall.
    assert [r[:3] for r in mine] == [r[:3] for r in right]
    assert sum(r[3] for r in mine) >= 0.999 * sum(r[3] for r in right)
    assert all(a[3] <= b[3] for a, b in zip(mine, right))


@pytest.mark.parametrize("texts", [2, 3])
def test_texts_longer_than_a_block_are_linked_once(spark, texts):
    rng = random.Random(8)
    # Many groups of few texts: some have all their members in one block.
    rows = []
    for g in range(12):
        base = [f"g{g}w{rng.randrange(3000)}" for _ in range(200)]
        rows += [(10 * g + k, edited(rng, base, k)) for k in range(texts)]
    for block_grams in (40, 150, 250):
        assert result(spark, rows, block_grams=block_grams) == brute(rows)


def test_the_table_against_all_pairs(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    assert sorted(tuple(r) for r in ngramjoin.join(df).collect()) == brute(rows)


def test_corner_cases(spark):
    rows = [(1, None), (2, ""), (3, "one two"), (4, "one two"), (5, "Two one"), (6, "a b c d e"), (6, "a b c d e"), (None, "A, b c d e!"), (7, "q " * 30_000)]
    got = [tuple(r) for r in ngramjoin.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, 1, 2, 0), (2, 1, 2, 0), (3, 3, 2, 0), (4, 3, 2, 0), (5, 5, 1, 0), (6, 6, 2, 1), (6, 6, 2, 1), (None, 6, 1, 1), (7, 7, 1, 0)], key=str
    )
    assert result(spark, []) == []


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b c d e", "x", 3), (2, "a b c d e f", "y", 4)], "doc_id long, text string, h string, node int")
    assert ngramjoin.join(df).columns == ["doc_id", "class_id", "n_copies", "n_links"]
    assert ngramjoin.join(df).count() == 2


def test_one_row_of_each_class_stays(spark):
    near = " ".join(f"a{i}" for i in range(80))
    rows = [(3, near), (1, near + " more"), (2, near), (2, near), (5, "x y z"), (5, "x y z"), (5, "other"), (None, near), (None, "lone"), (None, "lone")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "doc_id * 2 as h", "text as grams")
    kept = ngramjoin.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, near + " more"), (5, "x y z"), (5, "other"), (None, "lone")], key=str)
