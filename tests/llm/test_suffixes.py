"""Shared passages against a brute-force search, and corner cases."""

import random
import re

import numpy as np

from rowsmith.llm import suffixes


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def maximal(a, b, least):
    """(start_a, start_b, n) of every maximal common run of at least ``least`` words."""
    out, places = set(), {}
    for j in range(len(b) - least + 1):
        places.setdefault(tuple(b[j : j + least]), []).append(j)
    for i in range(len(a) - least + 1):
        for j in places.get(tuple(a[i : i + least]), ()):
            if i and j and a[i - 1] == b[j - 1]:
                continue
            n = least
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            out.add((i, j, n))
    return out


def corpus(rng, n=60):
    vocab = [f"w{i}" for i in range(3000)]
    made = lambda k: [rng.choice(vocab) for _ in range(k)]
    common, rows = [made(55), made(50), made(120), made(49)], []
    for d in range(n):
        text = made(rng.randrange(20, 150))
        for p in rng.sample(common, rng.randrange(0, 3)):
            text += p + made(rng.randrange(0, 30))
        rows.append((d, " ".join(text)))
    rows += [(100 + k, rows[k][1]) for k in range(5)]
    return rows


def test_every_shared_passage_is_met_and_right(spark):
    rows = corpus(random.Random(2))
    texts = {d: words(t) for d, t in rows}
    found = [tuple(r) for r in suffixes.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    ids = sorted(texts)
    every = {(a, b): maximal(texts[a], texts[b], 50) for a in ids for b in ids if a > b}
    for doc, start, end, other, other_start, n in found:
        # A reported run is part of a maximal one: beyond CONTEXT words its other suffixes may have met other documents.
        assert end - start == n >= 50
        assert any(start - other_start == i - j and i <= start and end <= i + m for i, j, m in every[doc, other])
    # Each word that stands in some shared passage lies in a reported one.
    truth, mine = {d: set() for d in ids}, {d: set() for d in ids}
    for (a, b), runs in every.items():
        for i, j, n in runs:
            truth[a] |= set(range(i, i + n))
            truth[b] |= set(range(j, j + n))
    for doc, start, end, other, other_start, n in found:
        mine[doc] |= set(range(start, end))
        mine[other] |= set(range(other_start, other_start + n))
    assert mine == truth


def test_passages_whose_halves_are_frequent_are_met(spark):
    rng = random.Random(4)
    made = lambda k: [f"w{rng.randrange(10**6)}" for _ in range(k)]
    rows, pairs, d = [], [], 0
    for g in range(12):
        x, y, z = made(20), made(20), made(20)
        for _ in range(20):
            rows += [(d, " ".join(made(20) + y + z + made(20))), (d + 1, " ".join(made(20) + x + y + made(20)))]
            d += 2
        pairs.append((10_000 + g, 20_000 + g))
        rows += [(k, " ".join(made(20) + x + y + z + made(20))) for k in pairs[-1]]
    found = suffixes.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.other_id, r.doc_id, r.start_word, r.end_word, r.other_start) for r in found) == [(a, b, 20, 80, 20) for a, b in pairs]


def test_stretch_hashes_tell_stretches_apart():
    x = np.random.default_rng(2).integers(0, 5, 3000)
    for width in (1, 7, 50):
        names = suffixes.stretch_hashes(x, width).tolist()
        stretches = [tuple(x[k : k + width]) for k in range(len(x) - width + 1)]
        assert len(names) == len(stretches) and len(set(zip(names, stretches))) == len(set(names)) == len(set(stretches))


def test_minimisers_are_chosen_by_content():
    rng = np.random.default_rng(1)
    x = rng.integers(-(2**63), 2**63 - 1, 400)
    brute = sorted({int(i + np.argmin(x[i : i + 43])) for i in range(len(x) - 42)})
    assert suffixes.minimisers(x, 43).tolist() == brute
    assert suffixes.minimisers(x[:42], 43).tolist() == []


def test_corner_cases(spark):
    long = " ".join(f"v{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, "a b c"), (4, long), (4, long), (None, "x " + long.upper() + "."), (5, "r " * 500), (6, "r " * 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as seed", "text as words", "2 as start")
    got = sorted((tuple(r) for r in suffixes.passages(df).collect()), key=str)
    assert (4, 0, 60, None, 1, 60) in got and all(r[0] in (4, 6) for r in got)
    # A text of one word over and over matches on many diagonals; together they cover it.
    assert {w for r in got if r[0] == 6 for w in range(r[1], r[2])} == set(range(400))
    assert suffixes.passages(df.where("doc_id = 99")).count() == 0


def reported(spark, rows):
    found = suffixes.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return sorted((tuple(r) for r in found), key=str)


def test_rows_without_an_id_and_rows_that_share_one(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(None, "a b " + passage), (None, passage + " c"), (None, "nothing of it")]
    assert [(r[0], r[3], r[5]) for r in reported(spark, rows)] == [(None, None, 60)]
    rows = [(7, "a b " + passage), (7, passage + " c"), (7, passage + " c"), (8, "z " * 20)]
    assert [(r[0], r[3], r[5]) for r in reported(spark, rows)] == [(7, 7, 60)]
    rows = [(2, "a b " + passage), (5, passage + " c"), (3, "x " + passage)]
    assert {(r[0], r[3]) for r in reported(spark, rows)} >= {(5, 2)} and all(r[0] > r[3] for r in reported(spark, rows))


def test_a_passage_longer_than_the_context_is_whole(spark):
    passage = " ".join(f"p{i}" for i in range(400))
    assert reported(spark, [(1, "a b " + passage + " c"), (2, passage + " d e")]) == [(2, 0, 400, 1, 2, 400)]
    # Three documents, one of which has the first half only: the halves name different partners, together they cover it.
    half = " ".join(f"p{i}" for i in range(200))
    found = reported(spark, [(1, "a " + half + " b"), (2, "c " + passage), (3, "d " + passage)])
    assert {w for r in found if r[0] == 3 for w in range(r[1], r[2])} == set(range(1, 401))


def test_few_places_of_a_repeated_word_are_kept():
    seeds = np.zeros(5000, np.int64)
    at = suffixes.minimisers(seeds, 43)
    kept = suffixes.thinned(at, seeds[at], 43)
    assert len(at) == 5000 and len(kept) <= 5000 / 10 + 2 and kept[0] == 0 and kept[-1] == 4999


def test_a_window_with_a_kept_place_keeps_one():
    rng = np.random.default_rng(5)
    for period in (1, 2, 3, 7, 15, 25, 60):
        loop = rng.integers(-(2**63), 2**63 - 1, period)
        seeds = np.concatenate([rng.integers(-(2**63), 2**63 - 1, 70), np.resize(loop, 400), rng.integers(-(2**63), 2**63 - 1, 70)])
        at = suffixes.minimisers(seeds, 43)
        kept = set(suffixes.thinned(at, seeds[at], 43).tolist())
        for i in range(len(seeds) - 42):
            assert kept & set(range(i, i + 43)), (period, i)


def test_empty_and_clashing(spark):
    df = spark.createDataFrame([], "doc_id long, text string, doc string, seed int, key int")
    assert suffixes.passages(df).count() == 0


def test_each_document_but_the_first_of_a_passage_has_a_row(spark):
    rng = random.Random(12)
    made = lambda k: [f"w{rng.randrange(10**6)}" for _ in range(k)]
    passages = [made(52) for _ in range(4)]
    rows = [(100 * g + k, " ".join(made(30) + passage + made(30))) for g, passage in enumerate(passages) for k in range(25)]
    assert {r[0] for r in reported(spark, rows)} == {d for d, _ in rows if d % 100}
    assert {r[3] for r in reported(spark, rows)} >= {0, 100, 200, 300}
