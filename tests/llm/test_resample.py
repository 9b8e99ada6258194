"""Importance resampling: against plain Python, the cutoff against a sort, and corner cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowsmith.llm import resample


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def features(text, max_n=1):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, max_n=1, buckets=10_000, share=10, min_words=20, seed=2024):
    place = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(place(f) for _, t in docs for f in features(t, max_n))
    t = Counter(place(f) for x in target for f in features(x, max_n))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((float(t[b] + 1) * float(total_s + buckets)) / (float(s[b] + 1) * float(total_t + buckets)))) for b in range(buckets)]
    out = []
    for d, text in docs:
        own = features(text, max_n)
        weight = sum(gain[place(f)] for f in own)
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    able = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, r in enumerate(able[: len(able) * share // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def corpus():
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(300)] + ["Été", "ÉTÉ", "naïve", "X-Ray", "don't", "日本"]
    docs = [(k, " ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 80)))) for k in range(500)]
    docs += [(900, None), (901, ""), (902, "-- !!"), (None, "lone words " * 15), (903, "w1 " * 60_000), (904, "w2 w3 " * 10), (904, "w2 w3 " * 10)]
    return docs, [" ".join(rng.choice(vocab[:40]) for _ in range(30)) for _ in range(50)] + [None, ""]


def got(spark, docs, target, **how):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    return sorted((tuple(r) for r in resample.resample(df, wanted, **how).select("doc_id", "draw.*").collect()), key=repr)


@pytest.mark.parametrize("how", [{}, {"max_n": 2, "share": 50, "seed": 3}, {"buckets": 64, "min_words": 1, "share": 100}, {"share": 0}])
def test_against_plain_python(spark, how):
    docs, target = corpus()
    assert got(spark, docs, target, **how) == brute(docs, target, **how)


def test_empty_tables(spark):
    docs, _ = corpus()
    assert got(spark, docs[:50], []) == brute(docs[:50], [])
    assert got(spark, [], ["a b"]) == []


def test_rows_that_repeat_the_cutoff(spark):
    docs = [(1, "same words here " * 10)] * 40
    rows = got(spark, docs, ["same"])
    assert sorted(r[4] for r in rows if r[4]) == [1, 2, 3, 4]


def test_cutoff_is_the_key_of_a_sort(spark):
    rng = random.Random(1)
    # Sorted input: every partition has keys of its own range, the worst case for medians of partitions.
    keys = sorted((rng.randrange(50), rng.randrange(10**6)) for _ in range(3000))
    df = spark.createDataFrame(keys, "score long, id long").repartitionByRange(7, "score")
    ordered = sorted(keys, key=lambda k: (-k[0], k[1]))
    for wanted in (1, 2, 299, 1500, 2999, 3000):
        assert resample.cutoff(df, wanted) == ordered[wanted - 1]
    assert resample.cutoff(df, 0) is None


def test_weighted_median_leaves_a_quarter_on_either_side():
    rng = random.Random(2)
    for _ in range(50):
        parts = [sorted(((rng.randrange(30), rng.randrange(100)) for _ in range(rng.randrange(1, 40))), key=lambda k: (-k[0], k[1])) for _ in range(9)]
        pivot = resample.weighted_median([(*p[len(p) // 2], len(p)) for p in parts])
        every = [k for p in parts for k in p]
        above = sum((-k[0], k[1]) < (-pivot[0], pivot[1]) for k in every)
        below = sum((-k[0], k[1]) > (-pivot[0], pivot[1]) for k in every)
        assert above <= 0.75 * len(every) + 9 and below <= 0.75 * len(every) + 9


def test_kept_columns_and_clashes(spark):
    df = spark.createDataFrame([(1, "a b", 7, "x")], "doc_id long, text string, score long, _row string")
    made = resample.resample(df, df, keep=("doc_id", "score", "_row", "text"))
    assert made.columns == ["doc_id", "score", "_row", "text", "draw"] and made.first().score == 7
    with pytest.raises(ValueError, match="already has a column"):
        resample.resample(df, df, keep=("doc_id", "score"), into="score")


def test_scores_of_the_noise(spark):
    noise = spark.range(2000).select(resample.noisy(F.lit(0), F.col("id"), 2024).alias("s"))
    # A Gumbel variable has mean 0.577 and deviation 1.283.
    mean, dev = noise.agg(F.avg("s"), F.stddev("s")).first()
    assert abs(mean - 577) < 120 and abs(dev - 1283) < 120
