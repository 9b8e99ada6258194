"""Language-aware order, unique slugs, and draws from ranges that are never listed."""

import random

import pytest
from pyspark.sql import functions as F

from rowsmith.operators import clean, lines, sampling


def in_order(spark, texts, order="az", ignore_case=True):
    df = spark.createDataFrame([(0, k, t) for k, t in enumerate(texts)], "doc_id int, line_no int, line string").repartition(3)
    return [r.line for r in lines.rank_lines(df, order, ignore_case).orderBy("place").collect()]


def test_accented_lines_stand_between_their_base_letters(spark):
    texts = ["zebra", "éclair", "Ezra", "ecru", "item10", "item2", "Ångström", "angst", "Anton", "œuvre", "ñandu", "nu", "niño"]
    assert in_order(spark, texts) == ["angst", "Ångström", "Anton", "éclair", "ecru", "Ezra", "item2", "item10", "ñandu", "niño", "nu", "œuvre", "zebra"]
    assert in_order(spark, texts, "za") == in_order(spark, texts)[::-1]


def test_ignoring_case_ignores_accents_and_ties_keep_their_order(spark):
    assert in_order(spark, ["Resume", "résumé", "resume", "résume"]) == ["Resume", "résumé", "resume", "résume"]
    assert in_order(spark, ["Resume", "résumé", "resume", "résume"], "za") == ["résume", "resume", "résumé", "Resume"]
    # With case told apart, so are accents.
    assert in_order(spark, ["Resume", "résumé", "resume", "résume"], ignore_case=False) == ["resume", "Resume", "résume", "résumé"]


def test_equal_lengths_go_by_language(spark):
    assert in_order(spark, ["zoo", "éta", "abc", "x", "eta"], "len-asc") == ["x", "abc", "éta", "eta", "zoo"]


def slugs(spark, titles, bounded=False):
    df = spark.createDataFrame(list(enumerate(titles)), "id int, title string").repartition(3)
    return [r.slug for r in clean.assign_slugs(df, "title", "id", bounded).orderBy("id").collect()]


def free_numbers(titles):
    """Own slugs first, then each copy the least number that is free."""
    base = ["-".join(t.lower().split()) or "untitled" for t in titles]
    used, out = set(base), {}
    for k, b in enumerate(base):
        if b not in base[:k]:
            out[k] = b
    for k, b in enumerate(base):
        if k not in out:
            n = 2
            while f"{b}-{n}" in used:
                n += 1
            used.add(out.setdefault(k, f"{b}-{n}"))
    return [out[k] for k in range(len(base))]


def test_a_copy_does_not_take_another_titles_slug(spark):
    assert slugs(spark, ["a", "a", "a 2"]) == ["a", "a-3", "a-2"]
    assert slugs(spark, ["a 2", "a", "a", "a 2", "a 2 2", "a 02", "a"]) == ["a-2", "a", "a-3", "a-2-3", "a-2-2", "a-02", "a-4"]


@pytest.mark.parametrize("bounded", [True, False])
def test_random_titles_get_different_slugs(spark, bounded):
    rng = random.Random(4)
    titles = [" ".join([rng.choice("ab")] + [str(rng.randrange(1, 6)) for _ in range(rng.randrange(0, 3))]) for _ in range(250)]
    got = slugs(spark, titles, bounded)
    assert len(set(got)) == len(titles) and got == free_numbers(titles)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 49, 64, 1000])
def test_the_permutation_takes_every_number_once(spark, n):
    got = [r.v for r in spark.range(n).select(sampling.permuted(F.col("id"), n, F.lit("s")).alias("v")).collect()]
    assert sorted(got) == list(range(n))


def test_other_salts_give_other_orders(spark):
    rows = spark.range(200).select(*[sampling.permuted(F.col("id"), 200, F.lit(s)).alias(s) for s in "ab"]).collect()
    assert sum(r.a == r.b for r in rows) < 20 and sum(r.a == k for k, r in enumerate(rows)) < 20


def test_a_range_of_a_thousand_billions_is_not_listed(spark):
    df = sampling.sample_range(spark, 10**12, 10**15, 1000, False, "s")
    got = [r.value for r in df.collect()]
    assert len(set(got)) == 1000 and min(got) >= 10**12 and max(got) <= 10**15
    # Spread over the whole range: each tenth gets its share.
    assert all(60 < sum(k * 10**14 <= v < (k + 1) * 10**14 for v in got) < 150 for k in range(10))


def test_every_row_draws_different_numbers(spark):
    rows = sampling.different_per_row(spark.range(300).withColumnRenamed("id", "k"), "k", 6, 1, 49, "s").collect()
    by_row = {}
    for r in rows:
        by_row.setdefault(r.k, []).append(r.value)
    assert all(len(set(v)) == 6 and min(v) >= 1 and max(v) <= 49 for v in by_row.values()) and len(by_row) == 300
    seen = [v for values in by_row.values() for v in values]
    assert all(15 < seen.count(v) < 65 for v in range(1, 50))
    with pytest.raises(ValueError, match="more different numbers"):
        sampling.different_per_row(spark.range(1).withColumnRenamed("id", "k"), "k", 50, 1, 49, "s")
