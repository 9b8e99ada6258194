"""Edges that earlier checks did not look at: patterns, units, working days, far dates, totals of split keys."""

import datetime as dt
import hashlib
import itertools
import time

import pytest
from pyspark.sql import functions as F

from rowsmith import dims
from rowsmith.operators import clean, corpus, dates, lookup, money, ordered, sampling
from rowsmith.functions import text as T


def matches(spark, text, pattern, **how):
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    return [tuple(r)[1:] for r in clean.regex_matches(df, pattern, **how).orderBy("match_no").collect()]


def test_matches_with_back_references_flags_and_names(spark):
    assert matches(spark, "aa bb cd", r"(\w)\1") == [(0, 0, "aa", "a"), (1, 3, "bb", "b")]
    assert matches(spark, "Abc\nabd", "^ab.", flags="im") == [(0, 0, "Abc"), (1, 4, "abd")]
    df = spark.createDataFrame([(1, "k=v")], "doc_id int, text string")
    assert clean.regex_matches(df, r"(?<key>\w)=(\w)").columns[-2:] == ["key", "group_2"]
    assert clean.group_names(r"(a)(?:b)(?<n>c)[(](?=d)\((?<!e)(f)") == [None, "n", None]


def test_matches_of_nothing_and_of_any_character(spark):
    assert matches(spark, "ab", "x*") == [(0, 0, ""), (1, 1, ""), (2, 2, "")]
    assert matches(spark, "xab", "x*") == [(0, 0, "x"), (1, 1, ""), (2, 2, ""), (3, 3, "")]
    assert matches(spark, "", "x*") == [(0, 0, "")] and matches(spark, "abc", "x+") == []
    assert matches(spark, "a \U0001F600a", "a") == [(0, 1, "a"), (1, 5, "a")]


@pytest.mark.parametrize("pattern", ["(a+)+$", "((a|b)+c?)+$", "(a|a)*$", "(a|ab)*", "(.|x)+", "[a", "(?:x*y*)*", "(a{2,}){3,}"])
def test_bad_and_hanging_patterns_are_findings(spark, pattern):
    df = spark.createDataFrame([(1, "aaa")], "doc_id int, text string")
    row = clean.find_replace(df, pattern, "x", regex=True).first()
    assert row.text == "aaa" and row.hits == 0 and row.finding
    with pytest.raises(ValueError):
        clean.regex_matches(df, pattern)


@pytest.mark.parametrize("pattern", [r"(\w+)ing (\w+)", "(a|b)+", "(abc)+", r"\(a+\)+", "[(]+a+", "(a+)?", "(?:foo|bar)*"])
def test_safe_patterns_pass(spark, pattern):
    assert clean.pattern_problem(spark, pattern) is None


def test_plain_needles_match_themselves(spark):
    for needle in ("a.b", r"\Q", r"x\Ey", "[", "$1", "a\\"):
        df = spark.createDataFrame([(1, f"<{needle}> axb")], "doc_id int, text string")
        row = clean.find_replace(df, needle, "$0").first()
        assert (row.hits, row.text, row.finding) == (1, "<$0> axb", None)


def test_units(spark):
    both = spark.createDataFrame([("a", "tsp", 1.0), ("b", "tsp", 2.0), ("a", "ml", 3.0)], "kind string, unit string, size double")
    df = spark.createDataFrame([(1, 6.0, "tsp", "ml"), (2, 6.0, "ml", "ml")], "id int, x double, f string, t string")
    assert sorted((r.id, r.converted) for r in lookup.convert_units(df, "x", "f", "t", both).collect()) == [(1, None), (2, 6.0)]
    disk = spark.createDataFrame([(1.0, "TB", "GiB"), (1.0, "KiB", "B")], "x double, f string, t string")
    got = [r.converted for r in lookup.convert_units(disk, "x", "f", "t", dims.units(spark, dims.STORAGE_UNITS)).orderBy("f").collect()]
    assert got[0] == 1024 and got[1] == pytest.approx(931.3225746)
    acres = spark.createDataFrame([("2.50",), ("2.39",), ("2-20",), ("7",)], "r string").select(lookup.acres_from_record(F.col("r")).alias("a")).collect()
    assert [r.a for r in acres] == [None, 2 + 39 / 40, 2.5, 7.0]


def test_rates_reach_past_the_last_day_and_far_dates_make_no_rows(spark):
    rates = spark.createDataFrame([("2024-01-01", "USD", 1.0), ("2024-03-05", "USD", 2.0), ("2024-01-01", "EUR", 4.0)], "d string, currency string, rate double")
    rates = rates.select(F.to_date("d").alias("rate_date"), "currency", "rate")
    df = spark.createDataFrame([(1, "2024-01-05"), (2, "9999-12-31"), (3, "2023-12-31"), (4, None), (5, "2024-03-04")], "id int, d string")
    df = df.withColumn("x", F.lit(8.0)).withColumn("f", F.lit("USD")).withColumn("t", F.lit("EUR"))
    got = {r.id: (r.converted, r.stale) for r in lookup.convert_asof(df, "d", "x", "f", "t", rates).collect()}
    assert got == {1: (32.0, False), 2: (16.0, True), 3: (None, None), 4: (None, None), 5: (32.0, True)}
    assert lookup.rates_by_month(rates).count() == 6


def walk(day, n, off):
    step = 1 if n > 0 else -1
    while n:
        day += dt.timedelta(days=step)
        if day.weekday() < 5 and day not in off:
            n -= step
    return day


def test_working_days_forward_and_back(spark):
    off = [dt.date(2024, 1, 1), dt.date(2024, 1, 15), dt.date(2024, 1, 16), dt.date(2024, 2, 3), dt.date(2024, 12, 25), dt.date(2026, 1, 1)]
    holidays = spark.createDataFrame([(d,) for d in off], "day date")
    start = dt.date(2023, 12, 20)
    rows = [(i * 100 + n + 50, start + dt.timedelta(days=i), n) for i in range(45) for n in range(-30, 31, 3)] + [(-1, dt.date(2030, 1, 5), 0)]
    df = spark.createDataFrame(rows, "id int, d date, n int")
    got = {r.id: r.shifted for r in dates.add_working_days(df, "d", "n", holidays).collect()}
    assert got == {i: walk(d, n, set(off)) for i, d, n in rows}
    none = holidays.limit(0)
    assert {r.id: r.shifted for r in dates.add_working_days(df, "d", "n", none).collect()} == {i: walk(d, n, set()) for i, d, n in rows}
    assert dates.add_working_days(df.limit(0), "d", "n", holidays).count() == 0
    far = dates.add_working_days(df.where("id = -1").withColumn("n", F.lit(2_000_000)), "d", "n", holidays)
    assert far.select(F.year("shifted").alias("y")).first().y > 9000
    pairs = spark.createDataFrame([(dt.date(2023, 12, 29), dt.date(2024, 1, 17)), (dt.date(2024, 1, 2), dt.date(2024, 1, 1))], "a date, b date")
    assert [r.working_days for r in dates.working_days(pairs, "a", "b", holidays).collect()] == [10, 0]


def test_totals_and_first_values_of_a_split_key(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") < 2500, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"), (F.col("id") % 5).alias("v"))
    how = dict(position="p", first={"f": "id"}, total={"t": "v"}, running={"r": "v"}, previous={"b": "id"})
    split, plain = (ordered.scan(df, ["k"], [F.col("id").desc()], bounded=b, **how) for b in (False, True))
    assert sorted(split.collect()) == sorted(plain.collect())
    with pytest.raises(ValueError):
        ordered.scan(df.withColumn("v", F.col("v") / 2), ["k"], [F.col("id")], total={"t": "v"})


def test_long_deposits_keep_all_years(spark):
    df = spark.createDataFrame([(1, 100.0, 5.0, 60.0)], "id int, principal double, rate double, period double")
    rows = money.simple_interest_schedule(df, "id").orderBy("year").collect()
    assert len(rows) == 60 and rows[-1].balance == pytest.approx(400.0)


def test_long_digit_runs_sort_by_size(spark):
    lines = spark.createDataFrame([("1" * 1200,), ("9" * 999,), ("x10",), ("x9",)], "line string")
    got = [len(r.line) for r in lines.orderBy(T.natural_key("line")).collect()]
    assert got == [999, 1200, 2, 3]


def test_fingerprint_does_not_depend_on_order_and_sees_changes(spark):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(500)], "id int, text string")
    one = lambda d: corpus.set_fingerprint(d, F.col("id"), F.col("text")).first()
    assert one(df) == one(df.orderBy(F.desc("id")).repartition(7)) and one(df).texts == 500
    assert one(df).fingerprint != one(df.withColumn("text", F.when(F.col("id") == 77, "x").otherwise(F.col("text")))).fingerprint


def test_drawn_rows_have_the_smallest_tickets(spark):
    got = [r.id for r in sampling.draw(spark.range(10, 5001), "id", "s", 40).collect()]
    ranked = sorted(range(10, 5001), key=lambda v: (hashlib.sha256(f"s:{v}".encode()).hexdigest(), v))
    assert got == ranked[:40]


def test_sampled_numbers_are_images_of_their_places(spark):
    def image(x, n, salt):
        bits = max(2, (n - 1).bit_length())
        right = bits // 2
        while True:
            left, low = x >> right, x & ((1 << right) - 1)
            for round_no in range(4):
                hashed = int(hashlib.sha256(f"{salt}:{round_no}:{low}".encode()).hexdigest()[:12], 16)
                left, low = low, left ^ (hashed & ((1 << (bits - right if round_no % 2 == 0 else right)) - 1))
            x = left << right | low
            if x < n:
                return x

    got = [r.value for r in sampling.sample_range(spark, 10, 5000, 40, False, "s").orderBy("draw_no").collect()]
    assert got == [10 + image(k, 4991, "s") for k in range(40)]
    assert sampling.sample_range(spark, 1, 5, 5, False, "s").count() == 5


def test_long_digests_equal_the_published_vectors(spark):
    df = spark.createDataFrame([("abc",)], "text string")
    row = df.select(clean.digest(F.col("text"), "SHA-384").alias("a"), clean.digest(F.col("text"), "SHA-512").alias("b")).first()
    assert row.a == "cb00753f45a35e8bb5a03d699ac65007272c32ab0eded1631a8b605a43ff5bed8086072ba1e7cc2358baeca134c825a7"
    assert row.b.startswith("ddaf35a193617abacc417349ae20413112e6fa4e89a97ea20a9eeee64b55d39a2192992a274fc1a836ba3c23a3feebbd")


def test_running_sums_of_any_length(spark):
    lists = [[7 * k % 11 for k in range(n)] for n in (0, 1, 15, 16, 17, 32, 33, 256, 257, 3000)]
    df = spark.createDataFrame([(numbers,) for numbers in [*lists, None]], "a array<bigint>")
    got = [r.b for r in df.select(T.running_sums(F.col("a")).alias("b")).collect()]
    assert got == [*[list(itertools.accumulate(numbers)) for numbers in lists], None]


def test_a_text_of_many_matches_takes_no_square_of_them(spark):
    # With one copy of the list per match this takes minutes.
    df = spark.createDataFrame([(1, "ab " * 150_000)], "doc_id int, text string")
    began = time.monotonic()
    row = clean.regex_matches(df, " ").agg(F.count(F.lit(1)).alias("n"), F.max("start").alias("last"), F.sum("start").alias("all")).first()
    assert tuple(row) == (150_000, 449_999, sum(range(2, 450_000, 3))) and time.monotonic() - began < 20
