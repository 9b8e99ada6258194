import datetime as dt

import pytest
from pyspark.sql import functions as F

from rowsmith.functions import calendar as C
from rowsmith.operators import audit, dates, lines, lookup, sampling, sets, tags


def pairs(spark, *rows):
    return spark.createDataFrame([(i, dt.date.fromisoformat(a), dt.date.fromisoformat(b)) for i, (a, b) in enumerate(rows)], "id int, a date, b date")


def test_month_ends(spark):
    rows = dates.exact_age(pairs(spark, ("2024-01-31", "2024-03-01"), ("2023-01-31", "2023-02-28"), ("2024-02-29", "2025-02-28"), ("2024-05-02", "2024-05-01")), "a", "b").orderBy("id").collect()
    assert (rows[0].years, rows[0].months, rows[0].days) == (0, 1, 1)
    assert (rows[1].years, rows[1].months, rows[1].days) == (0, 1, 0)
    assert (rows[2].years, rows[2].months, rows[2].days, rows[2].days_to_birthday) == (1, 0, 0, 0)
    assert rows[3].finding and rows[3].years is None
    march = dates.exact_age(pairs(spark, ("2024-02-29", "2025-02-28")), "a", "b", leap_day_to_march=True).first()
    assert march.days_to_birthday == 1


def test_weekdays_against_a_walk(spark):
    start = dt.date(2024, 2, 26)
    rows = [(str(start + dt.timedelta(days=i)), str(start + dt.timedelta(days=i + n))) for i in range(7) for n in range(-3, 30)]
    got = pairs(spark, *rows).select("a", "b", C.weekdays_between(F.col("a"), F.col("b")).alias("n")).collect()
    for r in got:
        walk = sum((r.a + dt.timedelta(days=k)).weekday() < 5 for k in range(1, (r.b - r.a).days + 1))
        assert r.n == walk, r


def test_working_days_there_and_back(spark):
    off = spark.createDataFrame([(dt.date(2024, 1, 3),)], "day date")
    df = pairs(spark, ("2024-01-01", "2024-01-08"))
    assert dates.working_days(df, "a", "b", off).first().working_days == 4
    shifted = dates.add_working_days(df.withColumn("n", F.lit(4)), "a", "n", off).first().shifted
    assert shifted == dt.date(2024, 1, 8)


def test_strict_dates(spark):
    df = spark.createDataFrame([("2024-02-30",), ("2024-2-3",), ("2024-02-29",)], "t string")
    assert [r.d for r in df.select(C.strict_date(F.col("t")).alias("d")).collect()] == [None, None, dt.date(2024, 2, 29)]


def test_epoch(spark):
    df = spark.createDataFrame([(1_700_000_000,), (1_700_000_000_000,)], "x bigint")
    assert {r.s for r in df.select(C.to_epoch_seconds(C.from_epoch(F.col("x"))).alias("s")).collect()} == {1_700_000_000}


def test_asof_before_first_rate_and_stale(spark):
    rates = spark.createDataFrame(
        [(c, dt.date(2024, 1, d), r) for d, r in ((5, 2.0), (20, 4.0)) for c in ("USD",)] + [("EUR", dt.date(2024, 1, 1), 1.0)],
        "currency string, rate_date date, rate double",
    )
    rows = [(i, dt.date(2024, 1, d), 10.0, "EUR", "USD") for i, d in enumerate((4, 5, 12, 20, 31))]
    df = spark.createDataFrame(rows, "id int, d date, amount double, f string, t string")
    got = lookup.convert_asof(df, "d", "amount", "f", "t", rates).orderBy("id").collect()
    assert [r.converted for r in got] == [None, 20.0, 20.0, 40.0, 40.0]
    fresh = lookup.convert_asof(df, "d", "amount", "t", "t", rates).orderBy("id").collect()
    assert [r.stale for r in fresh] == [None, False, True, False, True]


def test_converting_there_and_back(spark):
    from rowsmith import dims

    rates = dims.rates(spark)
    df = spark.createDataFrame([(100.0, "INR", "JPY")], "amount double, f string, t string")
    there = lookup.convert_currency(df, "amount", "f", "t", rates).withColumnRenamed("converted", "c2")
    back = lookup.convert_currency(there.drop("amount"), "c2", "t", "f", rates).first()
    assert back.converted == pytest.approx(100, rel=1e-9)


def test_sets(spark):
    mk = lambda *xs: spark.createDataFrame([(x,) for x in xs], "x int")
    a, b = mk(1, 2, 2, 3), mk(3, 4)
    assert sorted(map(tuple, sets.symmetric_difference(a, b).collect())) == [(1, "a"), (2, "a"), (4, "b")]
    assert sorted(map(tuple, sets.symmetric_difference(b, a).collect())) == [(1, "b"), (2, "b"), (4, "a")]
    assert [r.x for r in sets.missing(mk(3), b).collect()] == [] and sets.missing(a, b).count() == 2
    assert sorted(map(tuple, lookup.orphans(a, b, "x").collect())) == [(1, "a"), (2, "a"), (4, "b")]


def test_ordered_lists(spark):
    mk = lambda *xs: spark.createDataFrame([(k, n, i) for i, (k, n) in enumerate(xs)], "k string, n string, p int")
    a = mk(("x", "X"), ("y", "Y"), ("z", "Z"))
    assert sets.compare_ordered(a, a, "k", "n", "p").isEmpty()
    got = dict(map(tuple, sets.compare_ordered(a, mk(("x", "X"), ("z", "q"), ("w", "W")), "k", "n", "p").collect()))
    assert got == {"y": "missing", "w": "extra", "z": "other name"}
    assert dict(map(tuple, sets.compare_ordered(a, mk(("y", "Y"), ("x", "X"), ("z", "Z")), "k", "n", "p").collect())) == {"x": "wrong place", "y": "wrong place"}


def test_verdict(spark):
    pages = spark.createDataFrame([(1, "<title>ok</title><h1>a</h1>"), (2, "none")], "page_id int, html string")
    good, bad = audit.audit(pages.where("page_id = 1"), [audit.heading_rule]), audit.audit(pages, [audit.heading_rule, audit.title_rule()])
    assert sets.passed(good) and not sets.passed(good, bad)
    assert {(r.rule, r.n) for r in sets.verdict(good, bad).collect()} == {("h1", 1), ("title", 1)}


def test_markers(spark):
    kinds = [("S", "a"), ("S", "b c"), ("E", "b"), ("E", "x"), ("E", "a"), ("S", "end")]
    df = spark.createDataFrame([(1, i, "START" if k == "S" else "END", n) for i, (k, n) in enumerate(kinds)], "f int, i int, kind string, label string")
    got = {(r.i, r.finding) for r in lines.marker_audit(df, "f", "i", "kind", "label").collect()}
    assert got == {(3, "crosses"), (4, "closes nothing"), (5, "never closed")}


def test_links(spark):
    pages = spark.createDataFrame(
        [(1, "http://h.org/a/b.html", '<a href="c.html"><a href="../d.html?v=1"><a href="/a/./b.html"><a href="#x"><a href="http://o.org/">'),
         (2, "http://h.org/a/c.html?x#y", "")], "page_id int, url string, html string")
    assert [r.href for r in audit.dead_links(pages).collect()] == ["../d.html"]
    assert [r.host for r in audit.external_hosts(pages).collect()] == ["o.org"]


def test_unlabelled(spark):
    html = '<label for="a">A</label><input id="a"><label>B <input id="b"></label><input id="c"><input type="HIDDEN"><textarea aria-label=" "></textarea><select aria-labelledby="h"></select>'
    got = tags.unlabelled_controls(spark.createDataFrame([(1, html)], "page_id int, html string")).collect()
    assert sorted(r.control_id for r in got) == ["", "c"]


def test_draws_do_not_depend_on_layout(spark):
    df = spark.range(1000)
    a = [r.id for r in sampling.draw(df, "id", "seed", 5).collect()]
    assert a == [r.id for r in sampling.draw(df.repartition(13), "id", "seed", 5).collect()]
    assert a != [r.id for r in sampling.draw(df, "id", "other", 5).collect()]
    places = sampling.shuffle(df, "id", "seed")
    assert sorted(r.place for r in places.collect()) == list(range(1, 1001))
    assert [r.id for r in places.orderBy("place").limit(5).collect()] == a


def test_ranges(spark):
    once = [r.value for r in sampling.sample_range(spark, 1, 49, 49, False, "s").collect()]
    assert sorted(once) == list(range(1, 50))
    many = [r.value for r in sampling.sample_range(spark, 1, 6, 3000, True, "s").collect()]
    assert set(many) == set(range(1, 7)) and all(400 < many.count(v) < 600 for v in range(1, 7))
    with pytest.raises(ValueError):
        sampling.sample_range(spark, 1, 3, 4, False, "s")


def test_copies(spark):
    df = spark.createDataFrame([("ab",), ("c",)], "text string")
    assert sorted(r.text for r in sampling.replicate(df, 2, number=True).collect()) == ["1. ab", "1. c", "2. ab", "2. c"]
    text = df.select(sampling.repeat_text(F.col("text"), 12, number=True, trailing=True).alias("t")).first().t
    assert sampling.replicated_chars(df.limit(1), 12, number=True) == len(text)
    for bad in (0, 1.5, -3):
        with pytest.raises(ValueError):
            sampling.replicate(df, bad)
    with pytest.raises(ValueError):
        sampling.replicate(df, 100, max_chars=100)


def test_placeholder_text(spark):
    rows = sampling.placeholder_corpus(spark, 50, "s").orderBy("id").collect()
    assert rows[0].text.startswith("Amber basin cedar delta, ember fjord")
    for r in rows[1:]:
        sentences = r.text.rstrip(".").split(". ")
        assert 3 <= len(sentences) <= 6
        for s in sentences:
            n = len(s.split())
            assert 8 <= n <= 18 and s.count(",") == (1 if n > 11 else 0)
            if n > 11:
                assert 3 <= [w.endswith(",") for w in s.split()].index(True) <= n - 4
