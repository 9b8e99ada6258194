"""The skew-proof scan against the plain window and against brute force."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from rowsmith import dims
from rowsmith.operators import corpus, lines, lookup, ordered, search
from rowsmith.session import scratch_dir


def skewed(spark, n=2000):
    """A third of the rows under one key, another key in a single row, NULLs inside."""
    rnd = random.Random(7)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.34 else f"k{rnd.randrange(40)}"
        rows.append((key, rnd.randrange(60), i, None if rnd.random() < 0.2 else rnd.randrange(5), rnd.choice("ab")))
    rows += [("lone", 1, n, 3, "a"), (None, 1, n + 1, 3, "b"), (None, 2, n + 2, None, "b")]
    return spark.createDataFrame(rows, "k string, t int, id int, v int, s string").repartition(5)


WANTED = dict(position="pos", previous={"pv": "v", "ps": "s"}, running={"sum": "v"}, last_known={"known": "v"})


def brute(rows, keyed):
    out, state = [], {}
    for r in sorted(rows, key=lambda r: (r.t, r.id)):
        st = state.setdefault(r.k if keyed else 0, dict(pos=0, pv=None, ps=None, sum=None, known=None))
        st["pos"] += 1
        total = st["sum"] if r.v is None else (st["sum"] or 0) + r.v
        known = st["known"] if r.v is None else r.v
        out.append((r.id, st["pos"], st["pv"], st["ps"], total, known))
        st.update(pv=r.v, ps=r.s, sum=total, known=known)
    return sorted(out)


@pytest.mark.parametrize("bounded", [True, False])
def test_keyed_scan(spark, bounded):
    df = skewed(spark)
    got = ordered.scan(df, ["k"], [F.col("t"), F.col("id")], bounded=bounded, **WANTED)
    assert got.columns == df.columns + ["pos", "pv", "ps", "sum", "known"]
    assert sorted((r.id, r.pos, r.pv, r.ps, r["sum"], r.known) for r in got.collect()) == brute(df.collect(), True)


def test_scan_over_everything(spark):
    df = skewed(spark)
    got = ordered.scan(df, [], [F.col("t"), F.col("id")], **WANTED)
    assert sorted((r.id, r.pos, r.pv, r.ps, r["sum"], r.known) for r in got.collect()) == brute(df.collect(), False)


def test_descending_order(spark):
    df = skewed(spark)
    a = ordered.scan(df, ["k"], [F.col("t").desc(), F.col("id")], position="p")
    b = ordered.scan(df, ["k"], [F.col("t").desc(), F.col("id")], position="p", bounded=True)
    assert sorted(a.select("id", "p").collect()) == sorted(b.select("id", "p").collect())


def test_split_scan_uses_many_tasks_for_one_key(spark):
    df = spark.range(4000).withColumn("k", F.lit("only"))
    got = ordered.scan(df, ["k"], [F.col("id")], position="p")
    assert got.where("p <> id + 1").isEmpty()
    newest = max(glob.glob(f"{scratch_dir(spark)}/*/scan-*"), key=os.path.getmtime)
    pieces = spark.read.parquet(newest).groupBy("_scan_part").count().collect()
    assert len(pieces) == 8 and max(r["count"] for r in pieces) < 1500


def test_streaks_laps_and_sessions_when_split(spark):
    df = skewed(spark).where("k is not null").withColumn("ts", F.timestamp_seconds(F.col("t") * 400))
    for run in (
        lambda h: lines.longest_streak(df, ["k"], ["t", "id"], "s", h),
        lambda h: lines.laps(df, ["k"], "ts", "id", h),
        lambda h: lines.session_laps(df, ["k"], "ts", "id", 700, h),
        lambda h: lines.order_violations(df, ["k"], "s", ["t", "id"], h),
        lambda h: corpus.numeric_summary(df, "v", ["k"], h).select("k", "n", "median", "n_modes", "lowest_mode"),
    ):
        assert sorted(run(False).collect()) == sorted(run(True).collect())


def test_streak_by_hand(spark):
    rows = [("u", i, s) for i, s in enumerate("aabbbab")] + [("w", 0, "a")]
    df = spark.createDataFrame(rows, "k string, i int, s string")
    assert sorted(tuple(r) for r in lines.longest_streak(df, ["k"], ["i"], "s").collect()) == [("u", "b", 3, 3), ("w", "a", 1, 1)]


def test_summary_by_hand(spark):
    df = spark.createDataFrame([("a", x) for x in (1.0, 1.0, 2.0, 5.0, 5.0, 9.0)] + [("b", 4.0)], "g string, v double")
    a = corpus.numeric_summary(df, "v", ["g"]).where("g = 'a'").first()
    assert (a.n, a.median, a.n_modes, a.lowest_mode, a.mode_count, a.spread) == (6, 3.5, 2, 1.0, 2, 8.0)
    assert [r.v for r in corpus.modes(df, "v", ["g"]).where("g = 'a'").orderBy("v").collect()] == [1.0, 5.0]


def test_related_walks_round(spark):
    rows = [(i, "big" if i < 6 else "thin", f"n{9 - i}") for i in range(8)]
    df = spark.createDataFrame(rows, "id int, cat string, name string")
    order = {"big": [5, 4, 3, 2, 1, 0], "thin": [7, 6]}
    for hot in (True, False):
        got = {}
        for r in search.related(df, "id", "cat", "name", 3, hot).orderBy("item", "step").collect():
            got.setdefault(r.item, []).append(r.related)
        for i in range(6):
            at = order["big"].index(i)
            assert got[i] == [order["big"][(at + s) % 6] for s in (1, 2, 3)]
        assert got[6] == [7, 5, 4] and got[7] == [6, 5, 4]


def test_nearest_split_or_not(spark):
    values = [(i, "men" if i % 3 else "women", None if i == 7 else i / 8) for i in range(200)] + [(500, "none", 5.0), (501, None, 5.0)]
    df = spark.createDataFrame(values, "id int, grp string, size double")
    chart = dims.shoe_chart(spark)
    # A chart row without a group matches nothing, as a value without one does.
    chart = chart.unionByName(chart.limit(1).withColumn("grp", F.lit(None).cast("string")))
    small = lookup.nearest(df, "size", "grp", chart, "grp", "uk", "ord", bounded=True)
    big = lookup.nearest(df, "size", "grp", chart, "grp", "uk", "ord")
    assert sorted(big.collect(), key=lambda r: r.id) == sorted(small.collect(), key=lambda r: r.id)
    assert small.where("grp is null").first().ord is None
    for r in small.where("grp <> 'none' and size is not null").collect():
        rows = dims.SHOE_CHART[r.grp]
        best = min(range(len(rows)), key=lambda i: (abs(rows[i][0] - r.size), i))
        assert (r.ord, r.gap, r.off_chart) == (best, abs(rows[best][0] - r.size), not rows[0][0] <= r.size <= rows[-1][0])


def test_result_does_not_depend_on_partitions(spark):
    df = skewed(spark).where("k is not null")
    docs = df.select(F.col("id").alias("doc_id"), F.concat_ws("\n", "s", "k", "s").alias("text"))
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("1", "7", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            seen.append((
                sorted(lines.longest_streak(df.repartition(int(n)), ["k"], ["t", "id"], "s").collect()),
                sorted(lines.dedup(lines.explode_lines(docs), by=()).collect()),
                sorted(lines.number_corpus_lines(docs).select("doc_id", "line_no", "number").collect()),
                sorted(corpus.set_fingerprint(docs, F.col("doc_id"), F.col("text")).collect()),
                sorted(corpus.top_words(docs, 3, by=()).collect()),
            ))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] == seen[2]


def brute_runs(rows, keyed, column, breaks):
    """(id, run number, next known v) by walking each key in order."""
    by_key = {}
    for r in sorted(rows, key=lambda r: (r.t, r.id)):
        by_key.setdefault(r.k if keyed else 0, []).append(r)
    out = []
    for mine in by_key.values():
        run, was, numbers = 0, None, []
        for i, r in enumerate(mine):
            now = getattr(r, column)
            run += i == 0 or bool(breaks(was, now))
            was = now
            numbers.append(run)
        known, back = None, []
        for r in reversed(mine):
            known = known if r.v is None else r.v
            back.append(known)
        out += [(r.id, n, k) for r, n, k in zip(mine, numbers, reversed(back))]
    return sorted(out)


@pytest.mark.parametrize("bounded", [True, False])
@pytest.mark.parametrize("keyed", [True, False])
def test_runs_and_next_known(spark, bounded, keyed):
    df = skewed(spark)
    keys = ["k"] if keyed else []
    got = ordered.scan(
        df, keys, [F.col("t"), F.col("id")], next_known={"next": "v"}, bounded=bounded,
        runs={"run": ("s", lambda was, now: ~was.eqNullSafe(now)), "jump": ("t", lambda was, now: now - was >= 2)},
    )
    rows = df.collect()
    assert sorted((r.id, r.run, r.next) for r in got.collect()) == brute_runs(rows, keyed, "s", lambda a, b: a != b)
    assert sorted((r.id, r.jump, r.next) for r in got.collect()) == brute_runs(rows, keyed, "t", lambda a, b: b - a >= 2)


def test_one_run_over_many_partitions(spark):
    df = spark.range(5000).select(F.lit("hot").alias("k"), "id", F.when(F.col("id") == 4321, "b").otherwise("a").alias("s"))
    best = lines.longest_streak(df, ["k"], ["id"], "s").first()
    assert (best.s, best.length, best.starts_at) == ("a", 4321, 1)


def test_streaks_and_sessions_take_one_range_sort(spark, tmp_path):
    df = skewed(spark).withColumn("ts", F.timestamp_seconds(F.col("t") * 600))
    before = set(glob.glob(f"{scratch_dir(spark)}/*/scan-*"))
    lines.longest_streak(df, ["k"], ["t", "id"], "s").collect()
    lines.session_laps(df, ["k"], "ts", "id").collect()
    assert len(set(glob.glob(f"{scratch_dir(spark)}/*/scan-*")) - before) == 2


@pytest.mark.parametrize("bounded", [True, False])
def test_highest_and_total_of_the_whole_key(spark, bounded):
    df = skewed(spark)
    got = ordered.scan(df, ["k"], [F.col("t"), F.col("id")], highest={"top": "v"}, total={"all": "v"}, bounded=bounded).collect()
    for r in got:
        mine = [x.v for x in got if x.k == r.k and x.v is not None]
        assert (r.top, r["all"]) == (max(mine), sum(mine)) if mine else (None, None)


def test_a_group_without_a_name_has_a_summary(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0)], "k string, v double")
    got = {r.k: (r.n, r.median) for r in corpus.numeric_summary(df, "v", ["k"]).collect()}
    assert got == {None: (2, 2.0), "a": (1, 2.0)}
