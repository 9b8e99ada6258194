"""Streams against their batch forms, over several micro-batches."""

import random

import pytest
from pyspark.sql import functions as F

from rowsmith.functions import text as T
from rowsmith.operators import corpus, lines
from rowsmith.plans.registry import table
from rowsmith.session import scratch_path
from rowsmith.streaming import jobs, keyed


def folder(spark):
    return scratch_path(spark, "in")


def test_doc_stats_stream_equals_batch(spark, sf):
    stream = jobs.drain(jobs.doc_stats(jobs.table_stream(spark, sf, "documents")))
    assert sorted(stream.collect()) == sorted(corpus.doc_stats(table(spark, sf, "documents")).collect())


# A watermark starts at 1970, so what is told in seconds here starts later.
START_US = 10**15


def outcomes(spark, rows, parts):
    """Events (u, seconds, id, v) delivered in parts: the state session, the stream and the deliveries."""
    session = keyed.state_session(spark)
    events = session.createDataFrame([(*r, n) for r, n in zip(rows, parts)], "u int, s double, id long, v string, n int")
    timed = events.select("u", F.timestamp_micros((F.col("s") * 1_000_000).cast("long") + START_US).alias("ts"), "id", "v", "n")
    return session, *jobs.deliveries(session, timed, F.col("n"))


def run_parts(session, stream, arrive, twice=()):
    """All parts one by one; those in ``twice`` fail once before they are committed, and run again. Late rows too."""
    sink, late = jobs.Sink(session), 0
    for n in arrive:
        late += keyed.late_rows(sink.run(stream))
        if n in twice:
            forget_last_commit(session, sink.path)
            sink.run(stream)
    return sink.rows(session, stream.schema), late


def forget_last_commit(session, path):
    """Make the last batch look unfinished, as if the driver had died before it was committed."""
    hadoop = session._jvm.org.apache.hadoop.fs.Path
    store = hadoop(path).getFileSystem(session._jsc.hadoopConfiguration())
    commits = [f.getPath() for f in store.globStatus(hadoop(f"{path}/state/commits/[0-9]*"))]
    last = max(commits, key=lambda c: int(c.getName()))
    store.delete(last, False)
    store.delete(hadoop(f"{path}/state/commits/.{last.getName()}.crc"), False)


def runs_of(rows, upto):
    """(u, v, length, starts_at) of every run that another value ends, over the rows up to a time, in plain Python."""
    out = []
    for u in sorted({r[0] for r in rows}):
        mine = [r[3] for r in sorted((r for r in rows if r[0] == u and r[1] <= upto), key=lambda r: (r[1], r[2]))]
        start = 0
        for k in range(1, len(mine)):
            if mine[k] != mine[start]:
                out.append((u, mine[start], k - start, start + 1))
                start = k
    return sorted(out, key=repr)


def test_closed_runs_equal_the_batch_whatever_the_order_inside_the_delay(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(3), float(rng.randrange(0, 5000)), k, rng.choice(["a", "b", None])) for k in range(300)]
    # Each row arrives in the part of its time or, at most 400 seconds later, the next.
    parts = [int(r[1] // 1000) + (rng.random() < 0.3 and r[1] % 1000 > 700) for r in rows]
    session, stream, arrive = outcomes(spark, rows, parts)
    runs = keyed.closed_runs(stream, "u", "ts", "id", "v", "500 seconds")
    got, late = run_parts(session, runs, arrive)
    upto = max(r[1] for r in rows) - 500
    assert late == 0 and sorted((tuple(r) for r in got.collect()), key=repr) == runs_of(rows, upto)


def test_state_grows_with_buckets_and_not_with_keys(spark):
    rng = random.Random(9)
    rows = [(rng.randrange(-1, 200), float(rng.randrange(0, 3000)), k, rng.choice(["a", "b"])) for k in range(1500)]
    session, stream, arrive = outcomes(spark, [(None if u < 0 else u, *rest) for u, *rest in rows], [int(r[1] // 1500) for r in rows])
    runs, sink, state = keyed.closed_runs(stream, "u", "ts", "id", "v", "10 seconds", buckets=3), jobs.Sink(session), []
    for _ in arrive:
        state += [op.numRowsTotal for p in sink.run(runs).recentProgress for op in p.stateOperators]
    got = [(-1 if u is None else u, *rest) for u, *rest in sink.rows(session, runs.schema).collect()]
    # A timer, where it stands, what waits and what is open: a few rows a bucket.
    assert sorted(got, key=repr) == runs_of(rows, max(r[1] for r in rows) - 10) and max(state) <= 30


@pytest.mark.parametrize("twice", [(0,), (1,), (2,), (0, 1, 2)])
def test_a_batch_that_runs_again_changes_nothing(spark, twice):
    # One outcome over three batches: what the earlier ones counted must be neither lost nor counted again.
    rows = [(1, float(100 * k), k, "a") for k in range(9)] + [(1, 900.0, 9, "b"), (1, 5000.0, 10, "b")]
    session, stream, arrive = outcomes(spark, rows, [0] * 3 + [1] * 3 + [2] * 5)
    got, _ = run_parts(session, keyed.closed_runs(stream, "u", "ts", "id", "v", "10 seconds"), arrive, twice)
    assert [tuple(r) for r in got.collect()] == [(1, "a", 9, 1)]


def test_late_rows_are_counted_and_left_out(spark):
    rows = [(1, 0.0, 1, "a"), (1, 10.0, 2, "a"), (1, 5000.0, 3, "b"), (1, 20.0, 4, "a"), (1, 4950.0, 5, "b"), (1, 9000.0, 6, "c"), (1, None, 7, "c")]
    session, stream, arrive = outcomes(spark, rows, [0, 0, 0, 1, 1, 1, 1])
    got, late = run_parts(session, keyed.closed_runs(stream, "u", "ts", "id", "v", "100 seconds"), arrive)
    # The last two rows still wait, or are open: only the first run has ended.
    assert late == 1 and [tuple(r) for r in got.collect()] == [(1, "a", 2, 1)]


def laps_of(rows, gap, upto):
    out = []
    for u in sorted({r[0] for r in rows}):
        mine = sorted((r[1], r[2]) for r in rows if r[0] == u)
        sessions = []
        for at, tie in mine:
            if sessions and at - sessions[-1][-1][0] < gap:
                sessions[-1].append((at, tie))
            else:
                sessions.append([(at, tie)])
        for one in sessions:
            if one[-1][0] + gap <= upto:
                out += [(u, one[0][0], tie, k + 1, at - one[max(k - 1, 0)][0], at - one[0][0]) for k, (at, tie) in enumerate(one)]
    return sorted(out)


def test_laps_of_closed_sessions_equal_the_batch(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(4), float(rng.randrange(0, 20_000)), k, None) for k in range(250)]
    parts = [int(r[1] // 4000) + (rng.random() < 0.3 and r[1] % 4000 > 3800) for r in rows]
    session, stream, arrive = outcomes(spark, rows, parts)
    laps = keyed.session_laps(stream, "u", "ts", "id", 90, "300 seconds")
    got, late = run_parts(session, laps, arrive, twice=(2,))
    us = lambda s: int(s * 1_000_000)
    found = got.select("u", F.unix_micros("session") - START_US, "id", "lap_no", "lap_us", "total_us").collect()
    want = [(u, us(a), tie, no, us(lap), us(total)) for u, a, tie, no, lap, total in laps_of(rows, 90, max(r[1] for r in rows) - 300)]
    assert late == 0 and sorted(tuple(r) for r in found) == want


def test_the_callers_session_keeps_its_state_store(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    assert keyed.state_session(spark).conf.get(name) == keyed.ROCKS and spark.conf.get(name) == before


def test_line_dedup_forgets_lines_beyond_the_horizon(spark):
    # Every delivery has 50 lines of its own and one line that all have.
    rows = [(part, "\n".join([f"line {part} {k}" for k in range(50)] + [" Always There "]), part) for part in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int").withColumn("at", F.timestamp_seconds(10**9 + F.col("part") * 3600))
    stream, arrive = jobs.deliveries(spark, docs, F.col("part"))
    first = jobs.dedup_lines(stream, "at", "1 hour")
    sink, states = jobs.Sink(spark), []
    for _ in arrive:
        states.append(sink.run(first).recentProgress[-1].stateOperators[0].numRowsTotal)
    got = sink.rows(spark, first.schema)
    assert got.where("key like 'line%'").count() == 400
    # Within two hours the line is known; from the third on it is new.
    assert sorted(r.doc_id for r in got.where("key = 'always there'").collect()) == [0, 3, 6]
    assert max(states) <= 3 * 51


def test_inside_the_horizon_line_dedup_equals_the_batch(spark, sf):
    docs = table(spark, sf, "documents").withColumn("at", F.timestamp_seconds(10**9 + F.col("doc_id")))
    stream, arrive = jobs.deliveries(spark, docs, F.pmod("doc_id", F.lit(3)))
    first, sink = jobs.dedup_lines(stream, "at", "1 day"), jobs.Sink(spark)
    for _ in arrive:
        sink.run(first)
    batch = lines.dedup(lines.explode_lines(docs), "first", by=())
    keys = lambda df: sorted(r[0] for r in df.collect())
    assert keys(sink.rows(spark, first.schema).select("key")) == keys(batch.select(T.line_key("line")))


def test_deliveries_hold_every_row_once(spark, sf):
    events = table(spark, sf, "events")
    stream, arrive = jobs.deliveries(spark, events, F.pmod("event_id", F.lit(3)))
    sink, seen = jobs.Sink(spark), []
    for n in arrive:
        sink.merge(stream, lambda batch, batch_id: seen.append((batch_id, batch.count(), batch.agg(F.max(F.pmod("event_id", F.lit(3)))).first()[0])))
    assert [s[2] for s in seen if s[1]] == [0, 1, 2] and sum(s[1] for s in seen) == events.count()


def test_latest_wins_out_of_order(spark):
    store = jobs.LatestWins(folder(spark), "k", "seq", ["v"])
    mk = lambda *rows: spark.createDataFrame(rows, "k string, seq int, v string")
    store.merge(mk(("a", 5, "new"), ("b", 1, "b1")), 0)
    store.merge(mk(("a", 2, "old"), ("b", 2, "b2"), ("b", 3, "b3")), 1)
    store.merge(mk(("a", 2, "old"), ("b", 2, "b2"), ("b", 3, "b3")), 1)
    assert sorted(map(tuple, store.latest(spark).collect())) == [("a", 5, "new"), ("b", 3, "b3")]


def test_old_batches_are_merged_away(spark):
    store = jobs.LatestWins(folder(spark), "k", "seq", ["v"], compact_every=3)
    for n in range(8):
        store.merge(spark.createDataFrame([("a", n, f"v{n}"), (f"k{n}", 0, "x")], "k string, seq int, v string"), n)
    assert jobs.folders(spark, store.path, "base") == [6] and jobs.folders(spark, store.path, "batch") == [7]
    rows = {r.k: r.v for r in store.latest(spark).collect()}
    assert rows == {"a": "v7", **{f"k{n}": "x" for n in range(8)}}


def test_only_touched_buckets_are_written_anew(spark):
    store = jobs.LatestWins(folder(spark), "k", "seq", ["v"], compact_every=2, buckets=8)
    mk = lambda n, keys: spark.createDataFrame([(k, n, f"v{n}") for k in keys], "k int, seq int, v string")
    for n, keys in enumerate([range(40), [1], range(40), [1], [1]]):
        store.merge(mk(n, keys), n)
    # The last merge touched one bucket: the others are still in the base before it, and nothing stands twice.
    held = [p.rsplit("/", 2)[1:] for p in store._current(spark)]
    assert len(held) == 8 and [base for base, _ in held].count("base=4") == 1 and {base for base, _ in held} == {"base=2", "base=4"}
    want = {k: "v2" for k in range(40)} | {1: "v4"}
    assert {r.k: r.v for r in store.latest(spark).collect()} == want
    # A batch that is run again, merged or not, changes nothing.
    for n, keys in ((4, [1]), (3, [1]), (5, [2]), (5, [2])):
        store.merge(mk(n, keys), n)
    assert {r.k: r.v for r in store.latest(spark).collect()} == want | {2: "v5"}


def test_the_first_line_wins_whatever_the_order_of_batches(spark):
    mk = lambda d, t: spark.createDataFrame([(d, t)], "doc_id bigint, text string").withColumn("at", F.timestamp_seconds("doc_id"))
    store = jobs.FirstLines(folder(spark), "at", compact_every=2)
    for n, (d, text) in enumerate([(2, "b\nc"), (3, "c\nd\nd"), (1, "x\nB\nA")]):
        store.merge(mk(d, text), n)
    got = sorted((r.key, r.doc_id, r.line_no, r.line) for r in store.rows(spark).collect())
    assert got == [("a", 1, 2, "A"), ("b", 1, 1, "B"), ("c", 2, 1, "c"), ("d", 3, 1, "d"), ("x", 1, 0, "x")]


def test_a_running_stream_sees_new_rates(spark):
    known = [("2024-01-01", "USD", 1.0), ("2024-01-01", "EUR", 2.0)]
    rates = lambda: spark.createDataFrame(known, "rate_date string, currency string, rate double").withColumn("rate_date", F.to_date("rate_date"))
    job = jobs.RatesJoin(folder(spark), rates, "d", "amount", "f", "t", ["id", "converted"])
    mk = lambda i, d: spark.createDataFrame([(i, d, 10.0, "USD", "EUR")], "id int, d string, amount double, f string, t string")
    job.merge(mk(1, "2024-01-05"), 0)
    known.append(("2024-01-04", "EUR", 3.0))
    job.merge(mk(2, "2024-01-05"), 1)
    assert sorted((r.id, r.converted) for r in job.rows(spark).collect()) == [(1, 20.0), (2, 30.0)]


def test_windows_closed_by_the_watermark(spark, sf):
    stream = jobs.drain(jobs.window_counts(jobs.table_stream(spark, sf, "events"), "ts", "1 day", ["event_type"]))
    batch = jobs.window_counts(table(spark, sf, "events"), "ts", "1 day", ["event_type"])
    closed = table(spark, sf, "events").agg(F.max(F.col("ts").cast("timestamp")) - F.expr("interval 1 hour")).scalar()
    assert sorted(stream.collect()) == sorted(batch.where(F.col("end") <= closed).collect())
