"""Streaming queries run to the end of their input and read back from their sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.plans.lookups import CODES, pick, rates_history
from rowsmith.plans.registry import ORACLES, query, rounded, table
from rowsmith.plans.texts import _DOC_STATS
from rowsmith.session import scratch_path
from rowsmith.streaming import jobs, keyed


@query("stream_doc_stats", "WITH s AS (" + _DOC_STATS.format(src="documents") + """)
SELECT doc_id, words, chars, chars_solid, sentences, paragraphs, CASE WHEN words = 0 THEN '0m' WHEN words < 225 THEN '<1m'
  ELSE CAST(CAST(floor(words / 225 + 0.5) AS BIGINT) AS VARCHAR) || 'm' END AS reading FROM s""")
def _(spark, sf):
    return jobs.drain(jobs.doc_stats(jobs.table_stream(spark, sf, "documents")))


def in_parts(spark, rows, number, merge) -> None:
    """Hand a table over in parts, one micro-batch each."""
    stream, arrive = jobs.deliveries(spark, rows, number)
    sink = jobs.Sink(spark)
    for _ in arrive:
        sink.merge(stream, merge)


def dealt(key: str, n: int = 4):
    """Rows dealt to ``n`` parts by hash: no part is in order."""
    return F.pmod(F.xxhash64(key), F.lit(n))


@query("stream_line_dedup", "WITH @LINES@, k AS (SELECT @KEY@ AS key, doc_id, line_no, line FROM lines) "
       "SELECT key, doc_id, line_no, line FROM k QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id, line_no) = 1")
def _(spark, sf):
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("doc_id"))
    store = jobs.FirstLines(scratch_path(spark, "first"), "at", compact_every=2)
    in_parts(spark, table(spark, sf, "documents").withColumn("at", at), dealt("doc_id"), store.merge)
    return store.rows(spark).select("key", "doc_id", F.col("line_no").cast("long"), "line")


# Documents arrive in six deliveries, an hour apart. With a horizon of an hour a line is forgotten two hours after its
# delivery at the earliest, when the next one has been read: it is kept again from the third delivery after it on.
@query("stream_line_dedup_horizon", """WITH RECURSIVE @LINES@, k AS (SELECT DISTINCT @KEY@ AS key, CAST(doc_id % 6 AS BIGINT) AS part FROM lines),
kept AS (SELECT key, min(part) AS part FROM k GROUP BY key
  UNION ALL SELECT kept.key, (SELECT min(k.part) FROM k WHERE k.key = kept.key AND k.part >= kept.part + 3) FROM kept WHERE kept.part IS NOT NULL)
SELECT key, part FROM kept WHERE part IS NOT NULL""")
def _(spark, sf):
    part = F.pmod("doc_id", F.lit(6))
    docs = table(spark, sf, "documents").withColumn("at", F.timestamp_seconds(F.lit(1_700_000_000) + part * 3600))
    stream, arrive = jobs.deliveries(spark, docs, part)
    first = jobs.dedup_lines(stream, "at", "1 hour").select("key", F.floor((F.unix_seconds("at") - 1_700_000_000) / 3600).alias("part"))
    sink = jobs.Sink(spark)
    for _ in arrive:
        sink.run(first)
    return sink.rows(spark, first.schema)


@query("stream_latest_wins", """SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value, max(event_id) AS event_id FROM events GROUP BY user_id""")
def _(spark, sf):
    store = jobs.LatestWins(scratch_path(spark, "latest"), "user_id", "event_id", ["event_type", "value"], compact_every=2, buckets=4)
    in_parts(spark, table(spark, sf, "events"), dealt("event_id"), store.merge)
    return store.latest(spark)


@query("stream_rates_join", ORACLES["rates_asof"])
def _(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("amount"), F.to_date("o_orderdate").alias("d"),
        pick(F.col("o_orderkey"), CODES + ["XXX"]).alias("frm"), pick(F.floor(F.col("o_orderkey") / 7), CODES).alias("to"),
    )
    job = jobs.RatesJoin(
        scratch_path(spark, "converted"), lambda: rates_history(spark, sf), "d", "amount", "frm", "to",
        ["o_orderkey", "converted", "rate_date", "stale"],
    )
    in_parts(spark, rows, dealt("o_orderkey"), job.merge)
    return job.rows(spark)


_TUMBLE = """w AS (SELECT event_type, date_trunc('day', ts) AS s, count(*) AS n FROM events GROUP BY ALL)
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS start, strftime(s + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS "end", event_type, n FROM w"""
_SLIDE = """w AS (SELECT event_type, date_trunc('day', ts) + to_hours(CAST(k * 6 AS INTEGER)) AS s, count(*) AS n FROM events, range(-3, 4) t(k)
  WHERE date_trunc('day', ts) + to_hours(CAST(k * 6 AS INTEGER)) <= ts AND ts < date_trunc('day', ts) + to_hours(CAST(k * 6 + 24 AS INTEGER)) GROUP BY ALL)
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS start, strftime(s + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS "end", event_type, n FROM w"""
# Append mode gives the windows the watermark has closed.
_CLOSED = " WHERE s + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)"


@query("tumbling_counts", "WITH " + _TUMBLE)
def _(spark, sf):
    return jobs.window_counts(table(spark, sf, "events"), "ts", "1 day", ["event_type"])


@query("sliding_counts", "WITH " + _SLIDE)
def _(spark, sf):
    return jobs.window_counts(table(spark, sf, "events"), "ts", "1 day", ["event_type"], "6 hours")


@query("stream_tumbling_counts", "WITH " + _TUMBLE + _CLOSED)
def _(spark, sf):
    return jobs.drain(jobs.window_counts(jobs.table_stream(spark, sf, "events"), "ts", "1 day", ["event_type"]))


@query("stream_sliding_counts", "WITH " + _SLIDE + _CLOSED)
def _(spark, sf):
    return jobs.drain(jobs.window_counts(jobs.table_stream(spark, sf, "events"), "ts", "1 day", ["event_type"], "6 hours"))


@query("stream_sessions", """WITH l AS (SELECT user_id, ts, event_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS lap FROM events),
s AS (SELECT *, sum(CASE WHEN lap IS NULL OR lap >= 1800000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM l),
g AS (SELECT user_id, no, min(ts) AS a, max(ts) + INTERVAL 30 MINUTE AS b, count(*) AS events, max(epoch_us(ts)) - min(epoch_us(ts)) AS length_us FROM s GROUP BY ALL)
SELECT strftime(a, '%Y-%m-%d %H:%M:%S') AS start, strftime(b, '%Y-%m-%d %H:%M:%S') AS "end", user_id, events, length_us,
  CASE WHEN events > 1 THEN round(length_us / CAST(events - 1 AS DOUBLE), 3) END AS mean_lap_us FROM g WHERE b <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""")
def _(spark, sf):
    out = jobs.drain(jobs.sessions(jobs.table_stream(spark, sf, "events"), ["user_id"], "ts"))
    return rounded(out, 3, "mean_lap_us")


# Events arrive by quarters of their time, every fiftieth one a quarter late; rows more than six hours behind the latest
# time of the quarters before are left out, and runs are counted over what the watermark has passed at the end.
_IN_QUARTERS = """m AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM events),
q AS (SELECT *, CAST((epoch_us(ts) - lo) * 4 // (hi - lo + 1) AS BIGINT) AS quarter FROM events, m),
d AS (SELECT *, CASE WHEN event_id % 50 = 0 THEN least(quarter + 1, 3) ELSE quarter END AS part FROM q),
w AS (SELECT part, (max(epoch_ms(max(ts))) OVER (ORDER BY part) - 21600000) * 1000 AS mark FROM d GROUP BY part),
c AS (SELECT d.* FROM d LEFT JOIN w ON w.part = d.part - 1 WHERE (w.mark IS NULL OR epoch_us(ts) > w.mark) AND epoch_us(ts) <= (SELECT max(mark) FROM w))"""


@query("stream_streaks", "WITH " + _IN_QUARTERS + """,
o AS (SELECT user_id, event_type, row_number() OVER v AS pos, CASE WHEN lag(event_type) OVER v = event_type THEN 0 ELSE 1 END AS starts FROM c WINDOW v AS (PARTITION BY user_id ORDER BY ts, event_id)),
n AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY pos) AS run FROM o),
r AS (SELECT user_id, event_type, run, count(*) AS length, min(pos) AS starts_at, max(run) OVER (PARTITION BY user_id) AS last FROM n GROUP BY user_id, event_type, run)
SELECT user_id, event_type, length, starts_at FROM r WHERE run < last""")
def _(spark, sf):
    session = keyed.state_session(spark)
    events = table(session, sf, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    lo, hi = F.col("us") - events.agg(F.min("us")).scalar(), events.agg(F.max("us")).scalar() - events.agg(F.min("us")).scalar() + 1
    quarter = F.floor(lo * 4 / hi)
    late = F.when(F.col("event_id") % 50 == 0, F.least(quarter + 1, F.lit(3))).otherwise(quarter)
    stream, arrive = jobs.deliveries(session, events, late)
    runs = keyed.closed_runs(stream, "user_id", "ts", "event_id", "event_type", "6 hours")
    sink = jobs.Sink(session)
    for _ in arrive:
        sink.run(runs)
    return sink.rows(spark, runs.schema)


@query("stream_session_laps", """WITH l AS (SELECT user_id, ts, event_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS lap FROM events),
s AS (SELECT *, sum(CASE WHEN lap IS NULL OR lap >= 1800000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM l),
g AS (SELECT *, min(ts) OVER v AS a, max(ts) OVER v AS z, row_number() OVER (PARTITION BY user_id, no ORDER BY ts, event_id) AS lap_no FROM s WINDOW v AS (PARTITION BY user_id, no))
SELECT user_id, strftime(a, '%Y-%m-%d %H:%M:%S') AS session, event_id, lap_no, CASE WHEN lap_no = 1 THEN 0 ELSE lap END AS lap_us, epoch_us(ts) - epoch_us(a) AS total_us
FROM g WHERE epoch_us(z) + 1800000000 <= (SELECT epoch_ms(max(ts)) - 3600000 FROM events) * 1000""")
def _(spark, sf):
    session = keyed.state_session(spark)
    laps = keyed.session_laps(jobs.table_stream(session, sf, "events"), "user_id", "ts", "event_id")
    sink = jobs.Sink(session)
    sink.run(laps)
    return sink.rows(spark, laps.schema)
