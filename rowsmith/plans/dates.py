"""Queries over order and event dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.functions import calendar as C
from rowsmith.operators import dates
from rowsmith.plans.registry import query, table


def _pairs(spark, sf):
    k = F.col("o_orderkey")
    a = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(k.alias("id"), a.alias("a"), F.date_add(a, (k % 4000 - 200).cast("int")).alias("b"))


_PAIRS = "pairs AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 4000 - 200 AS INTEGER) AS b FROM orders)"
# Whole months are checked by counting how many month steps fit, not by the year-month guess.
_MONTHS = "len(list_filter(range(1, 140), lambda k: {lo} + to_months(CAST(k AS INTEGER)) <= {hi}))"


@query("exact_age", f"""WITH {_PAIRS}, m AS (SELECT *, {_MONTHS.format(lo='a', hi='b')} AS tm FROM pairs),
n AS (SELECT *, (SELECT min(CAST(a + to_years(CAST(y AS INTEGER)) AS DATE)) FROM range(0, 14) t(y) WHERE a + to_years(CAST(y AS INTEGER)) >= b) AS nb FROM m)
SELECT id, CASE WHEN a <= b THEN tm // 12 END AS years, CASE WHEN a <= b THEN tm % 12 END AS months,
  CASE WHEN a <= b THEN date_diff('day', CAST(a + to_months(CAST(tm AS INTEGER)) AS DATE), b) END AS days, CASE WHEN a <= b THEN tm END AS total_months,
  CASE WHEN a <= b THEN date_diff('day', a, b) END AS total_days, CASE WHEN a <= b THEN date_diff('day', a, b) // 7 END AS total_weeks,
  CASE WHEN a <= b THEN isodow(a) - 1 END AS born_weekday, CASE WHEN a <= b THEN date_diff('day', b, nb) END AS days_to_birthday,
  CASE WHEN a > b THEN 'born after the comparison date' END AS finding FROM n""")
def _(spark, sf):
    return dates.exact_age(_pairs(spark, sf), "a", "b").drop("a", "b")


@query("date_diff", f"""WITH {_PAIRS}, m AS (SELECT *, least(a, b) AS lo, greatest(a, b) AS hi FROM pairs)
SELECT id, date_diff('day', a, b) AS days, abs(date_diff('day', a, b)) // 7 AS weeks, abs(date_diff('day', a, b)) % 7 AS days_over, {_MONTHS.format(lo='lo', hi='hi')} AS whole_months,
  CASE WHEN b <= a THEN 0 ELSE len(list_filter(range(1, greatest(date_diff('day', a, b), 0) + 1), lambda k: isodow(a + CAST(k AS INTEGER)) <= 5)) END AS weekdays FROM m""")
def _(spark, sf):
    return dates.date_diff(_pairs(spark, sf), "a", "b").drop("a", "b")


# The closed form is checked by walking the days.
@query("weekdays_between", f"""WITH {_PAIRS}
SELECT id, CASE WHEN b <= a THEN 0 ELSE len(list_filter(range(1, greatest(date_diff('day', a, b), 0) + 1), lambda k: isodow(a + CAST(k AS INTEGER)) <= 5)) END AS weekdays FROM pairs""")
def _(spark, sf):
    return _pairs(spark, sf).select("id", C.weekdays_between(F.col("a"), F.col("b")).alias("weekdays"))


def _holidays(spark, sf):
    """The 1st and 15th of every month orders were placed in."""
    month = F.trunc("o_orderdate", "month")
    months = table(spark, sf, "orders").select(month.alias("m")).distinct()
    return months.select(F.explode(F.array("m", F.date_add("m", 14))).alias("day"))


_HOLIDAYS = """hol AS (SELECT DISTINCT unnest([m, m + 14]) AS day FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders)),
cal AS (SELECT d, sum(CASE WHEN isodow(d) IN ({off}) OR d IN (SELECT day FROM hol) THEN 0 ELSE 1 END) OVER (ORDER BY d) AS upto,
  CASE WHEN isodow(d) IN ({off}) OR d IN (SELECT day FROM hol) THEN 0 ELSE 1 END AS w FROM (SELECT CAST(unnest(generate_series(DATE '1993-01-01', DATE '2014-12-31', INTERVAL 1 DAY)) AS DATE) AS d))"""


@query("working_days", f"""WITH {_PAIRS}, {_HOLIDAYS.format(off='7')}
SELECT id, CAST(greatest(0, e.upto - s.upto) AS BIGINT) AS working_days FROM pairs JOIN cal s ON s.d = a JOIN cal e ON e.d = b""")
def _(spark, sf):
    return dates.working_days(_pairs(spark, sf), "a", "b", _holidays(spark, sf), weekend=(6,)).select("id", "working_days")


@query("add_days", """SELECT o_orderkey AS id, CAST(CAST(o_orderdate + to_days(CAST(n AS INTEGER)) AS DATE) AS VARCHAR) AS days, CAST(CAST(o_orderdate + to_days(CAST(n * 7 AS INTEGER)) AS DATE) AS VARCHAR) AS weeks,
  CAST(CAST(o_orderdate + to_months(CAST(n AS INTEGER)) AS DATE) AS VARCHAR) AS months, CAST(CAST(o_orderdate + to_years(CAST(n % 5 AS INTEGER)) AS DATE) AS VARCHAR) AS years
FROM (SELECT *, o_orderkey % 61 - 30 AS n FROM orders)""")
def _(spark, sf):
    d, n = F.to_date("o_orderdate"), F.col("o_orderkey") % 61 - 30
    moved = [dates.shift_date(d, n if unit != "years" else n % 5, unit).alias(unit) for unit in ("days", "weeks", "months", "years")]
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), *moved)


# Signed moves: forward from the day itself, back from the day before it.
@query("add_working_days", f"""WITH {_HOLIDAYS.format(off='6, 7')}, o AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS a, o_orderkey % 61 - 30 AS n FROM orders),
m AS (SELECT id, n, a, CASE WHEN n > 0 THEN s.upto + n ELSE p.upto + n + 1 END AS goal FROM o JOIN cal s ON s.d = a JOIN cal p ON p.d = a - 1)
SELECT id, CAST(CASE WHEN n = 0 THEN a ELSE g.d END AS VARCHAR) AS shifted FROM m JOIN cal g ON g.w = 1 AND g.upto = goal""")
def _(spark, sf):
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(k.alias("id"), F.to_date("o_orderdate").alias("a"), (k % 61 - 30).alias("n"))
    return dates.add_working_days(rows, "a", "n", _holidays(spark, sf)).select("id", "shifted")


@query("iso_week", """SELECT o_orderkey AS id, isoyear(o_orderdate) AS iso_year, week(o_orderdate) AS iso_week, CAST(CAST(date_trunc('week', o_orderdate) AS DATE) AS VARCHAR) AS monday,
  CAST(CAST(date_trunc('week', o_orderdate) AS DATE) + 6 AS VARCHAR) AS sunday FROM orders""")
def _(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("d"))
    return dates.iso_week(rows, "d").drop("d")


@query("leap_rule", """WITH y AS (SELECT year(o_orderdate) + (o_orderkey % 5) * 100 AS y FROM orders)
SELECT CASE WHEN y % 400 = 0 THEN 'divisible by 400' WHEN y % 100 = 0 THEN 'divisible by 100' WHEN y % 4 = 0 THEN 'divisible by 4' ELSE 'not divisible by 4' END AS rule,
  day(last_day(make_date(y, 2, 1))) = 29 AS leap, count(*) AS n, count(DISTINCT y) AS years FROM y GROUP BY ALL""")
def _(spark, sf):
    year = F.year("o_orderdate") + F.col("o_orderkey") % 5 * 100
    rows = table(spark, sf, "orders").select(year.alias("y"))
    return rows.groupBy(C.leap_rule(F.col("y")).alias("rule"), C.is_leap(F.col("y")).alias("leap")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("y").alias("years")
    )


@query("epoch_parse", """SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS parsed, epoch_us(ts) // 1000000 AS seconds FROM events""")
def _(spark, sf):
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    stamp = F.when(F.col("event_id") % 2 == 0, F.floor(at / 1_000_000)).otherwise(F.floor(at / 1000))
    rows = table(spark, sf, "events").select("event_id", C.from_epoch(stamp).alias("parsed"))
    return rows.withColumn("seconds", C.to_epoch_seconds(F.col("parsed")))


@query("tz_convert", """SELECT o_orderkey AS id, strftime(timezone('Europe/London', timezone('Asia/Kolkata', o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)))), '%Y-%m-%d %H:%M:%S') AS converted FROM orders""")
def _(spark, sf):
    at = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), at.cast("timestamp_ntz").alias("ts"))
    return dates.convert_zone(rows, "ts", "Asia/Kolkata", "Europe/London").drop("ts")


@query("countdown", """WITH g AS (SELECT event_id, (epoch_us(ts) - (epoch_us(ts) % 1000000 + 1000000) % 1000000) // 1000000 - epoch(TIMESTAMP '2024-01-15 12:00:00')::BIGINT AS gap FROM events)
SELECT event_id, CASE WHEN gap >= 0 THEN 'to go' ELSE 'ago' END AS direction, abs(gap) // 86400 AS d, abs(gap) % 86400 // 3600 AS h, abs(gap) % 3600 // 60 AS m, abs(gap) % 60 AS s FROM g""")
def _(spark, sf):
    return dates.countdown(table(spark, sf, "events").select("event_id", "ts"), "ts", F.lit("2024-01-15 12:00:00")).drop("ts")
