"""Queries that convert, look up, reconcile and summarise numbers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from rowsmith import dims
from rowsmith.operators import corpus, lines, lookup
from rowsmith.plans.registry import query, rounded, table


def dbl(x: float) -> str:
    """A DOUBLE literal: a bare 0.1 would be a DECIMAL to the checking engine."""
    text = repr(float(x))
    return text if "e" in text else text + "e0"


def values(name: str, columns: str, rows: list[tuple]) -> str:
    cells = lambda r: ", ".join(f"'{v}'" if isinstance(v, str) else (str(v) if isinstance(v, int) else dbl(v)) for v in r)
    return f"{name}({columns}) AS (VALUES " + ", ".join(f"({cells(r)})" for r in rows) + ")"


def pick(column, names: list[str]):
    return F.element_at(F.array(*[F.lit(n) for n in names]), (column % len(names) + 1).cast("int"))


def pick_sql(column: str, names: list[str]) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + f"][CAST({column} % {len(names)} AS INTEGER) + 1]"


# Money and units ------------------------------------------------------------------

CODES = ["EUR", *sorted(dims.RATES)]
_RATES_SQL = values("rates", "currency, rate", [("EUR", 1.0), *dims.RATES.items()])


def _money_rows(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(
        "o_orderkey", F.col("o_totalprice").alias("amount"), F.to_date("o_orderdate").alias("d"),
        pick(F.col("o_orderkey"), CODES + ["XXX"]).alias("frm"), pick(F.floor(F.col("o_orderkey") / 7), CODES).alias("to"),
    )


_MONEY_SQL = f"""money AS (SELECT o_orderkey, o_totalprice AS amount, CAST(o_orderdate AS DATE) AS d,
  {pick_sql('o_orderkey', CODES + ['XXX'])} AS frm, {pick_sql('(o_orderkey // 7)', CODES)} AS "to" FROM orders)"""


@query("currency_convert", f"""WITH {_RATES_SQL}, {_MONEY_SQL}
SELECT o_orderkey, frm, "to", m.amount / a.rate * b.rate AS converted FROM money m LEFT JOIN rates a ON a.currency = frm LEFT JOIN rates b ON b.currency = "to" """)
def _(spark, sf):
    return lookup.convert_currency(_money_rows(spark, sf), "amount", "frm", "to", dims.rates(spark)).select(
        "o_orderkey", "frm", "to", "converted"
    )


def rates_history(spark, sf):
    """Rates of the working days in the data, with a week missing every month."""
    d = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("rate_date")).distinct()
    d = d.where((F.weekday("rate_date") < 5) & ~F.dayofmonth("rate_date").between(10, 16))
    pairs = F.array(*[F.struct(F.lit(c).alias("currency"), F.lit(dims.RATES.get(c, 1.0)).alias("base")) for c in CODES])
    return d.select("rate_date", F.inline(pairs)).select(
        "rate_date", "currency", (F.col("base") * (1 + F.dayofyear("rate_date") % 10 / 1000.0)).alias("rate")
    )


HISTORY_SQL = f"""{_RATES_SQL}, days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS rate_date FROM orders
  WHERE isodow(o_orderdate) <= 5 AND day(o_orderdate) NOT BETWEEN 10 AND 16),
hist AS (SELECT rate_date, currency, rate * (1 + dayofyear(rate_date) % 10 / 1000.0e0) AS rate FROM days, rates)"""


@query("rates_asof", f"""WITH {HISTORY_SQL}, {_MONEY_SQL},
x AS (SELECT m.*, a.rate AS fr, a.rate_date AS fd FROM money m ASOF LEFT JOIN hist a ON a.currency = m.frm AND m.d >= a.rate_date),
y AS (SELECT x.*, b.rate AS tr, b.rate_date AS td FROM x ASOF LEFT JOIN hist b ON b.currency = x."to" AND x.d >= b.rate_date),
z AS (SELECT *, CASE WHEN fd IS NOT NULL AND td IS NOT NULL THEN least(fd, td) END AS o FROM y)
SELECT o_orderkey, amount / fr * tr AS converted, CAST(o AS VARCHAR) AS rate_date, date_diff('day', o, d) > 4 AS stale FROM z""")
def _(spark, sf):
    out = lookup.convert_asof(_money_rows(spark, sf), "d", "amount", "frm", "to", rates_history(spark, sf))
    return out.select("o_orderkey", "converted", "rate_date", "stale")


LENGTHS = [u for k, u, _ in dims.UNITS if k == "length"]
_UNITS_SQL = values("units", "kind, unit, size", dims.UNITS)
_MEASURES_SQL = f"""m AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS amount, {pick_sql('p_partkey', LENGTHS + ['furlong'])} AS frm,
  {pick_sql('(p_partkey // 9)', LENGTHS + ['kg'])} AS "to" FROM part)"""


def _measures(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("amount"), pick(F.col("p_partkey"), LENGTHS + ["furlong"]).alias("frm"),
        pick(F.floor(F.col("p_partkey") / 9), LENGTHS + ["kg"]).alias("to"),
    )


@query("unit_convert", f"""WITH {_UNITS_SQL}, {_MEASURES_SQL}
SELECT p_partkey, frm, "to", a.kind, amount * a.size / b.size AS converted FROM m LEFT JOIN units a ON a.unit = frm LEFT JOIN units b ON b.unit = "to" AND b.kind = a.kind""")
def _(spark, sf):
    return lookup.convert_units(_measures(spark, sf), "amount", "frm", "to", dims.units(spark)).drop("amount")


@query("unit_fanout", f"""WITH {_UNITS_SQL}, {_MEASURES_SQL}
SELECT p_partkey, frm, b.unit, amount * a.size / b.size AS value FROM m JOIN units a ON a.unit = frm JOIN units b ON b.kind = a.kind""")
def _(spark, sf):
    return lookup.all_units(_measures(spark, sf), "amount", "frm", dims.units(spark)).drop("amount", "to")


def _readings(spark, sf):
    part = table(spark, sf, "part")
    return part.select(
        "p_partkey", (F.col("p_size") * 25.0 - 600).alias("v"), pick(F.col("p_partkey"), ["c", "f", "k", "r", "x"]).alias("frm"),
        pick(F.floor(F.col("p_partkey") / 5), ["c", "f", "k", "r"]).alias("to"),
    )


@query("temperature_convert", "WITH " + values("scale", "id, off, k", [(n, o, k) for n, (o, k) in dims.SCALES.items()]) + f""",
m AS (SELECT p_partkey, p_size * 25.0e0 - 600 AS v, {pick_sql('p_partkey', ['c', 'f', 'k', 'r', 'x'])} AS frm, {pick_sql('(p_partkey // 5)', ['c', 'f', 'k', 'r'])} AS "to" FROM part)
SELECT p_partkey, frm, "to", round((v - a.off) * a.k / b.k + b.off, 6) AS converted, (v - a.off) * a.k < -273.15e0 - 1e-9 AS below_zero
FROM m LEFT JOIN scale a ON a.id = frm LEFT JOIN scale b ON b.id = "to" """)
def _(spark, sf):
    out = lookup.convert_temperature(_readings(spark, sf), "v", "frm", "to")
    return rounded(out.select("p_partkey", "frm", "to", "converted", "below_zero"), 6, "converted")


LAND = [u for u, _ in dims.AREA_UNITS] + ["bigha"]


@query("area_convert", "WITH " + values("area", "unit, sqft", dims.AREA_UNITS) + f""",
m AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS amount, {pick_sql('p_partkey', LAND)} AS frm, {pick_sql('(p_partkey // 11)', LAND)} AS "to",
  CASE p_partkey % 4 WHEN 1 THEN 1600.0e0 WHEN 2 THEN 2400.0e0 WHEN 3 THEN 2700.0e0 END * 9.0e0 AS bigha FROM part)
SELECT p_partkey, frm, "to", amount * CASE WHEN frm = 'bigha' THEN bigha ELSE a.sqft END / CASE WHEN "to" = 'bigha' THEN bigha ELSE b.sqft END AS converted
FROM m LEFT JOIN area a ON a.unit = frm LEFT JOIN area b ON b.unit = "to" """)
def _(spark, sf):
    k = F.col("p_partkey")
    rows = table(spark, sf, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("amount"), pick(k, LAND).alias("frm"), pick(F.floor(k / 11), LAND).alias("to")
    )
    size = F.when(k % 4 == 1, 1600.0).when(k % 4 == 2, 2400.0).when(k % 4 == 3, 2700.0)
    return lookup.convert_area(rows, "amount", "frm", "to", dims.area_units(spark), size).drop("amount")


@query("split_acre_guntha", """WITH a AS (SELECT p_partkey, CASE WHEN p_partkey % 50 < 40 THEN p_size + (p_partkey % 50) / 40.0e0 END AS acres FROM part)
SELECT p_partkey, acres, acres * 43560.0e0 AS sqft FROM a""")
def _(spark, sf):
    k = F.col("p_partkey")
    record = F.concat(F.col("p_size").cast("string"), F.when(k % 2 == 0, ".").otherwise("-"), F.lpad((k % 50).cast("string"), 2, "0"))
    rows = table(spark, sf, "part").select("p_partkey", lookup.acres_from_record(record).alias("acres"))
    return rows.withColumn("sqft", F.col("acres") * dims.ACRE_SQFT)


OTHER_UNITS = dims.SPEED_UNITS + dims.STORAGE_UNITS + dims.KITCHEN_UNITS
OTHER_NAMES = [u for _, u, _ in OTHER_UNITS]


@query("speed_storage_cooking_convert", "WITH " + values("units", "kind, unit, size", OTHER_UNITS) + f""",
m AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS amount, {pick_sql('p_partkey', OTHER_NAMES)} AS frm FROM part)
SELECT p_partkey, frm, b.unit, amount * a.size / b.size AS value, CASE WHEN a.kind = 'speed' THEN 16.666666666666668e0 / (amount * a.size) END AS pace
FROM m JOIN units a ON a.unit = frm JOIN units b ON b.kind = a.kind""")
def _(spark, sf):
    rows = table(spark, sf, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("amount"), pick(F.col("p_partkey"), OTHER_NAMES).alias("frm")
    )
    other = dims.units(spark, OTHER_UNITS)
    out = lookup.all_units(rows, "amount", "frm", other)
    speed = lookup.convert_units(rows.withColumn("to", F.lit("m/s")), "amount", "frm", "to", other)
    speed = speed.select("p_partkey", lookup.pace_minutes_per_km(F.col("converted")).alias("pace"))
    return out.join(speed, "p_partkey").select("p_partkey", "frm", "unit", "value", "pace")


@query("cooking_grams", "WITH " + values("units", "kind, unit, size", dims.KITCHEN_UNITS) + ", " + values("dens", "ingredient, density", dims.INGREDIENT_DENSITY) + f""",
m AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS amount, {pick_sql('p_partkey', [u for _, u, _ in dims.KITCHEN_UNITS])} AS unit,
  {pick_sql('(p_partkey // 7)', [i for i, _ in dims.INGREDIENT_DENSITY])} AS ingredient FROM part)
SELECT p_partkey, m.unit, m.ingredient, amount * size * 1000.0e0 * density AS grams FROM m JOIN units USING (unit) JOIN dens USING (ingredient)""")
def _(spark, sf):
    k = F.col("p_partkey")
    rows = table(spark, sf, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("amount"), pick(k, [u for _, u, _ in dims.KITCHEN_UNITS]).alias("unit"),
        pick(F.floor(k / 7), [i for i, _ in dims.INGREDIENT_DENSITY]).alias("ingredient"),
    )
    densities = dims.table(spark, dims.INGREDIENT_DENSITY, "ingredient string, density double")
    return lookup.kitchen_grams(rows, "amount", "unit", "ingredient", dims.units(spark, dims.KITCHEN_UNITS), densities).drop("amount")


# Nearest rows ---------------------------------------------------------------------

_CHART_ROWS = [(g, i, *map(float, r)) for g, chart in dims.SHOE_CHART.items() for i, r in enumerate(chart)]
_SHOES_SQL = values("chart", "grp, ord, uk, us, eu, cm", _CHART_ROWS) + """,
feet AS (SELECT p_partkey, CASE p_partkey % 2 WHEN 0 THEN 'men' ELSE 'women' END AS grp, (p_partkey % 64) / 4.0e0 AS size FROM part),
ranked AS (SELECT f.*, c.ord, c.uk, c.us, c.eu, c.cm, abs(c.uk - f.size) AS gap, row_number() OVER (PARTITION BY p_partkey ORDER BY abs(c.uk - f.size), c.ord) AS rn,
  min(c.uk) OVER (PARTITION BY p_partkey) AS lo, max(c.uk) OVER (PARTITION BY p_partkey) AS hi FROM feet f JOIN chart c USING (grp))"""


def _feet(spark, sf):
    k = F.col("p_partkey")
    return table(spark, sf, "part").select("p_partkey", F.when(k % 2 == 0, "men").otherwise("women").alias("grp"), ((k % 64) / 4.0).alias("size"))


@query("nearest_lookup", f"""WITH {_SHOES_SQL} SELECT p_partkey, grp, size, ord, uk, us, eu, cm, gap, size < lo OR size > hi AS off_chart, gap <= 0.01 AS exact FROM ranked WHERE rn = 1""")
def _(spark, sf):
    return lookup.nearest(_feet(spark, sf), "size", "grp", dims.shoe_chart(spark), "grp", "uk", "ord")


@query("neighbour_rows", f"""WITH {_SHOES_SQL} SELECT r.p_partkey, r.grp, r.ord, c.ord AS near_ord, c.us AS near_us, c.ord = r.ord AS is_match
FROM ranked r JOIN chart c ON c.grp = r.grp AND abs(c.ord - r.ord) <= 2 WHERE r.rn = 1""")
def _(spark, sf):
    chart = dims.shoe_chart(spark)
    hit = lookup.nearest(_feet(spark, sf), "size", "grp", chart, "grp", "uk", "ord").select("p_partkey", "grp", "ord")
    return lookup.neighbours(hit, chart, "grp", "grp", "ord").select("p_partkey", "grp", "ord", "near_ord", "near_us", "is_match")


@query("slab_join", "WITH " + values("slabs", "regime, lo, hi, rate", [(n, float(a), float(b), r) for n, s in dims.TAX_SLABS.items() for a, b, r in s]) + """,
c AS (SELECT c_custkey, greatest(c_acctbal, 0) * 400 AS income, CASE c_custkey % 2 WHEN 0 THEN 'new' ELSE 'old' END AS regime FROM customer)
SELECT c_custkey, regime, round(sum(greatest(0, least(income, hi) - lo) * rate), 2) AS tax FROM c JOIN slabs USING (regime) GROUP BY c_custkey, regime""")
def _(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey", (F.greatest(F.col("c_acctbal"), F.lit(0.0)) * 400).alias("income"),
        F.when(F.col("c_custkey") % 2 == 0, "new").otherwise("old").alias("regime"),
    )
    out = lookup.slab_join(rows, "income", "regime", dims.tax_slabs(spark))
    return rounded(out.select("c_custkey", "regime", "tax"), 2, "tax")


@query("reconcile_orphans", """SELECT doc_id, 'a' AS only_in FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id * 2 FROM labels)
UNION ALL SELECT doc_id, 'b' FROM (SELECT doc_id * 2 AS doc_id FROM labels EXCEPT SELECT doc_id FROM documents)""")
def _(spark, sf):
    listed = table(spark, sf, "labels").select((F.col("doc_id") * 2).alias("doc_id"))
    return lookup.orphans(table(spark, sf, "documents"), listed, "doc_id")


# Numbers --------------------------------------------------------------------------


@query("numeric_summary", """WITH c AS (SELECT event_type, value, count(*) AS n FROM events GROUP BY ALL),
m AS (SELECT event_type, max(n) AS peak FROM c GROUP BY ALL),
k AS (SELECT event_type, count(*) AS n_modes, min(value) AS lowest_mode, max(n) AS mode_count FROM c JOIN m USING (event_type) WHERE n = peak GROUP BY ALL)
SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean, round(max(value) - min(value), 6) AS spread, round(stddev_pop(value), 6) AS sd_pop,
  round(stddev_samp(value), 6) AS sd_samp, round(median(value), 6) AS median, any_value(n_modes) AS n_modes, any_value(lowest_mode) AS lowest_mode,
  any_value(mode_count) AS mode_count FROM events JOIN k USING (event_type) GROUP BY event_type""")
def _(spark, sf):
    out = corpus.numeric_summary(table(spark, sf, "events"), "value", ["event_type"])
    return rounded(out, 6, "mean", "spread", "sd_pop", "sd_samp", "median")


@query("modes", """WITH c AS (SELECT event_type, value, count(*) AS n FROM events GROUP BY ALL)
SELECT event_type, value, n FROM c QUALIFY n = max(n) OVER (PARTITION BY event_type)""")
def _(spark, sf):
    return corpus.modes(table(spark, sf, "events"), "value", ["event_type"])


# An approximate quartile is right if its rank is off by at most one part in the accuracy.
@query("approx_quartiles", "SELECT event_type, true AS q1_good, true AS q2_good, true AS q3_good FROM events GROUP BY event_type")
def _(spark, sf):
    events, accuracy, wanted = table(spark, sf, "events"), 1000, (0.25, 0.5, 0.75)
    found = events.groupBy("event_type").agg(F.percentile_approx("value", list(wanted), accuracy).alias("q"), F.count("value").alias("n"))
    ranked = events.join(found, "event_type").groupBy("event_type", "n").agg(
        *[F.count(F.when(F.col("value") < F.col("q")[i], 1)).alias(f"under{i}") for i in range(3)],
        *[F.count(F.when(F.col("value") <= F.col("q")[i], 1)).alias(f"upto{i}") for i in range(3)],
    )
    slack = F.col("n") / accuracy + 1
    return ranked.select("event_type", *[
        ((F.col(f"under{i}") <= p * F.col("n") + slack) & (F.col(f"upto{i}") >= p * F.col("n") - slack)).alias(f"q{i + 1}_good")
        for i, p in enumerate(wanted)
    ])


_REVENUE = "sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))))"


def _revenue():
    return F.col("l_extendedprice").cast("decimal(18,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))


@query("share_of_total", f"""WITH t AS (SELECT l_returnflag, l_linestatus, CAST({_REVENUE} AS DOUBLE) AS amount FROM lineitem GROUP BY ALL)
SELECT l_returnflag, l_linestatus, amount, round(amount * 100.0 / sum(amount) OVER (PARTITION BY l_returnflag), 6) AS share_pct FROM t""")
def _(spark, sf):
    out = corpus.share_of_total(table(spark, sf, "lineitem"), _revenue(), ["l_returnflag", "l_linestatus"], ["l_returnflag"])
    return rounded(out, 6, "share_pct")


@query("share_of_grand_total", f"""WITH t AS (SELECT l_suppkey, CAST({_REVENUE} AS DOUBLE) AS amount FROM lineitem GROUP BY ALL)
SELECT l_suppkey, amount, round(amount * 100.0 / (SELECT sum(amount) FROM t), 6) AS share_pct FROM t""")
def _(spark, sf):
    return rounded(corpus.share_of_total(table(spark, sf, "lineitem"), _revenue(), ["l_suppkey"]), 6, "share_pct")


@query("percent_change", """WITH m AS (SELECT o_orderstatus, strftime(o_orderdate, '%Y-%m') AS month, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM orders GROUP BY ALL),
l AS (SELECT *, lag(amount) OVER (PARTITION BY o_orderstatus ORDER BY month) AS before FROM m)
SELECT o_orderstatus, month, amount, round((amount - before) * 100.0 / nullif(abs(before), 0), 4) AS change_pct, amount * 18 / 100 AS eighteen_pct FROM l""")
def _(spark, sf):
    monthly = table(spark, sf, "orders").groupBy("o_orderstatus", F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("amount")
    )
    # One row per status and month by now, so the window is small whatever the data.
    w = Window.partitionBy("o_orderstatus").orderBy("month")
    change = corpus.pct_change(F.lag("amount").over(w), F.col("amount"))
    out = monthly.withColumn("change_pct", change).withColumn("eighteen_pct", corpus.pct_of(F.lit(18.0), F.col("amount")))
    return rounded(out, 4, "change_pct")


_WEIGHTS = [(u, s) for k, u, s in dims.UNITS if k == "weight"]


@query("unit_price_rank", "WITH " + values("w", "unit, size", _WEIGHTS) + f""",
p AS (SELECT p_brand, p_partkey, p_retailprice, p_size * size AS q FROM part JOIN w ON unit = {pick_sql('p_partkey', [u for u, _ in _WEIGHTS])})
SELECT p_brand, p_partkey, p_retailprice / q AS unit_price, p_retailprice / q = min(p_retailprice / q) OVER (PARTITION BY p_brand) AS cheapest,
  q = max(q) OVER (PARTITION BY p_brand) AS biggest, rank() OVER (PARTITION BY p_brand ORDER BY p_retailprice / q) AS rank FROM p""")
def _(spark, sf):
    size = F.element_at(F.create_map(*[x for u, s in _WEIGHTS for x in (F.lit(u), F.lit(s))]), pick(F.col("p_partkey"), [u for u, _ in _WEIGHTS]))
    return corpus.unit_price(table(spark, sf, "part"), "p_brand", "p_partkey", F.col("p_retailprice"), F.col("p_size") * size)


@query("category_counts", """WITH live AS (SELECT p_type, count(*) AS live FROM part GROUP BY 1), plan(p_type, planned) AS (VALUES ('ECONOMY', 900), ('SMALL', 20), ('GIANT', 7)),
b AS (SELECT coalesce(l.p_type, p.p_type) AS p_type, coalesce(live, 0) AS live, coalesce(planned, 0) AS planned FROM live l FULL JOIN plan p ON l.p_type = p.p_type)
SELECT p_type, CAST(grouping(p_type) AS BIGINT) AS is_total, CAST(sum(live) AS BIGINT) AS live, CAST(sum(planned) AS BIGINT) AS planned,
  CAST(sum(planned) - sum(live) AS BIGINT) AS remaining FROM b GROUP BY ROLLUP (p_type)""")
def _(spark, sf):
    plan = dims.table(spark, [("ECONOMY", 900), ("SMALL", 20), ("GIANT", 7)], "p_type string, planned bigint")
    return corpus.category_counts(table(spark, sf, "part"), "p_type", plan)


# Events ---------------------------------------------------------------------------


@query("longest_streak", """WITH e AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos,
  row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS own FROM events),
r AS (SELECT user_id, event_type, pos - own AS g, count(*) AS length, min(pos) AS starts_at FROM e GROUP BY ALL)
SELECT user_id, event_type, length, starts_at FROM r QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY length DESC, starts_at) = 1""")
def _(spark, sf):
    return lines.longest_streak(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], "event_type")


@query("laps", """SELECT user_id, event_id, row_number() OVER w AS lap_no, coalesce(epoch_us(ts) - lag(epoch_us(ts)) OVER w, 0) AS lap_us,
  epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id) AS total_us FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def _(spark, sf):
    return lines.laps(table(spark, sf, "events"), ["user_id"], "ts", "event_id")


@query("session_laps", """WITH l AS (SELECT user_id, event_id, ts, epoch_us(ts) - lag(epoch_us(ts)) OVER w AS lap FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(CASE WHEN lap IS NULL OR lap >= 1800000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session_no FROM l)
SELECT user_id, CAST(session_no AS BIGINT) AS session_no, count(*) AS events, CAST(coalesce(sum(CASE WHEN lap < 1800000000 THEN lap END), 0) AS BIGINT) AS length_us,
  max(CASE WHEN lap < 1800000000 THEN lap END) AS longest_lap_us FROM s GROUP BY user_id, session_no""")
def _(spark, sf):
    return lines.session_laps(table(spark, sf, "events"), ["user_id"], "ts", "event_id")


@query("check_sorted", """WITH s AS (SELECT p_brand, p_partkey, p_name, lag(lower(p_name)) OVER w AS previous_key, row_number() OVER w AS place,
  row_number() OVER (PARTITION BY p_brand ORDER BY lower(p_name), p_partkey) AS belongs_at FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_partkey))
SELECT * FROM s WHERE lower(p_name) < previous_key""")
def _(spark, sf):
    rows = table(spark, sf, "part").select("p_brand", "p_partkey", "p_name")
    return lines.order_violations(rows, ["p_brand"], "p_name", ["p_partkey"])


_BROKEN = "CASE WHEN event_id % 7 = 0 THEN substr(props, 1, length(props) - 1) WHEN event_id % 11 = 0 THEN 'not json' ELSE props END"


def _props(spark, sf):
    broken = F.when(F.col("event_id") % 7 == 0, F.expr("substr(props, 1, length(props) - 1)")).when(F.col("event_id") % 11 == 0, "not json")
    return table(spark, sf, "events").select("event_id", "event_type", broken.otherwise(F.col("props")).alias("props"))


@query("json_audit", f"""SELECT event_type, count(*) FILTER (json_valid({_BROKEN})) AS valid, count(*) FILTER (NOT json_valid({_BROKEN})) AS invalid FROM events GROUP BY 1""")
def _(spark, sf):
    return corpus.json_audit(_props(spark, sf), "props", ("event_type",))


@query("json_quarantine", f"""SELECT event_id, event_type, {_BROKEN} AS props FROM events WHERE NOT json_valid({_BROKEN})""")
def _(spark, sf):
    return corpus.json_quarantine(_props(spark, sf), "props")
