"""Queries over orders, customers and line items seen as loans, deposits, pay and invoices."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith import dims
from rowsmith.functions import money as M
from rowsmith.operators import money
from rowsmith.plans.registry import query, rounded, table


def _loans(spark, sf):
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        k.alias("loan_id"), F.col("o_totalprice").alias("principal"),
        F.when(k % 97 == 0, 0.0).otherwise(6 + (k % 90) / 10.0).alias("annual_rate"), (1 + k % 30).alias("years"),
    )


_LOANS = """loans AS (SELECT o_orderkey AS loan_id, o_totalprice AS principal, CASE WHEN o_orderkey % 97 = 0 THEN 0.0e0 ELSE 6 + (o_orderkey % 90) / 10.0e0 END AS annual_rate,
  1 + o_orderkey % 30 AS years FROM orders)"""
_EMI = "CASE WHEN {r} = 0 THEN {p} / ({n}) ELSE {p} * ({r} / 1200.0e0) * pow(1 + {r} / 1200.0e0, {n}) / (pow(1 + {r} / 1200.0e0, {n}) - 1) END"
_LOAN_EMI = _EMI.format(r="annual_rate", p="principal", n="years * 12")
_E = f"{_LOANS}, e AS (SELECT *, years * 12 AS n, annual_rate / 1200.0e0 AS r, {_LOAN_EMI} AS emi FROM loans)"


@query("loan_emi", f"""WITH {_E} SELECT loan_id, n AS months, round(emi, 2) AS emi, round(emi * n, 2) AS total, round(emi * n - principal, 2) AS interest,
  round(principal * 100.0 / (emi * n), 4) AS principal_pct, CASE WHEN principal <= 0 THEN 'amount must be above zero' END AS finding FROM e""")
def _(spark, sf):
    out = rounded(money.loan_emi(_loans(spark, sf)), 2, "emi", "total", "interest")
    return rounded(out, 4, "principal_pct").select("loan_id", "months", "emi", "total", "interest", "principal_pct", "finding")


_BAL = "CASE WHEN {k} >= n THEN 0 WHEN r = 0 THEN principal - emi * {k} ELSE principal * pow(1 + r, {k}) - emi * (pow(1 + r, {k}) - 1) / r END"
_YEARLY = f"""{_E}, y AS (SELECT *, unnest(range(1, years + 1)) AS year FROM e),
b AS (SELECT *, {_BAL.format(k='((year - 1) * 12)')} AS b0, {_BAL.format(k='(year * 12)')} AS b1 FROM y)"""


@query("amortise_yearly", f"WITH {_YEARLY} SELECT loan_id, year, round(b0 - b1, 2) AS repaid, round(emi * 12 - (b0 - b1), 2) AS interest, round(b1, 2) AS balance FROM b")
def _(spark, sf):
    return rounded(money.amortise(_loans(spark, sf), "loan_id"), 2, "repaid", "interest", "balance")


@query("amortise_book", f"""WITH {_YEARLY} SELECT year, count(*) AS loans, round(sum(b0 - b1), 1) AS repaid, round(sum(emi * 12 - (b0 - b1)), 1) AS interest, round(sum(b1), 1) AS balance FROM b GROUP BY year""")
def _(spark, sf):
    return rounded(money.amortise_rollup(_loans(spark, sf), "loan_id"), 1, "repaid", "interest", "balance")


# Checked against a month-by-month walk, which shares no formula with the closed form.
@query("amortise_monthly_totals", f"""WITH RECURSIVE {_E},
w AS (SELECT loan_id, r, emi, n, CAST(0 AS BIGINT) AS month, CAST(principal AS DOUBLE) AS owed, CAST(0 AS DOUBLE) AS interest FROM e
  UNION ALL SELECT loan_id, r, emi, n, month + 1, CASE WHEN month + 1 = n THEN 0 ELSE owed - (emi - owed * r) END, owed * r FROM w WHERE month < n)
SELECT month, count(*) AS loans, round(sum(interest), 0) AS interest, round(sum(owed), 0) AS balance FROM w WHERE month > 0 GROUP BY month""")
def _(spark, sf):
    monthly = money.amortise(_loans(spark, sf), "loan_id", "month")
    out = monthly.groupBy("month").agg(F.count(F.lit(1)).alias("loans"), F.sum("interest").alias("interest"), F.sum("balance").alias("balance"))
    return rounded(out, 0, "interest", "balance")


_RATES, _YEARS = [8.0, 8.5, 9.0], [15, 20, 25]


@query("rate_tenure_grid", f"""WITH {_LOANS}, g AS (SELECT loan_id, principal, rate AS annual_rate, y AS years FROM loans, (VALUES (8.0e0), (8.5e0), (9.0e0)) a(rate), (VALUES (15), (20), (25)) b(y)),
e AS (SELECT *, {_LOAN_EMI} AS emi FROM g) SELECT loan_id, annual_rate, CAST(years AS BIGINT) AS years, round(emi, 2) AS emi, round(emi * years * 12 - principal, 2) AS interest FROM e""")
def _(spark, sf):
    out = money.rate_tenure_grid(_loans(spark, sf), "loan_id", _RATES, _YEARS)
    return rounded(out, 2, "emi", "interest").drop("principal")


# Checked against a month-by-month walk with the extra instalment paid after every twelfth month.
@query("prepay_effect", f"""WITH RECURSIVE {_E},
w AS (SELECT loan_id, r, emi, CAST(0 AS BIGINT) AS month, CAST(principal AS DOUBLE) AS owed, CAST(0 AS DOUBLE) AS paid FROM e
  UNION ALL SELECT loan_id, r, emi, month + 1,
    CASE WHEN owed * (1 + r) - emi <= 0.005 THEN 0 WHEN (month + 1) % 12 = 0 THEN owed * (1 + r) - emi - least(emi, owed * (1 + r) - emi) ELSE owed * (1 + r) - emi END,
    paid + CASE WHEN owed * (1 + r) - emi <= 0.005 THEN owed * (1 + r) WHEN (month + 1) % 12 = 0 THEN emi + least(emi, owed * (1 + r) - emi) ELSE emi END
  FROM w WHERE owed > 0.005),
l AS (SELECT loan_id, max(month) AS months_needed, max(paid) AS paid FROM w GROUP BY loan_id)
SELECT loan_id, months_needed, round(paid - principal, 1) AS interest, round(emi * n - paid, 1) AS interest_saved FROM l JOIN e USING (loan_id)""")
def _(spark, sf):
    out = money.prepay_effect(_loans(spark, sf)).select("loan_id", "months_needed", "interest", "interest_saved")
    return rounded(out, 1, "interest", "interest_saved")


@query("flat_vs_reducing", f"""WITH {_E}, f AS (SELECT *, (principal + principal * annual_rate * years / 100.0e0) / n AS flat FROM e)
SELECT loan_id, round(flat, 2) AS flat_instalment, round(emi, 2) AS reducing_instalment, round((flat - emi) * n, 2) AS flat_costs_more FROM f""")
def _(spark, sf):
    cols = ["flat_instalment", "reducing_instalment", "flat_costs_more"]
    return rounded(money.flat_vs_reducing(_loans(spark, sf)).select("loan_id", *cols), 2, *cols)


# Checked by putting the rate back into the instalment formula.
@query("equivalent_rate", f"""WITH {_E}, f AS (SELECT loan_id, round((principal + principal * annual_rate * years / 100.0e0) / n, 2) AS flat_instalment FROM e)
SELECT loan_id, flat_instalment, flat_instalment AS at_that_rate FROM f""")
def _(spark, sf):
    p, y = F.col("principal"), F.col("years")
    rows = money.flat_vs_reducing(_loans(spark, sf)).withColumn("rate", M.rate_for_emi(p, F.col("flat_instalment"), y * 12))
    out = rows.withColumn("at_that_rate", M.emi(p, F.col("rate"), y * 12))
    return rounded(out.select("loan_id", "flat_instalment", "at_that_rate"), 2, "flat_instalment", "at_that_rate")


def _deposits(spark, sf, period="period"):
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        k.alias("id"), (F.col("o_totalprice") - 20000).alias("principal"), (k % 120 / 10.0 - 1).alias("rate"),
        (k % 700).cast("double").alias(period),
    )


_DEPOSITS = "d AS (SELECT o_orderkey AS id, o_totalprice - 20000 AS principal, o_orderkey % 120 / 10.0e0 - 1 AS rate, CAST(o_orderkey % 700 AS DOUBLE) AS period FROM orders)"
_SI = "greatest(0, principal) * greatest(0, rate) * greatest(0, period / {u}) / 100"


@query("simple_interest", f"""WITH {_DEPOSITS}, i AS (SELECT id, principal, {_SI.format(u='12.0e0')} AS m, {_SI.format(u='365.0e0')} AS d FROM d)
SELECT id, m AS by_months, d AS by_days, greatest(0, principal) + m AS amount FROM i""")
def _(spark, sf):
    rows = money.simple_interest(_deposits(spark, sf), "months").withColumnRenamed("interest", "by_months")
    by_days = M.simple_interest(F.col("principal"), F.col("rate"), M.period_years(F.col("period"), "days"))
    return rows.withColumn("by_days", by_days).select("id", "by_months", "by_days", "amount")


@query("simple_interest_schedule", f"""WITH {_DEPOSITS}, t AS (SELECT id, greatest(0, principal) AS p, greatest(0, principal) * greatest(0, rate) / 100 AS py, period / 12.0e0 AS t FROM d WHERE period > 0 AND principal > 0),
y AS (SELECT *, unnest(range(1, CAST(ceil(t) AS BIGINT) + 1)) AS year FROM t)
SELECT id, year, year > t AS part_year, py * least(1, t - (year - 1)) AS interest, p + py * least(year, t) AS balance FROM y""")
def _(spark, sf):
    return money.simple_interest_schedule(_deposits(spark, sf), "id", "months")


def _fds(spark, sf):
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        k.alias("id"), F.col("o_totalprice").alias("principal"), (5 + k % 40 / 10.0).alias("rate"), (1 + k % 20).alias("years")
    )


@query("compound_growth", """WITH d AS (SELECT o_orderkey AS id, o_totalprice AS principal, 5 + o_orderkey % 40 / 10.0e0 AS rate, 1 + o_orderkey % 20 AS years FROM orders)
SELECT id, round(principal + principal * rate * years / 100, 2) AS simple_amount, round(principal * pow(1 + rate / 400.0e0, years * 4), 2) AS compound_amount,
  round((pow(1 + rate / 400.0e0, 4) - 1) * 100, 6) AS effective_pct, round(ln(2.0e0) / (4 * ln(1 + rate / 400.0e0)), 6) AS doubling_years,
  round(((1 + rate / 100.0e0) / 1.06e0 - 1) * 100, 6) AS real_pct, round(((1 + rate * 0.7e0 / 100.0e0) / 1.06e0 - 1) * 100, 6) AS real_after_tax_pct FROM d""")
def _(spark, sf):
    out = money.compound_growth(_fds(spark, sf), 4, 6.0, 30.0).drop("principal", "rate", "years")
    out = rounded(out, 2, "simple_amount", "compound_amount")
    return rounded(out, 6, "effective_pct", "doubling_years", "real_pct", "real_after_tax_pct")


_SIP_PLAIN = "m * CASE WHEN i = 0 THEN n ELSE (1 + i) * (pow(1 + i, n) - 1) / i END"


# The step-up is checked year by year in a list instead of by the geometric sum.
@query("sip_value", f"""WITH s AS (SELECT c_custkey AS id, 500.0e0 * (1 + c_custkey % 20) AS m, c_custkey % 15 AS rate, 1 + c_custkey % 30 AS years FROM customer),
p AS (SELECT *, rate / 1200.0e0 AS i, years * 12 AS n, range(1, years + 1) AS ys FROM s),
f AS (SELECT *, m * CASE WHEN i = 0 THEN 12 ELSE (1 + i) * (pow(1 + i, 12) - 1) / i END AS one FROM p)
SELECT id, m * 12 * years AS paid_in, round({_SIP_PLAIN}, 2) AS value, round(list_sum(list_transform(ys, lambda y: m * 12 * pow(1.1e0, y - 1))), 2) AS stepped_paid_in,
  round(list_sum(list_transform(ys, lambda y: one * pow(1.1e0, y - 1) * pow(1 + i, 12 * (years - y)))), 2) AS stepped_value FROM f""")
def _(spark, sf):
    k = F.col("c_custkey")
    rows = table(spark, sf, "customer").select(
        k.alias("id"), (500.0 * (1 + k % 20)).alias("monthly"), (k % 15).cast("double").alias("rate"), (1 + k % 30).alias("years")
    )
    return rounded(money.sip(rows, 10.0).drop("monthly", "rate", "years"), 2, "value", "stepped_paid_in", "stepped_value")


@query("sip_needed", """WITH s AS (SELECT o_orderkey AS id, o_totalprice * 100 AS target, 8 + o_orderkey % 8 AS rate, 5 + o_orderkey % 25 AS years FROM orders)
SELECT id, round(target / ((1 + rate / 1200.0e0) * (pow(1 + rate / 1200.0e0, years * 12) - 1) / (rate / 1200.0e0)), 2) AS monthly FROM s""")
def _(spark, sf):
    k = F.col("o_orderkey")
    needed = M.sip_needed(F.col("o_totalprice") * 100, (8 + k % 8).cast("double"), 5 + k % 25)
    return table(spark, sf, "orders").select(k.alias("id"), F.round(needed, 2).alias("monthly"))


# Invoices -------------------------------------------------------------------------


def _sales(spark, sf):
    """Line items with the seller's and the buyer's state. Only the needed columns are joined."""
    lines = table(spark, sf, "lineitem")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    buyers = table(spark, sf, "customer").select(F.col("c_custkey"), F.col("c_nationkey").alias("buyer_state"))
    sellers = table(spark, sf, "supplier").select(F.col("s_suppkey"), F.col("s_nationkey").alias("seller_state"))
    rate = F.element_at(F.array(F.lit(0), F.lit(5), F.lit(18), F.lit(40)), (F.col("l_partkey") % 4 + 1).cast("int"))
    joined = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(buyers, F.col("o_custkey") == F.col("c_custkey")).join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    same = F.col("seller_state") == F.col("buyer_state")
    return money.gst(
        joined.withColumn("rate", rate).withColumn("same_state", same), F.col("l_extendedprice"), F.col("rate"),
        F.col("l_partkey") % 3 == 0, F.col("same_state"), F.col("l_discount"),
    )


_SALES = """s AS (SELECT l.*, c_nationkey AS buyer_state, s_nationkey AS seller_state, c_nationkey = s_nationkey AS same_state, [0, 5, 18, 40][CAST(l_partkey % 4 AS INTEGER) + 1] AS rate,
  CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(6,4))), 2) AS DECIMAL(18,2)) AS net
  FROM lineitem l JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey),
p AS (SELECT *, CAST(net * 100 AS BIGINT) AS np FROM s),
b AS (SELECT *, CASE WHEN l_partkey % 3 = 0 THEN (np * 200 + 100 + rate) // (2 * (100 + rate)) ELSE np END AS bp FROM p),
t AS (SELECT *, CASE WHEN l_partkey % 3 = 0 THEN np - bp ELSE (bp * rate * 2 + 100) // 200 END AS tp FROM b),
g AS (SELECT *, CASE WHEN same_state THEN tp // 2 ELSE 0 END AS cp, CASE WHEN same_state THEN tp - tp // 2 ELSE 0 END AS sp, CASE WHEN same_state THEN 0 ELSE tp END AS ip FROM t)"""


# Checked in whole paise.
@query("gst_split", f"""WITH {_SALES}
SELECT seller_state, buyer_state, count(*) AS n, CAST(sum(bp) AS BIGINT) / 100 AS base, CAST(sum(cp) AS BIGINT) / 100 AS cgst, CAST(sum(sp) AS BIGINT) / 100 AS sgst,
  CAST(sum(ip) AS BIGINT) / 100 AS igst, CAST(sum(bp + tp) AS BIGINT) / 100 AS bill_total FROM g GROUP BY seller_state, buyer_state""")
def _(spark, sf):
    names = ["base", "cgst", "sgst", "igst", "bill_total"]
    return _sales(spark, sf).groupBy("seller_state", "buyer_state").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in names]
    )


def _shown(spark, sf):
    """Invoice lines as printed, some of them wrong."""
    k = F.col("l_orderkey")
    lines = _sales(spark, sf).select("l_orderkey", "l_linenumber", "base", "rate", "cgst", "sgst", "igst", "same_state")
    cents = F.lit("1.00").cast("decimal(18,2)")
    lines = lines.withColumn("cgst", (F.col("cgst") + F.when(k % 50 == 0, cents).otherwise(F.lit("0.00").cast("decimal(18,2)"))).cast("decimal(18,2)"))
    return lines


@query("invoice_check", f"""WITH {_SALES}, x AS (SELECT l_orderkey, l_linenumber, bp, rate, cp + CASE WHEN l_orderkey % 50 = 0 THEN 100 ELSE 0 END AS cp, sp, ip, same_state FROM g),
f AS (SELECT l_orderkey, l_linenumber, unnest([
  CASE WHEN abs((cp + sp + ip) * 100 - bp * rate) > 200 THEN 'tax is not base times rate' END,
  CASE WHEN (cp <> 0 OR sp <> 0) AND ip <> 0 THEN 'both kinds of tax on one line' END,
  CASE WHEN same_state AND ip <> 0 THEN 'IGST inside one state' END,
  CASE WHEN NOT same_state AND (cp <> 0 OR sp <> 0) THEN 'CGST or SGST across states' END,
  CASE WHEN abs(cp - sp) > 2 THEN 'CGST and SGST differ' END]) AS finding FROM x)
SELECT finding, count(*) AS n, count(DISTINCT l_orderkey) AS invoices FROM f WHERE finding IS NOT NULL GROUP BY finding""")
def _(spark, sf):
    found = money.invoice_line_findings(_shown(spark, sf), ["l_orderkey", "l_linenumber"])
    return found.groupBy("finding").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("l_orderkey").alias("invoices"))


@query("invoice_totals", f"""WITH {_SALES}, x AS (SELECT l_orderkey, CAST(sum(bp + tp) AS BIGINT) AS true_total, count(*) AS n FROM g GROUP BY l_orderkey)
SELECT l_orderkey, n AS n_lines, true_total / 100 AS lines_total, (true_total + 5) / 100 AS printed_total, 0.05e0 AS gap FROM x WHERE l_orderkey % 10 = 0 AND 5 > n""")
def _(spark, sf):
    lines = _sales(spark, sf)
    true_total = lines.groupBy("l_orderkey").agg(F.sum(F.col("base") + F.col("tax")).alias("t"))
    off = F.when(F.col("l_orderkey") % 10 == 0, F.lit("0.05").cast("decimal(18,2)")).otherwise(F.lit("0.00").cast("decimal(18,2)"))
    headers = true_total.select("l_orderkey", (F.col("t") + off).alias("printed_total"))
    out = money.invoice_totals(lines, headers, "l_orderkey", 0.01)
    return out.select("l_orderkey", "n_lines", "lines_total", "printed_total", "gap")


@query("stacked_discount", """WITH p AS (SELECT p_partkey, p_retailprice AS price, [p_partkey % 60, p_size, 10] AS offers FROM part),
s AS (SELECT *, price * (1 - offers[1] / 100.0e0) * (1 - offers[2] / 100.0e0) * (1 - offers[3] / 100.0e0) AS sale FROM p)
SELECT p_partkey, round(sale, 4) AS sale_price, round(price - sale, 4) AS saving, round((price - sale) * 100 / price, 6) AS combined_pct FROM s""")
def _(spark, sf):
    offers = F.array((F.col("p_partkey") % 60).cast("double"), F.col("p_size").cast("double"), F.lit(10.0))
    out = money.stacked_discount(table(spark, sf, "part"), "p_retailprice", offers)
    return rounded(rounded(out, 4, "sale_price", "saving"), 6, "combined_pct").select("p_partkey", "sale_price", "saving", "combined_pct")


@query("margin_markup", """WITH x AS (SELECT p_brand, CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(l_quantity AS DECIMAL(18,2)) * CAST(p_retailprice AS DECIMAL(18,2)) AS cost
  FROM lineitem JOIN part ON l_partkey = p_partkey), s AS (SELECT p_brand, CAST(sum(price) AS DOUBLE) AS revenue, CAST(sum(cost) AS DOUBLE) AS cost FROM x GROUP BY 1)
SELECT p_brand, revenue, cost, round(revenue - cost, 4) AS profit, round((revenue - cost) * 100 / revenue, 6) AS margin_pct, round((revenue - cost) * 100 / cost, 6) AS markup_pct FROM s""")
def _(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice")
    sold = table(spark, sf, "lineitem").select("l_partkey", "l_extendedprice", "l_quantity").join(part, F.col("l_partkey") == F.col("p_partkey"))
    money2 = lambda c: F.col(c).cast("decimal(18,2)")
    out = money.margin_by(sold, money2("l_extendedprice"), money2("l_quantity") * money2("p_retailprice"), ["p_brand"])
    return rounded(rounded(out, 4, "profit"), 6, "margin_pct", "markup_pct")


@query("price_for_margin", "SELECT p_partkey, p_retailprice / nullif(1 - (p_partkey % 101) / 100.0e0, 0) AS price FROM part")
def _(spark, sf):
    pct = (F.col("p_partkey") % 101).cast("double")
    return table(spark, sf, "part").select("p_partkey", money.price_for_margin(F.col("p_retailprice"), pct).alias("price"))


_TRIPS = """t AS (SELECT event_id, value - 2 AS distance, CAST(user_id % 16 AS DOUBLE) AS mileage, 105.0e0 AS price, user_id % 5 AS people, 22 AS trips, event_id % 2 = 0 AS ret FROM events),
k AS (SELECT *, CASE WHEN distance < 0 THEN 'distance, price and trips cannot be below zero' WHEN people < 1 THEN 'at least one person pays' END AS bad FROM t),
l AS (SELECT *, CASE WHEN bad IS NULL THEN distance * CASE WHEN ret THEN 2 ELSE 1 END END AS km FROM k),
m AS (SELECT *, CASE WHEN bad IS NULL THEN CASE WHEN mileage > 0 THEN km / mileage ELSE 0 END END AS litres FROM l)"""


@query("trip_cost", f"""WITH {_TRIPS} SELECT event_id, km, litres, litres * price AS trip, CASE WHEN bad IS NULL THEN CASE WHEN km > 0 THEN litres * price / km ELSE 0 END END AS per_km,
  litres * price / nullif(people, 0) AS per_person, litres * price * trips AS month, litres * price * trips * 12 AS year,
  coalesce(bad, CASE WHEN mileage <= 0 THEN 'mileage must be above zero' END) AS finding FROM m""")
def _(spark, sf):
    u = F.col("user_id")
    trips = table(spark, sf, "events").select(
        "event_id", (F.col("value") - 2).alias("distance"), (u % 16).cast("double").alias("mileage"), F.lit(105.0).alias("price"),
        (u % 5).alias("people"), F.lit(22).alias("trips"), (F.col("event_id") % 2 == 0).alias("return_trip"),
    )
    out = money.trip_cost(trips)
    return out.select("event_id", "km", "litres", "trip", "per_km", "per_person", "month", "year", "finding")


# Tax and pay ----------------------------------------------------------------------


def _slabs_sql(regime: str, x: str) -> str:
    return " + ".join(f"greatest(0, least({x}, {hi}e0) - {lo}e0) * {rate}e0" if hi < dims.TOP else f"greatest(0, {x} - {lo}e0) * {rate}e0" for lo, hi, rate in dims.TAX_SLABS[regime])


@query("income_tax", f"""WITH c AS (SELECT c_custkey, greatest(0, c_acctbal) * 400 AS salary, (c_custkey % 5) * 100000.0e0 AS ded FROM customer),
x AS (SELECT *, greatest(0, salary - 75000) AS tn, greatest(0, salary - 50000 - ded) AS told FROM c),
t AS (SELECT *, least({_slabs_sql('new', 'tn')}, greatest(0, tn - 1200000)) * 1.04e0 AS a, ({_slabs_sql('old', 'told')}) * 1.04e0 AS b FROM x)
SELECT c_custkey, round(a, 2) AS tax_new, round(b, 2) AS tax_old, round(abs(a - b), 2) AS saving, CASE WHEN b < a THEN 'old' ELSE 'new' END AS cheaper FROM t""")
def _(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey", (F.greatest(F.lit(0.0), F.col("c_acctbal")) * 400).alias("salary"), ((F.col("c_custkey") % 5) * 100000.0).alias("deductions")
    )
    out = money.tax_comparison(rows, "salary", "deductions").drop("salary", "deductions")
    return rounded(out, 2, "tax_new", "tax_old", "saving")


_PAY = """p AS (SELECT c_custkey, greatest(0, c_acctbal) * 400 AS ctc, 30 + (c_custkey % 3) * 10 AS pct, c_custkey % 2 = 0 AS metro, c_custkey % 4 = 0 AS capped FROM customer),
b AS (SELECT *, ctc * pct / 100.0e0 AS basic FROM p),
h AS (SELECT *, basic * CASE WHEN metro THEN 0.5e0 ELSE 0.4e0 END AS hra, CASE WHEN capped THEN least(basic * 0.12e0, 21600) ELSE basic * 0.12e0 END AS pf, basic * 0.0481e0 AS gratuity FROM b)"""


def _pay(spark, sf):
    k = F.col("c_custkey")
    rows = table(spark, sf, "customer").select(k, (F.greatest(F.lit(0.0), F.col("c_acctbal")) * 400).alias("ctc"))
    return money.salary_breakup(rows, "ctc", 30 + k % 3 * 10, k % 2 == 0, k % 4 == 0)


@query("salary_breakup", f"""WITH {_PAY} SELECT c_custkey, round(basic, 4) AS basic, round(hra, 4) AS hra, round(pf, 4) AS pf, round(gratuity, 4) AS gratuity,
  round(ctc - basic - hra - pf - gratuity, 4) AS special, round((ctc - 2 * pf - gratuity - 2400) / 12, 4) AS in_hand_month FROM h""")
def _(spark, sf):
    names = ["basic", "hra", "pf", "gratuity", "special", "in_hand_month"]
    return rounded(_pay(spark, sf).select("c_custkey", *names), 4, *names)


@query("salary_components", f"""WITH {_PAY}, r AS (SELECT c_custkey, basic, hra, ctc - basic - hra - pf - gratuity AS special, pf, gratuity FROM h)
SELECT c_custkey, component, round(amount, 4) AS amount FROM (UNPIVOT r ON basic, hra, special, pf, gratuity INTO NAME component VALUE amount)""")
def _(spark, sf):
    return rounded(money.salary_components(_pay(spark, sf), "c_custkey"), 4, "amount")


_SPLIT_KEYS = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]


@query("allocate_by_ratio", """WITH i AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax, l_shipdate, CAST(l_quantity AS BIGINT) AS w, CAST(round(o_totalprice * 100) AS BIGINT) AS amt FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
s AS (SELECT *, sum(w) OVER (PARTITION BY l_orderkey) AS tw FROM i), f AS (SELECT *, amt * w // tw AS fl, amt * w % tw AS rest FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY rest DESC, l_linenumber, l_partkey, l_suppkey, w, l_extendedprice, l_discount, l_tax, l_shipdate) AS place, amt - sum(fl) OVER (PARTITION BY l_orderkey) AS spare FROM f)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(fl + CASE WHEN place <= spare THEN 1 ELSE 0 END AS BIGINT) AS share_paise FROM r""")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("amount"))
    items = table(spark, sf, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    items = items.withColumn("l_quantity", F.col("l_quantity").cast("long")).select("l_orderkey", "amount", *_SPLIT_KEYS)
    out = money.allocate(items, "amount", "l_quantity", ["l_orderkey"], _SPLIT_KEYS)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "share_paise")
