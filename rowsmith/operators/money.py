"""Loans, deposits, tax, invoices and pay over tables. Schedules are exploded closed
forms: no row waits for the row before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.functions import money as M
from rowsmith.operators import ordered


def loan_emi(loans: DataFrame) -> DataFrame:
    """(principal, annual_rate, years) -> instalment, totals, the principal's share, finding."""
    months = F.col("years") * 12
    return (
        loans.withColumn("months", months.cast("long"))
        .withColumn("emi", M.emi(F.col("principal"), F.col("annual_rate"), F.col("months")))
        .withColumn("total", F.col("emi") * F.col("months"))
        .withColumn("interest", F.col("total") - F.col("principal"))
        .withColumn("principal_pct", F.try_divide(F.col("principal") * 100.0, F.col("total")))
        .withColumn("finding", F.when(F.col("principal") <= 0, "amount must be above zero"))
    )


def amortise(loans: DataFrame, key: str, grain: str = "year") -> DataFrame:
    """Principal repaid, interest and balance per year (or month) of every loan."""
    step = {"year": 12, "month": 1}[grain]
    # What does not change within a loan is worked out once, before its rows are made.
    fixed = loans.select(
        key, "principal", (F.col("annual_rate") / 1200.0).alias("_r"), (F.col("years") * 12).cast("int").alias("_n"),
        M.emi(F.col("principal"), F.col("annual_rate"), F.col("years") * 12).alias("_e"),
    ).where("principal > 0 and _n > 0")
    rows = fixed.select("*", F.explode(F.sequence(F.lit(1), F.ceil(F.col("_n") / step).cast("int"))).alias(grain))
    end = F.least(F.col(grain) * step, F.col("_n"))
    begin = (F.col(grain) - 1) * step
    owed = lambda k: M.balance(F.col("principal"), F.col("_r"), F.col("_e"), F.col("_n"), k)
    rows = rows.select(key, grain, owed(begin).alias("_before"), owed(end).alias("balance"), (F.col("_e") * (end - begin)).alias("_paid"))
    repaid = F.col("_before") - F.col("balance")
    return rows.select(key, grain, repaid.alias("repaid"), (F.col("_paid") - repaid).alias("interest"), "balance")


def amortise_rollup(loans: DataFrame, key: str) -> DataFrame:
    """The yearly schedule summed over the whole book, one row per loan year."""
    return amortise(loans, key).groupBy("year").agg(
        F.count(F.lit(1)).alias("loans"),
        *[F.sum(c).alias(c) for c in ("repaid", "interest", "balance")],
    )


def rate_tenure_grid(loans: DataFrame, key: str, rates: list[float], years: list[int]) -> DataFrame:
    """Instalment and interest of every loan at each rate and tenure of a small grid."""
    grid = F.array(*[F.struct(F.lit(float(r)).alias("annual_rate"), F.lit(y).alias("years")) for r in rates for y in years])
    rows = loans.select(key, "principal", F.inline(grid))
    months = F.col("years") * 12
    level = M.emi(F.col("principal"), F.col("annual_rate"), months)
    return rows.withColumn("emi", level).withColumn("interest", F.col("emi") * months - F.col("principal"))


def prepay_effect(loans: DataFrame) -> DataFrame:
    """One extra instalment at the end of every year: new month count and interest saved.

    Twelve months at a time in closed form, so a loan takes as many steps as years.
    """
    p, n = F.col("principal"), F.col("years") * 12
    r = F.col("annual_rate") / 1200.0
    base = loans.withColumn("_e", M.emi(p, F.col("annual_rate"), n)).withColumn("_r", r)
    base = base.withColumn("_g", F.pow(1 + F.col("_r"), F.lit(12)))
    e, r, g = F.col("_e"), F.col("_r"), F.col("_g")

    def one_year(state: Column, _: Column) -> Column:
        owed = state["owed"]
        after = F.when(r == 0, owed - 12 * e).otherwise(owed * g - e * (g - 1) / r)
        # Months that still need a full or part instalment when the year is the last.
        needed = F.when(r == 0, F.ceil(owed / e - 1e-9)).otherwise(
            F.ceil(F.log(e / (e - owed * r)) / F.log(1 + r) - 1e-9)
        )
        k = needed - 1
        gk = F.pow(1 + r, k)
        last = F.when(r == 0, owed - k * e).otherwise((owed * gk - e * (gk - 1) / r) * (1 + r))
        extra = F.least(e, after)
        done = owed <= 0.005
        ends = after <= 0.005
        return F.struct(
            F.when(done | ends, F.lit(0.0)).otherwise(after - extra).alias("owed"),
            F.when(done, state["months"]).when(ends, state["months"] + needed).otherwise(state["months"] + 12).cast("long").alias("months"),
            F.when(done, state["paid"]).when(ends, state["paid"] + k * e + last).otherwise(state["paid"] + 12 * e + extra).alias("paid"),
        )

    start = F.struct(p.cast("double").alias("owed"), F.lit(0).cast("long").alias("months"), F.lit(0.0).alias("paid"))
    walked = base.withColumn("_w", F.aggregate(F.sequence(F.lit(1), F.col("years").cast("int")), start, one_year))
    interest, was = F.col("_w.paid") - p, e * n - p
    return walked.select(
        *loans.columns, F.col("_w.months").alias("months_needed"),
        interest.alias("interest"), (was - interest).alias("interest_saved"),
    )


def flat_vs_reducing(loans: DataFrame) -> DataFrame:
    """The same loan quoted at a flat rate and on a reducing balance."""
    p, r, y = F.col("principal"), F.col("annual_rate"), F.col("years")
    flat = (p + p * r * y / 100.0) / (y * 12)
    return loans.withColumn("flat_instalment", flat).withColumn("reducing_instalment", M.emi(p, r, y * 12)).withColumn(
        "flat_costs_more", (F.col("flat_instalment") - F.col("reducing_instalment")) * y * 12
    )


def simple_interest(df: DataFrame, unit: str = "years") -> DataFrame:
    years = M.period_years(F.col("period"), unit)
    p = F.greatest(F.lit(0.0), F.col("principal"))
    interest = M.simple_interest(F.col("principal"), F.col("rate"), years)
    return df.withColumn("interest", interest).withColumn("amount", p + F.col("interest"))


def simple_interest_schedule(df: DataFrame, key: str, unit: str = "years") -> DataFrame:
    """One row per year, the last one for a part year."""
    years = M.period_years(F.col("period"), unit)
    p, r = F.greatest(F.lit(0.0), F.col("principal")), F.greatest(F.lit(0.0), F.col("rate"))
    rows = df.select(key, p.alias("_p"), (p * r / 100.0).alias("_per_year"), years.alias("_t")).where("_t > 0 and _p > 0")
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.ceil("_t").cast("int"))).alias("year"))
    y = F.col("year")
    return rows.select(
        key, "year", (y > F.col("_t")).alias("part_year"),
        (F.col("_per_year") * F.least(F.lit(1.0), F.col("_t") - (y - 1))).alias("interest"),
        (F.col("_p") + F.col("_per_year") * F.least(y.cast("double"), F.col("_t"))).alias("balance"),
    )


def compound_growth(df: DataFrame, per_year: int, inflation: float, tax_pct: float) -> DataFrame:
    """(principal, rate, years) -> simple and compound amounts, yields, doubling time."""
    p, r, t = F.col("principal"), F.col("rate"), F.col("years")
    kept = M.after_tax(r, F.lit(tax_pct))
    return (
        df.withColumn("simple_amount", p + M.simple_interest(p, r, t))
        .withColumn("compound_amount", M.compound_amount(p, r, t, per_year))
        .withColumn("effective_pct", M.effective_yield(r, per_year))
        .withColumn("doubling_years", M.doubling_years(r, per_year))
        .withColumn("real_pct", M.real_return(r, F.lit(inflation)))
        .withColumn("real_after_tax_pct", M.real_return(kept, F.lit(inflation)))
    )


def sip(df: DataFrame, step_up_pct: float) -> DataFrame:
    """(monthly, rate, years) -> plain and stepped-up value and what was paid in."""
    m, r, y = F.col("monthly"), F.col("rate"), F.col("years")
    return (
        df.withColumn("paid_in", m * 12 * y)
        .withColumn("value", M.sip_value(m, r, y))
        .withColumn("stepped_paid_in", M.sip_paid(m, y, F.lit(step_up_pct)))
        .withColumn("stepped_value", M.sip_value(m, r, y, F.lit(step_up_pct)))
    )


def gst(
    df: DataFrame, amount: Column, rate: Column, inclusive: Column, same_state: Column, discount: Column | None = None
) -> DataFrame:
    """Exact to the paisa (decimals): base, and the tax as CGST + SGST or as IGST.

    A discount reduces the amount first. An inclusive amount is divided, never
    reduced by the percentage. An odd paisa of the split goes to SGST.
    """
    money, pct = "decimal(18,2)", "decimal(6,2)"
    net = amount.cast(money)
    if discount is not None:
        net = F.round(net * (1 - discount.cast("decimal(6,4)")), 2).cast(money)
    inc_base = F.round(net * 100 / (rate.cast(pct) + 100), 2).cast(money)
    out = df.withColumn("base", F.when(inclusive, inc_base).otherwise(net))
    add_tax = F.round(F.col("base") * rate.cast(pct) / 100, 2).cast(money)
    out = out.withColumn("tax", F.when(inclusive, (net - inc_base).cast(money)).otherwise(add_tax))
    half = (F.floor(F.col("tax") * 100 / 2) / 100).cast(money)
    zero = F.lit(0).cast(money)
    return (
        out.withColumn("cgst", F.when(same_state, half).otherwise(zero))
        .withColumn("sgst", F.when(same_state, F.col("tax") - F.col("cgst")).otherwise(zero).cast(money))
        .withColumn("igst", F.when(same_state, zero).otherwise(F.col("tax")))
        .withColumn("bill_total", (F.col("base") + F.col("tax")).cast(money))
    )


def invoice_line_findings(lines: DataFrame, key: list[str], paise: float = 0.02) -> DataFrame:
    """(base, rate, cgst, sgst, igst, same_state) -> what is wrong with a line."""
    shown = F.col("cgst") + F.col("sgst") + F.col("igst")
    due = F.col("base") * F.col("rate") / 100
    intra = (F.col("cgst") != 0) | (F.col("sgst") != 0)
    checks = F.array(
        F.when(F.abs(shown - due) > paise, "tax is not base times rate"),
        F.when(intra & (F.col("igst") != 0), "both kinds of tax on one line"),
        F.when(F.col("same_state") & (F.col("igst") != 0), "IGST inside one state"),
        F.when(~F.col("same_state") & intra, "CGST or SGST across states"),
        F.when(F.abs(F.col("cgst") - F.col("sgst")) > paise, "CGST and SGST differ"),
    )
    return lines.select(*key, F.explode(F.array_compact(checks)).alias("finding"))


def invoice_totals(lines: DataFrame, headers: DataFrame, invoice: str, paise_per_line: float = 0.01) -> DataFrame:
    """Invoices whose printed total is not the sum of their lines and taxes."""
    summed = lines.groupBy(invoice).agg(
        F.sum(F.col("base") + F.col("cgst") + F.col("sgst") + F.col("igst")).alias("lines_total"),
        F.count(F.lit(1)).alias("n_lines"),
    )
    both = headers.join(summed, invoice)
    gap = F.col("printed_total") - F.col("lines_total")
    return both.withColumn("gap", gap).where(F.abs("gap") > paise_per_line * F.col("n_lines"))


def stacked_discount(df: DataFrame, price: str, offers: Column) -> DataFrame:
    sale = M.discounted(F.col(price), offers)
    return df.withColumn("sale_price", sale).withColumn("saving", F.col(price) - F.col("sale_price")).withColumn(
        "combined_pct", F.try_divide(F.col("saving") * 100.0, F.col(price))
    )


def margin_by(df: DataFrame, price: Column, cost: Column, by: list[str]) -> DataFrame:
    """Margin on price and markup on cost per group, in percent; NULL where undefined."""
    sums = df.groupBy(*by).agg(F.sum(price).alias("revenue"), F.sum(cost).alias("cost"))
    profit = (F.col("revenue") - F.col("cost")).cast("double") * 100.0
    return (
        sums.withColumn("profit", F.col("revenue") - F.col("cost"))
        .withColumn("margin_pct", F.try_divide(profit, F.col("revenue").cast("double")))
        .withColumn("markup_pct", F.try_divide(profit, F.col("cost").cast("double")))
    )


def price_for_margin(cost: Column, margin_pct: Column) -> Column:
    return F.try_divide(cost, 1 - margin_pct / 100.0)


def trip_cost(trips: DataFrame) -> DataFrame:
    """(distance, mileage, price, people, trips, return_trip) -> litres and costs, or a finding."""
    d = F.col
    refused = F.when(
        (d("distance") < 0) | (d("price") < 0) | (d("trips") < 0), "distance, price and trips cannot be below zero"
    ).when(d("people") < 1, "at least one person pays")
    out = trips.withColumn("_bad", refused)
    ok = lambda c: F.when(d("_bad").isNull(), c)
    out = out.withColumn("km", ok(d("distance") * F.when(d("return_trip"), 2).otherwise(1)))
    out = out.withColumn("litres", ok(F.when(d("mileage") > 0, d("km") / d("mileage")).otherwise(0.0)))
    out = out.withColumn("trip", d("litres") * d("price"))
    return (
        out.withColumn("per_km", ok(F.when(d("km") > 0, d("trip") / d("km")).otherwise(0.0)))
        .withColumn("per_person", d("trip") / d("people"))
        .withColumn("month", d("trip") * d("trips"))
        .withColumn("year", d("month") * 12)
        .withColumn("finding", F.coalesce("_bad", F.when(d("mileage") <= 0, "mileage must be above zero")))
        .drop("_bad")
    )


def tax_comparison(df: DataFrame, salary: str, deductions: str) -> DataFrame:
    """Both regimes side by side and the cheaper one."""
    s, d = F.col(salary), F.col(deductions)
    out = df.withColumn("tax_new", M.income_tax(s, d, "new")).withColumn("tax_old", M.income_tax(s, d, "old"))
    return out.withColumn("saving", F.abs(F.col("tax_new") - F.col("tax_old"))).withColumn(
        "cheaper", F.when(F.col("tax_old") < F.col("tax_new"), "old").otherwise("new")
    )


# Shares of basic pay, the capped PF and the professional tax, per year.
PF_RATE, GRATUITY_RATE, PF_CAP_YEAR, PROFESSIONAL_TAX_YEAR = 0.12, 0.0481, 21600.0, 2400.0


def salary_breakup(df: DataFrame, ctc: str, basic_pct: Column, metro: Column, pf_capped: Column) -> DataFrame:
    """Yearly parts of a pay package and the monthly amount in hand before income tax."""
    c = F.col(ctc)
    out = df.withColumn("basic", c * basic_pct / 100.0)
    b = F.col("basic")
    out = out.withColumn("hra", b * F.when(metro, 0.5).otherwise(0.4))
    out = out.withColumn("pf", F.when(pf_capped, F.least(b * PF_RATE, F.lit(PF_CAP_YEAR))).otherwise(b * PF_RATE))
    out = out.withColumn("gratuity", b * GRATUITY_RATE)
    out = out.withColumn("special", c - b - F.col("hra") - F.col("pf") - F.col("gratuity"))
    own = F.lit(PROFESSIONAL_TAX_YEAR)
    return out.withColumn("in_hand_month", (c - 2 * F.col("pf") - F.col("gratuity") - own) / 12.0)


def salary_components(parts: DataFrame, key: str) -> DataFrame:
    """The yearly parts as rows (component, amount)."""
    names = ["basic", "hra", "special", "pf", "gratuity"]
    return parts.select(key, *names).unpivot([key], names, "component", "amount")


def allocate(
    df: DataFrame, amount_paise: str, weight: str, by: list[str], order: list[str], bounded: bool = True
) -> DataFrame:
    """Split each group's whole amount by weight so the parts add up exactly.

    Everyone gets the floor; the leftover paise go to the largest remainders, ties by ``order``. Whole-number
    arithmetic throughout. A refund is split like the amount without its sign; a group without any weight gets NULL.
    A group is an order or an invoice and fits one task; ``bounded=False`` is for groups that need not.
    """
    rows = df.withColumn("_a", F.abs(F.col(amount_paise)).cast("long")).withColumn("_m", F.col(weight).cast("long"))
    keyed = ordered.scan(rows, by, [F.col(c) for c in order], total={"_all": "_m"}, bounded=bounded)
    # amount * weight = (amount div total) * total * weight + (amount % total) * weight; decimals hold the last product.
    left = "cast(_a % _all as decimal(19,0)) * cast(_m as decimal(19,0))"
    keyed = keyed.withColumn("_all", F.nullif("_all", F.lit(0))).withColumn(
        "_floor", F.expr(f"(_a div _all) * _m + cast({left} div cast(_all as decimal(19,0)) as bigint)")
    ).withColumn("_rest", F.expr(f"cast({left} % cast(_all as decimal(19,0)) as bigint)"))
    placed = ordered.scan(
        keyed, by, [F.col("_rest").desc(), *[F.col(c) for c in order]], position="_place", total={"_given": "_floor"}, bounded=bounded
    )
    share = F.col("_floor") + F.when(F.col("_place") <= F.col("_a") - F.col("_given"), 1).otherwise(0)
    signed = F.when(F.col(amount_paise) < 0, -share).otherwise(share)
    return placed.select(*df.columns, signed.cast("long").alias("share_paise"))
