"""Loan, savings, tax and pay sums as column expressions in closed form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowsmith import dims


def emi(principal: Column, annual_rate: Column, months: Column) -> Column:
    """The level instalment; NULL unless principal and months are positive."""
    r = annual_rate / 1200.0
    g = F.pow(1 + r, months)
    level = F.when(r == 0, principal / months).otherwise(principal * r * g / (g - 1))
    return F.when((principal > 0) & (months > 0), level)


def rate_for_emi(principal: Column, instalment: Column, months: Column, steps: int = 44) -> Column:
    """The yearly reducing-balance rate, in percent, whose instalment this is.

    Halves the span from 0 to the rate at which the instalment would be all interest;
    NULL when the instalments do not even repay the loan.
    """

    def halve(span: Column, _: Column) -> Column:
        mid = (span["lo"] + span["hi"]) / 2
        # Interest-free at zero, so only a positive rate reaches the formula.
        level = principal * (mid / 1200.0) / (1 - F.pow(1 + mid / 1200.0, -months))
        low = level < instalment
        return F.struct(F.when(low, mid).otherwise(span["lo"]).alias("lo"), F.when(low, span["hi"]).otherwise(mid).alias("hi"))

    def middle(span: Column) -> Column:
        # So close to zero the formula divides two roundings; the rate is zero.
        return F.when(span["hi"] < 1e-6, 0.0).otherwise((span["lo"] + span["hi"]) / 2)

    start = F.struct(F.lit(0.0).alias("lo"), (instalment / principal * 1200.0).alias("hi"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve, middle)
    return F.when(instalment * months >= principal * (1 - 1e-12), found)


def balance(principal: Column, monthly_rate: Column, instalment: Column, months: Column, k: Column) -> Column:
    """What is owed after k instalments; exactly zero after the last."""
    g = F.pow(1 + monthly_rate, k)
    owed = F.when(monthly_rate == 0, principal - instalment * k).otherwise(
        principal * g - instalment * (g - 1) / monthly_rate
    )
    return F.when(k >= months, F.lit(0.0)).otherwise(owed)


def simple_interest(principal: Column, rate: Column, years: Column) -> Column:
    clamp = lambda c: F.greatest(F.lit(0.0), c)
    return clamp(principal) * clamp(rate) * clamp(years) / 100.0


def period_years(period: Column, unit: str) -> Column:
    """Months are twelfths of a year, days are 365ths."""
    return F.greatest(F.lit(0.0), period) / {"years": 1.0, "months": 12.0, "days": 365.0}[unit]


def compound_amount(principal: Column, rate: Column, years: Column, per_year: int) -> Column:
    return principal * F.pow(1 + rate / (100.0 * per_year), years * per_year)


def effective_yield(rate: Column, per_year: int) -> Column:
    """The once-a-year rate, in percent, that grows as fast."""
    return (F.pow(1 + rate / (100.0 * per_year), F.lit(per_year)) - 1) * 100.0


def doubling_years(rate: Column, per_year: int) -> Column:
    return F.when(rate > 0, F.log(F.lit(2.0)) / (per_year * F.log(1 + rate / (100.0 * per_year))))


def real_return(rate: Column, inflation: Column) -> Column:
    return ((1 + rate / 100.0) / (1 + inflation / 100.0) - 1) * 100.0


def after_tax(rate: Column, tax_pct: Column) -> Column:
    return rate * (1 - tax_pct / 100.0)


def sip_factor(annual_rate: Column, months: Column) -> Column:
    """What one unit paid at the start of each month grows to."""
    i = annual_rate / 1200.0
    return F.when(i == 0, months.cast("double")).otherwise((1 + i) * (F.pow(1 + i, months) - 1) / i)


def sip_value(monthly: Column, annual_rate: Column, years: Column, step_up_pct: Column | None = None) -> Column:
    """Value at the end; with a step-up each year pays that much more than the last.

    One year's instalments grow to the same multiple every year; that multiple is
    carried forward by (1+i)^12 and the step-up, a geometric sum over the years.
    """
    if step_up_pct is None:
        return monthly * sip_factor(annual_rate, years * 12)
    year = monthly * sip_factor(annual_rate, F.lit(12))
    grow = F.pow(1 + annual_rate / 1200.0, F.lit(12))
    up = 1 + step_up_pct / 100.0
    level = F.abs(up - grow) < 1e-12
    total = F.when(level, years * F.pow(grow, years - 1)).otherwise(
        (F.pow(up, years) - F.pow(grow, years)) / (up - grow)
    )
    return year * total


def sip_paid(monthly: Column, years: Column, step_up_pct: Column) -> Column:
    up = 1 + step_up_pct / 100.0
    return monthly * 12 * F.when(up == 1, years.cast("double")).otherwise((F.pow(up, years) - 1) / (up - 1))


def sip_needed(target: Column, annual_rate: Column, years: Column) -> Column:
    return target / sip_factor(annual_rate, years * 12)


def slab_tax(amount: Column, slabs: list[tuple[float, float, float]]) -> Column:
    """Each slice of the amount taxed at its bracket's rate; a plain expression, no join."""
    total = F.lit(0.0)
    for lo, hi, rate in slabs:
        total = total + F.greatest(F.lit(0.0), F.least(amount, F.lit(float(hi))) - float(lo)) * rate
    return total


def taxable_income(salary: Column, deductions: Column, regime: str) -> Column:
    own = deductions if regime == "old" else F.lit(0.0)
    return F.greatest(F.lit(0.0), salary - dims.STANDARD_DEDUCTION[regime] - own)


def income_tax(salary: Column, deductions: Column, regime: str, nil_upto: float | None = None) -> Column:
    """Tax with cess. Under a regime with a rebate limit tax is nil up to it and
    never more than the income above it; ``nil_upto`` is a limit without that relief.
    """
    taxable = taxable_income(salary, deductions, regime)
    tax = slab_tax(taxable, dims.TAX_SLABS[regime])
    limit = dims.REBATE_LIMIT.get(regime)
    if limit is not None:
        tax = F.least(tax, F.greatest(F.lit(0.0), taxable - limit))
    if nil_upto is not None:
        tax = F.when(taxable <= nil_upto, 0.0).otherwise(tax)
    return tax * (1 + dims.CESS)


def discounted(price: Column, offers: Column) -> Column:
    """Price after one percentage off, then the next, and so on."""
    return F.aggregate(offers, price.cast("double"), lambda p, x: p * (1 - x / 100.0))
