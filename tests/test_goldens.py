"""Published worked figures."""

import pytest
from pyspark.sql import functions as F

from rowsmith import dims
from rowsmith.functions import money as M
from rowsmith.operators import lookup, money


def loan(spark, principal, rate, years):
    return spark.createDataFrame([(1, float(principal), float(rate), years)], "id int, principal double, annual_rate double, years int")


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("years,emi", [(15, 29542), (20, 26035), (25, 24157)])
def test_emi_by_tenure(spark, years, emi):
    row = money.loan_emi(loan(spark, 3_000_000, 8.5, years)).first()
    assert round(row.emi) == emi
    if years == 20:
        assert round(row.emi, 2) == 26034.70 and round(row.interest) == 3248327


def test_emi_without_interest_and_without_loan(spark):
    assert money.loan_emi(loan(spark, 1200, 0, 1)).first().emi == 100
    bad = money.loan_emi(loan(spark, 0, 8, 1)).first()
    assert bad.emi is None and bad.finding


@pytest.mark.parametrize("month,interest,balance", [(1, 21250, 2995215), (60, 18778, 2643815), (120, 14952, 2099815), (180, 9108, 1268962), (240, 183, 0)])
def test_amortisation(spark, month, interest, balance):
    row = money.amortise(loan(spark, 3_000_000, 8.5, 20), "id", "month").where(F.col("month") == month).first()
    assert (round(row.interest), round(row.balance)) == (interest, balance)


def test_yearly_schedule_repays_the_loan(spark):
    rows = money.amortise(loan(spark, 3_000_000, 8.5, 20), "id").orderBy("year").collect()
    assert len(rows) == 20 and rows[-1].balance == 0
    assert sum(r.repaid for r in rows) == pytest.approx(3_000_000)
    assert sum(r.interest for r in rows) == pytest.approx(3248327, abs=1)


def test_prepayment(spark):
    row = money.prepay_effect(loan(spark, 3_000_000, 8.5, 20)).first()
    assert row.months_needed == 201
    assert row.interest / 1e5 == pytest.approx(26.31, abs=0.005)


def test_flat_rate(spark):
    row = money.flat_vs_reducing(loan(spark, 100_000, 10, 1)).first()
    assert (round(row.flat_instalment), round(row.reducing_instalment)) == (9167, 8792)
    rate = value(spark, M.rate_for_emi(F.lit(100_000.0), F.lit(row.flat_instalment), F.lit(12)))
    assert round(rate) == 18
    assert value(spark, M.rate_for_emi(F.lit(100_000.0), F.lit(8000.0), F.lit(12))) is None


@pytest.mark.parametrize("years,simple,yearly,quarterly", [(1, 107000, 107000, 107186), (5, 135000, 140255, 141478), (10, 170000, 196715, 200160), (20, 240000, 386968, 400639)])
def test_compound(spark, years, simple, yearly, quarterly):
    p, r, t = F.lit(100_000.0), F.lit(7.0), F.lit(years)
    assert round(value(spark, p + M.simple_interest(p, r, t))) == simple
    assert round(value(spark, M.compound_amount(p, r, t, 1))) == yearly
    assert round(value(spark, M.compound_amount(p, r, t, 4))) == quarterly


def test_yield_doubling_and_real_return(spark):
    seven = F.lit(7.0)
    assert round(value(spark, M.effective_yield(seven, 4)), 2) == 7.19
    assert 9.9 < value(spark, M.doubling_years(seven, 4)) < 10
    assert round(value(spark, M.real_return(seven, F.lit(6.0))), 1) == 0.9
    assert round(value(spark, M.real_return(M.after_tax(seven, F.lit(30.0)), F.lit(6.0))), 1) == -1.0


def test_sip(spark):
    m, r = F.lit(5000.0), F.lit(12.0)
    assert round(value(spark, M.sip_value(m, r, F.lit(10))) / 1e5, 2) == 11.62
    assert round(value(spark, M.sip_value(m, r, F.lit(10), F.lit(10.0))) / 1e5, 2) == 16.87
    assert round(value(spark, M.sip_paid(m, F.lit(10), F.lit(10.0))) / 1e5, 2) == 9.56
    assert round(value(spark, M.sip_needed(F.lit(1e7), r, F.lit(20)))) == 10009
    assert round(value(spark, M.sip_needed(F.lit(1e7), r, F.lit(30)))) == 2833


def test_gst_removed_from_a_bill(spark):
    df = spark.createDataFrame([(2360.0, 18, True, True), (1000.0, 18, False, False)], "amount double, rate int, inc boolean, same boolean")
    out = money.gst(df, F.col("amount"), F.col("rate"), F.col("inc"), F.col("same")).collect()
    assert [float(x) for x in (out[0].base, out[0].tax, out[0].cgst, out[0].sgst, out[0].igst)] == [2000, 360, 180, 180, 0]
    assert [float(x) for x in (out[1].base, out[1].tax, out[1].igst, out[1].bill_total)] == [1000, 180, 180, 1180]


def test_invoice_red_flags(spark):
    df = spark.createDataFrame(
        [(1, 1000.0, 18.0, 90.0, 90.0, 0.0, True), (2, 1000.0, 18.0, 90.0, 0.0, 90.0, True), (3, 1000.0, 18.0, 0.0, 0.0, 150.0, False)],
        "id int, base double, rate double, cgst double, sgst double, igst double, same_state boolean",
    )
    found = {(r.id, r.finding) for r in money.invoice_line_findings(df, ["id"]).collect()}
    assert (2, "both kinds of tax on one line") in found and (3, "tax is not base times rate") in found
    assert not [f for f in found if f[0] == 1]


@pytest.mark.parametrize("salary,tax", [(1_000_000, 0), (1_275_000, 0), (1_285_000, 10400), (1_300_000, 26000), (1_500_000, 97500), (2_000_000, 192400), (2_500_000, 319800), (3_000_000, 475800)])
def test_new_regime(spark, salary, tax):
    assert value(spark, M.income_tax(F.lit(float(salary)), F.lit(0.0), "new")) == pytest.approx(tax)


@pytest.mark.parametrize("salary,low,high", [(1_000_000, 70200, 18200), (1_275_000, 132600, 75400), (1_500_000, 202800, 124800), (2_000_000, 358800, 280800), (3_000_000, 670800, 592800)])
def test_old_regime(spark, salary, low, high):
    s = F.lit(float(salary))
    assert value(spark, M.income_tax(s, F.lit(175000.0), "old")) == pytest.approx(low)
    assert value(spark, M.income_tax(s, F.lit(425000.0), "old")) == pytest.approx(high)


@pytest.mark.parametrize("basic,capped,in_hand", [(30, False, 91157), (40, False, 88276), (50, False, 85395), (40, True, 94276)])
def test_salary(spark, basic, capped, in_hand):
    df = spark.createDataFrame([(1_200_000.0,)], "ctc double")
    row = money.salary_breakup(df, "ctc", F.lit(basic), F.lit(True), F.lit(capped)).first()
    assert round(row.in_hand_month) == in_hand
    assert row.basic + row.hra + row.special + row.pf + row.gratuity == pytest.approx(1_200_000)


def test_land(spark):
    df = spark.createDataFrame([(12.0, "guntha", "cent"), (12.0, "guntha", "sqft"), (1.0, "bigha", "sqft")], "a double, f string, t string")
    got = [r.converted for r in lookup.convert_area(df, "a", "f", "t", dims.area_units(spark)).collect()]
    assert got[0] == pytest.approx(30) and got[1] == 13068 and got[2] is None
    sized = lookup.convert_area(df, "a", "f", "t", dims.area_units(spark), F.lit(1600)).collect()
    assert sized[2].converted == 14400
    assert value(spark, lookup.acres_from_record(F.lit("2.20"))) == 2.5
    assert value(spark, lookup.acres_from_record(F.lit("2-20")) * dims.ACRE_SQFT) == 108900


def test_trip(spark):
    schema = "distance double, mileage double, price double, people int, trips int, return_trip boolean"
    rows = [(233.0, 18.0, 105.0, 2, 22, True), (10.0, 0.0, 105.0, 1, 1, False), (-1.0, 18.0, 105.0, 1, 1, False), (1.0, 18.0, 105.0, 0, 1, False)]
    a, b, c, d = money.trip_cost(spark.createDataFrame(rows, schema)).collect()
    assert a.trip == pytest.approx(466 / 18 * 105) and a.per_person == pytest.approx(a.trip / 2) and a.finding is None
    assert b.litres == 0 and b.trip == 0 and b.finding
    assert c.trip is None and c.finding and d.trip is None and d.finding


def test_allocation_adds_up_in_both_ways(spark):
    rows = [(g, i, 10_001 + g, 1 + (i * g) % 7) for g in range(1, 6) for i in range(9)]
    df = spark.createDataFrame(rows, "g int, i int, amount bigint, w bigint")
    plain = money.allocate(df, "amount", "w", ["g"], ["i"])
    split = money.allocate(df, "amount", "w", ["g"], ["i"], bounded=False)
    assert sorted(plain.collect()) == sorted(split.collect())
    sums = plain.groupBy("g", "amount").agg(F.sum("share_paise").alias("s")).collect()
    assert all(r.s == r.amount for r in sums)


def test_allocation_with_huge_weights(spark):
    weights = [4_000_000_000_000_000_001, 1_000_000_000_000_000_003, 2]
    df = spark.createDataFrame([(1, i, 100_000_000_007, w) for i, w in enumerate(weights)], "g int, i int, amount bigint, w bigint")
    got = [r.share_paise for r in money.allocate(df, "amount", "w", ["g"], ["i"]).orderBy("i").collect()]
    total = sum(weights)
    floors = [100_000_000_007 * w // total for w in weights]
    spare = 100_000_000_007 - sum(floors)
    first = sorted(range(3), key=lambda i: (-(100_000_000_007 * weights[i] % total), i))[:spare]
    assert got == [f + (i in first) for i, f in enumerate(floors)]


def test_allocation_of_a_refund_and_without_weight(spark):
    df = spark.createDataFrame([(1, 0, -10, 1), (1, 1, -10, 1), (1, 2, -10, 1), (2, 0, 10, 0)], "g int, i int, amount bigint, w bigint")
    got = [r.share_paise for r in money.allocate(df, "amount", "w", ["g"], ["i"]).orderBy("g", "i").collect()]
    assert got == [-4, -3, -3, None]
