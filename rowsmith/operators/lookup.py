"""Lookup joins: rates, units, nearest row, as-of, reconciliation.

Lookup tables join on equal keys and carry no hint: Catalyst and AQE broadcast one whose bytes are few and shuffle a
bigger one, so the result never depends on the choice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith import dims
from rowsmith.operators import ordered


def _side(df: DataFrame, **names: str) -> DataFrame:
    """Columns under new names."""
    return df.select(*[F.col(src).alias(new) for new, src in names.items()])


def convert_currency(df: DataFrame, amount: str, frm: str, to: str, rates: DataFrame) -> DataFrame:
    """amount / rate[from] * rate[to], through the base currency; unknown codes give NULL."""
    a = _side(rates, _fc="currency", _fr="rate")
    b = _side(rates, _tc="currency", _tr="rate")
    return (
        df.join(a, F.col(frm) == F.col("_fc"), "left").join(b, F.col(to) == F.col("_tc"), "left")
        .withColumn("converted", F.col(amount) / F.col("_fr") * F.col("_tr"))
        .drop("_fc", "_fr", "_tc", "_tr")
    )


def rates_by_month(rates: DataFrame) -> DataFrame:
    """(currency, month, known): the month's rates by date, led by the latest one from before it.

    Turns the as-of lookup into an equi-join on (currency, month). Its months are those between the first and the last
    rate, whatever dates are asked for; ``known`` holds a month of rates and one more.
    """
    w = Window.partitionBy("currency").orderBy("rate_date")
    last = F.coalesce(F.lead("rate_date").over(w), rates.agg(F.max("rate_date")).scalar())
    spans = rates.select("currency", F.struct("rate_date", "rate").alias("r"), F.trunc("rate_date", "month").alias("_from"), F.trunc(last, "month").alias("_to"))
    months = spans.select("currency", "r", F.explode(F.sequence("_from", "_to", F.expr("interval 1 month"))).alias("month"))
    return months.groupBy("currency", "month").agg(F.sort_array(F.collect_list("r")).alias("known"))


def convert_asof(df: DataFrame, date: str, amount: str, frm: str, to: str, rates: DataFrame, stale_days: int = 4) -> DataFrame:
    """Convert with the latest rates on or before the row's date, however far after the last rate that is.

    ``stale`` marks rows whose older rate lies more than ``stale_days`` back; rows before the first rate get NULL.
    """
    monthly = rates_by_month(rates)
    a = _side(monthly, _fc="currency", _fk="known", _fm="month")
    b = _side(monthly, _tc="currency", _tk="known", _tm="month")
    day = F.to_date(date)
    # Every currency's spans end in the last month of all, so later dates are asked for there.
    month = F.least(F.trunc(day, "month"), F.trunc(rates.agg(F.max("rate_date")).scalar(), "month"))
    asked = df.withColumn("_day", day).withColumn("_month", F.when(F.col("_day").isNotNull(), month))
    joined = asked.join(a, (F.col(frm) == F.col("_fc")) & (F.col("_month") == F.col("_fm")), "left").join(
        b, (F.col(to) == F.col("_tc")) & (F.col("_month") == F.col("_tm")), "left"
    )
    at = lambda known: F.try_element_at(F.filter(known, lambda r: r["rate_date"] <= F.col("_day")), F.lit(-1))
    joined = joined.withColumn("_f", at("_fk")).withColumn("_t", at("_tk"))
    oldest = F.when(F.col("_f").isNotNull() & F.col("_t").isNotNull(), F.least("_f.rate_date", "_t.rate_date"))
    return (
        joined.withColumn("converted", F.col(amount) / F.col("_f.rate") * F.col("_t.rate"))
        .withColumn("rate_date", oldest)
        .withColumn("stale", F.datediff("_day", oldest) > stale_days)
        .drop("_fc", "_fk", "_fm", "_tc", "_tk", "_tm", "_f", "_t", "_day", "_month")
    )


def known_units(units: DataFrame) -> DataFrame:
    """The units whose id stands for one size only: an id that two kinds share converts to NULL, never to two rows."""
    once = units.groupBy("unit").agg(F.first("kind").alias("kind"), F.first("size").alias("size"), F.count(F.lit(1)).alias("_n"))
    return once.where("_n = 1").drop("_n")


def convert_units(df: DataFrame, amount: str, frm: str, to: str, units: DataFrame) -> DataFrame:
    """amount * size[from] / size[to] inside one kind; across kinds, unknown or ambiguous units NULL."""
    units = known_units(units)
    a = _side(units, _fk="kind", _fu="unit", _fs="size")
    b = _side(units, _tk="kind", _tu="unit", _ts="size")
    return (
        df.join(a, F.col(frm) == F.col("_fu"), "left")
        .join(b, (F.col(to) == F.col("_tu")) & (F.col("_fk") == F.col("_tk")), "left")
        .withColumn("kind", F.col("_fk"))
        .withColumn("converted", F.col(amount) * F.col("_fs") / F.col("_ts"))
        .drop("_fk", "_fu", "_fs", "_tk", "_tu", "_ts")
    )


def all_units(df: DataFrame, amount: str, frm: str, units: DataFrame) -> DataFrame:
    """One measurement in every unit of its kind."""
    units = known_units(units)
    a = _side(units, _fk="kind", _fu="unit", _fs="size")
    b = _side(units, _tk="kind", unit="unit", _ts="size")
    return (
        df.join(a, F.col(frm) == F.col("_fu")).join(b, F.col("_fk") == F.col("_tk"))
        .withColumn("value", F.col(amount) * F.col("_fs") / F.col("_ts"))
        .drop("_fk", "_fu", "_fs", "_tk", "_ts")
    )


def kitchen_grams(df: DataFrame, amount: str, unit: str, ingredient: str, units: DataFrame, densities: DataFrame) -> DataFrame:
    """Grams of an ingredient measured by volume: litres times a thousand times its density."""
    a = _side(units, _u="unit", _s="size")
    b = _side(densities, _i="ingredient", _d="density")
    return (
        df.join(a, F.col(unit) == F.col("_u"), "left").join(b, F.col(ingredient) == F.col("_i"), "left")
        .withColumn("grams", F.col(amount) * F.col("_s") * 1000.0 * F.col("_d"))
        .drop("_u", "_s", "_i", "_d")
    )


def _scale(column: str, part: int) -> Column:
    pairs = [x for name, values in dims.SCALES.items() for x in (F.lit(name), F.lit(values[part]))]
    return F.try_element_at(F.create_map(*pairs), F.lower(column))


def convert_temperature(df: DataFrame, value: str, frm: str, to: str) -> DataFrame:
    """Through Celsius; ``below_zero`` marks readings under absolute zero."""
    celsius = (F.col(value) - _scale(frm, 0)) * _scale(frm, 1)
    return (
        df.withColumn("_c", celsius)
        .withColumn("converted", F.col("_c") / _scale(to, 1) + _scale(to, 0))
        .withColumn("below_zero", F.col("_c") < dims.ABSOLUTE_ZERO_C - 1e-9)
        .drop("_c")
    )


def convert_area(
    df: DataFrame, amount: str, frm: str, to: str, units: DataFrame, bigha_sqyd: Column | None = None
) -> DataFrame:
    """Land units through square feet. A bigha is converted only with a stated size."""
    a = _side(units, _fu="unit", _fs="sqft")
    b = _side(units, _tu="unit", _ts="sqft")
    bigha = bigha_sqyd.cast("double") * 9.0 if bigha_sqyd is not None else F.lit(None).cast("double")
    size = lambda unit, known: F.when(F.col(unit) == "bigha", bigha).otherwise(F.col(known))
    return (
        df.join(a, F.col(frm) == F.col("_fu"), "left").join(b, F.col(to) == F.col("_tu"), "left")
        .withColumn("converted", F.col(amount) * size(frm, "_fs") / size(to, "_ts"))
        .drop("_fu", "_fs", "_tu", "_ts")
    )


def acres_from_record(text: Column) -> Column:
    """"2.20" or "2-20" in a land record is 2 acres 20 guntha, that is 2.5 acres.

    An acre has 40 guntha: a record with 40 or more is no acre-guntha record and gives NULL.
    """
    parts = F.split(text, r"[.-]")
    guntha = F.coalesce(F.get(parts, F.lit(1)).try_cast("double"), F.lit(0.0))
    return F.when(guntha < 40, parts[0].try_cast("double") + guntha / 40.0)


def pace_minutes_per_km(metres_per_second: Column) -> Column:
    return F.try_divide(F.lit(1000.0 / 60.0), metres_per_second)


def nearest(
    df: DataFrame, value: str, group: str, dim: DataFrame, dim_group: str, by: str, order: str, bounded: bool = False
) -> DataFrame:
    """The row of ``dim`` closest to ``value`` within the group; the earlier row on ties.

    Adds the chart row's columns, ``gap``, ``off_chart`` and ``exact``. Chart rows are sorted together with the values
    and carried along, so every value meets its lower and its upper neighbour only, whatever the size of the chart.
    A NULL group has no chart. ``bounded`` is the caller's word that one task can hold any group.
    """
    one = dim.groupBy(F.col(dim_group).alias("_g"), F.col(by).alias("_v")).agg(
        F.min_by(F.struct(*dim.columns), order).alias("_row")
    )
    joined = _neighbours_by_sort(df, value, group, one.where("_g is not null"), bounded)
    v, lo, hi = F.col(value), F.col(f"_lo.{by}"), F.col(f"_hi.{by}")
    gap_lo, gap_hi = F.abs(lo - v), F.abs(hi - v)
    earlier = F.col(f"_hi.{order}") < F.col(f"_lo.{order}")
    take_hi = v.isNotNull() & hi.isNotNull() & (lo.isNull() | (gap_hi < gap_lo) | ((gap_hi == gap_lo) & earlier))
    joined = joined.withColumn("_row", F.when(take_hi, F.col("_hi")).otherwise(F.col("_lo"))).withColumn(
        "gap", F.when(take_hi, gap_hi).otherwise(gap_lo)
    )
    inside = lo.isNotNull() & (hi.isNotNull() | (lo == v))
    return joined.select(
        *df.columns, *[F.col(f"_row.{c}").alias(c) for c in dim.columns if c != dim_group], "gap",
        F.when(F.col("gap").isNotNull(), ~inside).alias("off_chart"), (F.col("gap") <= 0.01).alias("exact"),
    )


def _neighbours_by_sort(df, value, group, one, bounded):
    columns = df.columns
    mine = df.select(F.col(group).alias("_g"), F.col(value).cast("double").alias("_v"), F.struct(*columns).alias("_data"), F.lit(None).cast(one.schema["_row"].dataType).alias("_row"))
    chart = one.select("_g", F.col("_v").cast("double").alias("_v"), F.lit(None).cast(mine.schema["_data"].dataType).alias("_data"), "_row")
    rows = mine.unionByName(chart).withColumn("_is_data", F.col("_data").isNotNull())
    # A chart row of the same value counts as the lower neighbour, so it sorts first.
    tie = F.xxhash64(F.to_json("_data"))
    order = [F.col("_v"), F.col("_is_data"), tie]
    rows = ordered.scan(rows, ["_g"], order, last_known={"_lo": "_row"}, next_known={"_hi": "_row"}, bounded=bounded)
    return rows.where("_is_data").select("_data.*", "_lo", "_hi")


def neighbours(matched: DataFrame, dim: DataFrame, group: str, dim_group: str, order: str, reach: int = 2) -> DataFrame:
    """The matched chart row and up to ``reach`` rows on either side of it."""
    around = matched.withColumn("_near", F.explode(F.sequence(F.col(order) - reach, F.col(order) + reach)))
    chart = dim.select(*[F.col(c).alias(f"near_{c}") for c in dim.columns])
    on = (F.col(group) == F.col(f"near_{dim_group}")) & (F.col("_near") == F.col(f"near_{order}"))
    return around.join(chart, on).drop("_near", f"near_{dim_group}").withColumn(
        "is_match", F.col(f"near_{order}") == F.col(order)
    )


def slab_join(df: DataFrame, amount: str, regime: str, slabs: DataFrame) -> DataFrame:
    """Bracket tables kept as data, one per regime: (regime, lo, hi, rate).

    A regime's brackets are folded into one array first (a handful of rows), so
    each row meets one array and is never multiplied by the number of brackets.
    """
    folded = slabs.groupBy(F.col("regime").alias("_r")).agg(F.collect_list(F.struct("lo", "hi", "rate")).alias("_s"))
    joined = df.join(folded, F.col(regime) == F.col("_r"), "left")
    slices = F.transform(
        F.sort_array("_s"),
        lambda s: F.greatest(F.lit(0.0), F.least(F.col(amount), s["hi"]) - s["lo"]) * s["rate"],
    )
    return joined.withColumn("tax", F.aggregate(slices, F.lit(0.0), lambda a, x: a + x)).drop("_r", "_s")


def orphans(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys only in ``a`` and keys only in ``b``, tagged with their side."""
    left = a.select(key).distinct().join(b.select(key), key, "left_anti").withColumn("only_in", F.lit("a"))
    right = b.select(key).distinct().join(a.select(key), key, "left_anti").withColumn("only_in", F.lit("b"))
    return left.unionByName(right)
