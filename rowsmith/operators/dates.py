"""Age, date difference, working days, time zones and countdowns over tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.functions import calendar as C


def exact_age(df: DataFrame, born: str, asof: str, leap_day_to_march: bool = False) -> DataFrame:
    """Years, months, days; totals; weekday of birth; days to the next birthday."""
    b, t = F.col(born), F.col(asof)
    ok = lambda c: F.when(b <= t, c)
    out = df.withColumn("total_months", ok(C.whole_months(b, t)).cast("long"))
    m = F.col("total_months").cast("int")
    this_year = (F.year(t) - F.year(b)) * 12
    birthday = F.add_months(b, this_year)
    upcoming = F.when(birthday >= t, birthday).otherwise(F.add_months(b, this_year + 12))
    if leap_day_to_march:
        clamped = (F.month(b) == 2) & (F.dayofmonth(b) == 29) & (F.dayofmonth(upcoming) == 28)
        upcoming = F.when(clamped, F.date_add(upcoming, 1)).otherwise(upcoming)
    return (
        out.withColumn("years", F.floor(m / 12))
        .withColumn("months", (m % 12).cast("long"))
        .withColumn("days", ok(F.datediff(t, F.add_months(b, m))).cast("long"))
        .withColumn("total_days", ok(F.datediff(t, b)).cast("long"))
        .withColumn("total_weeks", F.floor(F.col("total_days") / 7))
        .withColumn("born_weekday", ok(F.weekday(b)).cast("long"))
        .withColumn("days_to_birthday", ok(F.datediff(upcoming, t)).cast("long"))
        .withColumn("finding", F.when(b > t, "born after the comparison date"))
    )


def date_diff(df: DataFrame, a: str, b: str) -> DataFrame:
    """Signed days, whole weeks and days over, whole months, and weekdays."""
    days = F.datediff(F.col(b), F.col(a))
    low, high = F.least(a, b), F.greatest(a, b)
    return (
        df.withColumn("days", days.cast("long"))
        .withColumn("weeks", F.floor(F.abs(days) / 7))
        .withColumn("days_over", (F.abs(days) % 7).cast("long"))
        .withColumn("whole_months", C.whole_months(low, high).cast("long"))
        .withColumn("weekdays", C.weekdays_between(F.col(a), F.col(b)))
    )


# Monday, and the working days of each week are counted from it.
ORIGIN = "1970-01-05"


def _weekday_rank(day: Column, weekend: tuple[int, ...]) -> Column:
    """How many days outside the weekend lie between ORIGIN and ``day``, both included; negative before it."""
    n = F.datediff(day, F.lit(ORIGIN).cast("date"))
    upto = [sum(1 for k in range(r + 1) if k not in weekend) for r in range(7)]
    return F.floor(n / 7) * upto[6] + F.element_at(F.array(*[F.lit(u) for u in upto]), (F.pmod(n, F.lit(7)) + 1).cast("int"))


def _weekday_at(rank: Column, weekend: tuple[int, ...]) -> Column:
    """The day outside the weekend with that rank."""
    days = [k for k in range(7) if k not in weekend]
    place = F.element_at(F.array(*[F.lit(k) for k in days]), (F.pmod(rank - 1, F.lit(len(days))) + 1).cast("int"))
    return F.date_add(F.lit(ORIGIN).cast("date"), (F.floor((rank - 1) / len(days)) * 7 + place).cast("int"))


def _steps(values: DataFrame, width: int) -> Column:
    """One scalar: for each stretch of ``width`` numbers how many of ``values`` lie before it, and those inside it.

    The list grows with the holidays, never with the dates that are asked for.
    """
    cut = F.floor(F.col("v") / width)
    boxes = values.groupBy(cut.alias("box")).agg(F.sort_array(F.collect_list("v")).alias("inside"))
    every = values.agg(F.floor(F.min("v") / width).alias("a"), F.floor(F.max("v") / width).alias("b")).where("a is not null")
    filled = every.select(F.explode(F.sequence("a", "b")).alias("box")).join(boxes, "box", "left")
    inside = F.coalesce("inside", F.array().cast("array<bigint>"))
    listed = filled.agg(F.sort_array(F.collect_list(F.struct("box", inside.alias("inside")))).alias("l"))
    # Running counts of the stretches, about one a year.
    sizes = F.transform("l", lambda x: F.size(x["inside"]).cast("long"))
    before = lambda i: F.aggregate(F.slice(sizes, 1, i), F.lit(0).cast("long"), lambda n, x: n + x)
    return listed.select(F.transform("l", lambda x, i: F.struct(x["box"].alias("box"), before(i).alias("before"), x["inside"].alias("inside")))).scalar()


def _count_upto(steps: Column, value: Column, width: int) -> Column:
    """How many of the listed numbers are at most ``value``."""
    first = F.get(steps, F.lit(0))["box"]
    at = F.floor(value / width) - first
    box = F.get(steps, F.least(at, F.size(steps) - 1).cast("int"))
    inside = box["before"] + F.size(F.filter(box["inside"], lambda v: v <= value))
    return F.when((F.coalesce(F.size(steps), F.lit(0)) <= 0) | (at < 0), F.lit(0)).otherwise(inside)


def _free_weekdays(holidays: DataFrame, weekend: tuple[int, ...]) -> DataFrame:
    """Holidays that are no weekend days anyway: (day, rank among weekdays)."""
    days = holidays.select(F.col("day").cast("date").alias("day")).where(F.col("day").isNotNull() & ~F.weekday("day").isin(list(weekend))).distinct()
    return days.withColumn("rank", _weekday_rank(F.col("day"), weekend).cast("long"))


def working_days(
    df: DataFrame, a: str, b: str, holidays: DataFrame, weekend: tuple[int, ...] = (5, 6)
) -> DataFrame:
    """Working days after ``a`` up to and including ``b``: weekdays in closed form less the holidays among them."""
    listed = _steps(_free_weekdays(holidays, weekend).select(F.unix_date("day").cast("long").alias("v")), 366)
    rank = lambda c: _weekday_rank(F.col(c), weekend) - _count_upto(F.col("_hol"), F.unix_date(c), 366)
    out = df.withColumn("_hol", listed)
    return out.withColumn("working_days", F.greatest(rank(b) - rank(a), F.lit(0)).cast("long")).drop("_hol")


def shift_date(date: Column, n: Column, unit: str) -> Column:
    """Move by days, weeks, months or years; a missing day becomes the month's last."""
    n = n.cast("int")
    return {
        "days": lambda: F.date_add(date, n),
        "weeks": lambda: F.date_add(date, n * 7),
        "months": lambda: F.add_months(date, n),
        "years": lambda: F.add_months(date, n * 12),
    }[unit]()


def add_working_days(
    df: DataFrame, date: str, n: str, holidays: DataFrame, weekend: tuple[int, ...] = (5, 6)
) -> DataFrame:
    """The n-th working day after ``date``, or before it where n is negative; n = 0 leaves the date as it is.

    Weekdays are counted in closed form; a holiday moves the goal on by one, so the goal's rank among weekdays is its
    rank among working days plus the holidays before it.
    """
    free = _free_weekdays(holidays, weekend)
    by_day = _steps(free.select(F.unix_date("day").cast("long").alias("v")), 366)
    # A holiday's rank among working days: its rank among weekdays less the holidays up to it.
    placed = free.withColumn("_hol", by_day).select((F.col("rank") - _count_upto(F.col("_hol"), F.unix_date("day"), 366)).cast("long").alias("v"))
    out = df.withColumn("_hol", by_day).withColumn("_gone", _steps(placed, 250))
    rank = lambda day: _weekday_rank(day, weekend) - _count_upto(F.col("_hol"), F.unix_date(day), 366)
    move = F.col(n).cast("long")
    goal = F.when(move > 0, rank(F.col(date)) + move).otherwise(rank(F.date_sub(F.col(date), 1)) + move + 1)
    out = out.withColumn("_goal", goal)
    moved = _weekday_at(F.col("_goal") + _count_upto(F.col("_gone"), F.col("_goal") - 1, 250), weekend)
    return out.withColumn("shifted", F.when(move == 0, F.col(date)).otherwise(moved)).drop("_hol", "_gone", "_goal")


def iso_week(df: DataFrame, date: str) -> DataFrame:
    d = F.col(date)
    monday = C.monday_of(d)
    return (
        df.withColumn("iso_year", C.iso_week_year(d))
        .withColumn("iso_week", F.weekofyear(d).cast("long"))
        .withColumn("monday", monday)
        .withColumn("sunday", F.date_add(monday, 6))
    )


def convert_zone(df: DataFrame, ts: str, frm: str, to: str) -> DataFrame:
    """Wall-clock time in ``frm`` shown as wall-clock time in ``to``, summer time included."""
    moved = F.convert_timezone(F.lit(frm), F.lit(to), F.col(ts).cast("timestamp_ntz"))
    return df.withColumn("converted", moved)


def countdown(df: DataFrame, target: str, now: Column) -> DataFrame:
    """Days, hours, minutes, seconds between ``now`` and the target, and which way."""
    gap = F.unix_seconds(F.col(target).cast("timestamp")) - F.unix_seconds(now.cast("timestamp"))
    out = df.withColumn("_gap", F.abs(gap)).withColumn("direction", F.when(gap >= 0, "to go").otherwise("ago"))
    g = F.col("_gap")
    return (
        out.withColumn("d", F.floor(g / 86400)).withColumn("h", F.floor((g % 86400) / 3600))
        .withColumn("m", F.floor((g % 3600) / 60)).withColumn("s", g % 60).drop("_gap")
    )
