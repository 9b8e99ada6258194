"""Date sums as column expressions. Every date is a DATE; "now" is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_date(text: Column) -> Column:
    """YYYY-MM-DD or NULL; a day the month does not have is no date."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, "yyyy-MM-dd"))


def whole_months(start: Column, end: Column) -> Column:
    """Full months from start to end, a short month's last day counting as the day itself."""
    guess = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    return F.when(F.add_months(start, guess) > end, guess - 1).otherwise(guess)


def weekdays_between(start: Column, end: Column) -> Column:
    """Monday-Friday days after start, up to and including end; 0 unless end is later."""
    total = F.datediff(end, start)
    first = F.weekday(start)  # Monday 0
    tail = total % 7
    # The tail covers weekday numbers first+1 .. first+tail; 5, 6 (and 12) are weekend days.
    upto = first + tail
    saturdays = F.when((first < 5) & (upto >= 5), 1).otherwise(0) + F.when(upto >= 12, 1).otherwise(0)
    sundays = F.when((first < 6) & (upto >= 6), 1).otherwise(0)
    weekend = saturdays + sundays
    return F.when(total <= 0, 0).otherwise(F.floor(total / 7) * 5 + tail - weekend).cast("long")


def iso_week_year(d: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), d).cast("long")


def monday_of(d: Column) -> Column:
    return F.to_date(F.date_trunc("week", d))


def is_leap(year: Column) -> Column:
    return ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)


def leap_rule(year: Column) -> Column:
    """The rule that decides: 400 over 100 over 4."""
    return (
        F.when(year % 400 == 0, "divisible by 400")
        .when(year % 100 == 0, "divisible by 100")
        .when(year % 4 == 0, "divisible by 4")
        .otherwise("not divisible by 4")
    )


MILLIS_FROM = 100_000_000_000  # ours: from 1e11 on, a count is taken as milliseconds


def from_epoch(x: Column) -> Column:
    return F.when(F.abs(x) >= MILLIS_FROM, F.timestamp_millis(x)).otherwise(F.timestamp_seconds(x))


def to_epoch_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))
