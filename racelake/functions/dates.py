"""Calendar attributes and dates read from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from racelake.fixed import DAYS, MONTH_NUMBERS, MONTHS


def month_abbreviation(date_text: Column) -> Column:
    """The last three letters of a date text, in capitals."""
    return F.upper(F.right(F.trim(date_text), F.lit(3)))


def month_number(abbreviation: Column) -> Column:
    """English or Spanish month abbreviation as a number, null for anything else."""
    pairs = [F.lit(x) for pair in MONTH_NUMBERS.items() for x in pair]
    return F.create_map(*pairs)[abbreviation]


def leading_day(date_text: Column) -> Column:
    """The one or two digits a date text starts with."""
    return F.regexp_extract(F.trim(date_text), r"^(\d{1,2})", 1).try_cast("int")


def date_of(year: Column, month: Column, day: Column) -> Column:
    """A date from its parts, null when there is no such day."""
    month_end = F.dayofmonth(F.last_day(F.make_date(year, month, F.lit(1))))
    possible = F.when(month.between(1, 12) & year.between(1, 9999), day.between(1, month_end))
    return F.when(possible, F.make_date(year, month, day))


def iso_weekday(day: Column) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(day) + 1


def _name(names: tuple[str, ...], index: Column) -> Column:
    return F.get(F.array(*map(F.lit, names)), index - 1)


def month_name(day: Column) -> Column:
    return _name(MONTHS, F.month(day))


def month_short(day: Column) -> Column:
    return _name(tuple(m[:3] for m in MONTHS), F.month(day))


def day_name(day: Column) -> Column:
    return _name(DAYS, iso_weekday(day))


def day_short(day: Column) -> Column:
    return _name(tuple(d[:3] for d in DAYS), iso_weekday(day))


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def week_of_month(day: Column) -> Column:
    """Week within the month; weeks start on Monday, so the first may be short."""
    lead = F.weekday(month_start(day))
    return F.floor((F.dayofmonth(day) + lead - 1) / 7).cast("int") + 1


def week_start(day: Column) -> Column:
    return F.date_sub(day, F.weekday(day))


def week_end(day: Column) -> Column:
    return F.date_add(day, F.lit(6) - F.weekday(day))


def period_key(day: Column) -> Column:
    """Year and month in one number, ``yyyy0mm``."""
    return F.year(day) * 1000 + F.month(day)


def report_day(day: Column) -> Column:
    return F.date_format(day, "dd MMM")


def iso_stamp(ts: Column) -> Column:
    """Timestamp as ISO text to the second."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
