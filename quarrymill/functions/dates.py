"""Dates out of text, their parts, and holiday flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOLIDAYS = ("christmas_eve", "christmas", "new_year", "thanksgiving")


def month_day_year(text: Column) -> Column:
    """``Dec 11, 2019`` (any case) to a date."""
    return F.to_date(text, "MMM dd, yyyy")


def date_time(text: Column) -> Column:
    """``2015-11-26 13:45:00`` to a timestamp without zone."""
    return F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd HH:mm:ss"))


def date_parts(day: Column) -> dict[str, Column]:
    return {
        "year": F.year(day).cast("bigint"), "month": F.month(day).cast("bigint"),
        "day": F.dayofmonth(day).cast("bigint"),
    }


def thanksgiving(day: Column) -> Column:
    """Fourth Thursday of November in the year of ``day``."""
    return F.date_add(F.next_day(F.make_date(F.year(day), F.lit(10), F.lit(31)), "TH"), 21)


def holiday_flags(day: Column) -> dict[str, Column]:
    """0/1 flags as whole numbers."""
    d = F.to_date(day)
    on = lambda month, dom: (F.month(d) == month) & (F.dayofmonth(d) == dom)
    tests = (on(12, 24), on(12, 25), on(1, 1), d == thanksgiving(d))
    return {name: test.cast("bigint") for name, test in zip(HOLIDAYS, tests)}
