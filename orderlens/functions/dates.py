"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    return F.year(day) * F.lit(10000) + F.month(day) * F.lit(100) + F.dayofmonth(day)


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def month_label(day: Column) -> Column:
    return F.date_format(day, "MMM yyyy")


def month_key(day: Column) -> Column:
    return F.year(day) * F.lit(100) + F.month(day)


def month_number(day: Column) -> Column:
    """Months since year 0, so that consecutive months differ by one."""
    return F.year(day) * F.lit(12) + F.month(day)


def hours_between(start: Column, end: Column) -> Column:
    """Elapsed hours, rounded half away from zero to two digits."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    hour = 3_600_000_000
    size = F.call_function("div", F.abs(micros) * F.lit(200) + F.lit(hour), F.lit(2 * hour))
    return (F.signum(micros).cast("int") * size).cast("decimal(14,0)") * F.lit(0.01).cast("decimal(3,2)")
