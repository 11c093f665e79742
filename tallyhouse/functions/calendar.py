"""Calendar attributes shared by the clean table and the date dimension."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_MONTHS = (
    "January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December",
)
_DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
_DASHED = tuple(f"-{month:02d}" for month in range(1, 13))


def quarter_name(moment: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(moment).cast("string"))


def _of(names: tuple[str, ...], number: Column) -> Column:
    """The name at a place counted from 1; looking it up costs far less per row than a date format."""
    return F.when(number.isNotNull(), F.element_at(F.array(*map(F.lit, names)), number))


def _four_digits(moment: Column) -> Column:
    return F.year(moment).between(1000, 9999)


def month_name(moment: Column) -> Column:
    return _of(_MONTHS, F.month(moment))


def day_name(moment: Column) -> Column:
    return _of(_DAYS, F.weekday(moment) + 1)


def year_month(moment: Column) -> Column:
    quick = F.concat(F.year(moment).cast("string"), _of(_DASHED, F.month(moment)))
    return F.when(_four_digits(moment), quick).otherwise(F.date_format(moment, "yyyy-MM"))


def date_key(moment: Column) -> Column:
    quick = F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)
    return F.when(_four_digits(moment), quick).otherwise(F.date_format(moment, "yyyyMMdd").cast("int"))


def is_weekend(day: Column) -> Column:
    return (F.weekday(day) >= 5).cast("int")


def whole_days(start: Column, end: Column) -> Column:
    """Elapsed periods of 24 hours, not calendar days."""
    return F.timestamp_diff("DAY", start, end)
